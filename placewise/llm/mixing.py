"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents are summed to cells of (source, language, topic) once. A round then scales the cells'
token weights so that their sums meet the source targets, then the language targets, then the
topic targets; repeated rounds converge to the weights closest to the data that meet all three.
The weight of a cell is its tokens times one factor for each margin, so a step recomputes the
factors of one margin from the cells and the other factors.
A document of a cell is drawn with probability rate * weight / tokens of the cell, at most 1.
The draw is a hash of id and text, so a recomputed task decides alike.
``copies`` says how often a document is drawn: the whole part of rate * weight / tokens, plus one with the
probability of the rest, so the drawn tokens meet the targets in the mean. ``sampled(docs, repeat=True)`` writes each
document so many times. ``kept`` is whether it is drawn at all; with it alone a cell whose weight passes its tokens falls
short of its weight, and the kept documents stay between the data and the targets.

All of it is DataFrame work. Only cells and margins are shuffled more than once, each margin is
summed before its shuffle, and joins to cells and margins broadcast only where Spark finds the
side small. Factors are written to the shared folder, so no step is computed twice.

Defined results: null source, language or topic is a value of its own; a null text has no
tokens and meets no topic cue; a cell without tokens has rate ``rate`` (its documents add nothing to any
margin); equal rows (id and text) get the same draw; a very long text is one document of many tokens; an empty table
gives an empty table; the input's columns travel in one struct, so none can clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm.blocks import stored, whole_text

MARGINS = ("source", "lang", "topic")
#: Target share of a value: its share of all tokens to this power, made to sum to 1.
POWERS = {"source": 0.7, "lang": 0.5, "topic": 0.7}
ROUNDS = 10
RATE = 1.0
SEED = "mix-1"
#: Topics by the first cue that a text contains; otherwise prose.
CUES = (("legal", "icensed under"), ("listing", " | "), ("contact", "@"), ("dialogue", "?"))
OTHER_TOPIC = "prose"
WORD = r"[^ \t\n\x0B\f\r]+"
DRAW_DIGITS = 13


def topic_of(text: Column) -> Column:
    topic = F.lit(OTHER_TOPIC)
    for name, cue in reversed(CUES):
        topic = F.when(F.contains(text, F.lit(cue)), name).otherwise(topic)
    return topic


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by id, text and seed."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), text))
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("double") / float(1 << 4 * DRAW_DIGITS)


def described(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
              lang: str = "lang", topic: Column | None = None, row: list[str] | None = None) -> DataFrame:
    """Column ``row`` (the document), its three values, its tokens and its draw."""
    kept = docs.columns if row is None else row
    whole = whole_text(F.col(f"`{text}`"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
                       F.col(f"`{source}`").alias("source"), F.col(f"`{lang}`").alias("lang"),
                       (topic_of(whole) if topic is None else topic).alias("topic"),
                       F.regexp_count(whole, F.lit(WORD)).cast("long").alias("tokens"),
                       draw(F.col(f"`{doc_id}`"), whole).alias("draw"))


def powered_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, share): shares of tokens to a power."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("p"))
    total = sums.agg(F.sum("p")).first()[0]
    return sums.select(margin, (F.col("p") / F.lit(total or 1.0)).alias("share"))


def _joined(left: DataFrame, right: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """Left join on columns of equal names in which null equals null."""
    right = right.select(*[F.col(c).alias(f"r_{c}") if c in on else F.col(c) for c in right.columns])
    same = reduce(Column.__and__, [left[c].eqNullSafe(right[f"r_{c}"]) for c in on])
    return left.join(right, same, "left").drop(*[f"r_{c}" for c in on])


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the margins' columns, tokens) with ``weight``, whose sums meet the targets (value, share).

    The weights sum to all tokens. Values without a target keep their weight.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    now = cells
    for margin, target in targets.items():
        now = _joined(now, target.withColumnRenamed("share", f"to_{margin}"), (margin,))
    now = stored(now, "cells-targets")
    factors: dict[str, DataFrame] = {}

    def weighted(but: str | None) -> DataFrame:
        """The cells with their tokens times the factors so far, but for one margin's."""
        out, weight = now, F.col("tokens").cast("double")
        for margin, factor in factors.items():
            if margin != but:
                out, weight = _joined(out, factor, (margin,)), weight * F.col(f"f_{margin}")
        return out.withColumn("weight", weight)

    for _ in range(rounds):
        for margin in targets:
            sums = weighted(margin).groupBy(margin).agg(F.sum("weight").alias("sum"), F.max(f"to_{margin}").alias("to"))
            fit = F.when((F.col("sum") > 0) & F.col("to").isNotNull(), F.col("to") * F.lit(total) / F.col("sum")).otherwise(1.0)
            factors[margin] = stored(sums.select(margin, fit.alias(f"f_{margin}")), f"factors-{margin}")
    return weighted(None).select(*cells.columns, "weight")


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, powers: dict[str, float] | None = None,
        rounds: int = ROUNDS, rate: float = RATE, **columns) -> DataFrame:
    """``described(docs)`` with the cell's weight, the document's ``probability``, whether it is ``kept`` and its ``copies``.

    Without ``targets`` (a table of value and share for each margin) they follow ``powers``.
    """
    rows = described(docs, **columns)
    cells = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    cells = stored(cells, "cells")
    targets = targets or {m: powered_targets(cells, m, p) for m, p in (powers or POWERS).items()}
    times = F.when(F.col("cell_tokens") > 0, F.lit(rate) * F.col("weight") / F.col("cell_tokens")).otherwise(F.lit(rate))
    probability, whole = F.least(F.lit(1.0), times), F.floor(times)
    copies = whole + (F.col("draw") < times - whole).cast("long")
    # Written, so that Spark knows its size and, where it is small, moves no document to meet it.
    weighted = stored(rake(cells, targets, rounds).withColumnRenamed("tokens", "cell_tokens"), "cell-weights")
    return (_joined(rows, weighted, MARGINS).withColumn("probability", probability)
            .withColumn("kept", F.col("draw") < F.col("probability")).withColumn("copies", copies))


def sampled(docs: DataFrame, repeat: bool = False, **options) -> DataFrame:
    """The drawn documents, with their own columns; with ``repeat`` each as often as it has ``copies``."""
    mixed = mix(docs, **options)
    if not repeat:
        return mixed.where("kept").select("row.*")
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def mix_sql(rounds: int = ROUNDS, rate: float = RATE, powers: dict[str, float] | None = None) -> str:
    """The same for DuckDB, rounds written out; doc_id, the values, tokens, weight, probability, kept, copies."""
    topic = f"'{OTHER_TOPIC}'"
    for name, cue in reversed(CUES):
        topic = f"CASE WHEN contains(coalesce(text, ''), '{cue}') THEN '{name}' ELSE {topic} END"
    parts = [f"""d AS MATERIALIZED (
  SELECT doc_id, source, lang, {topic} AS topic,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS tokens,
         CAST(CAST('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))),
                                  1, {DRAW_DIGITS}) AS BIGINT) AS DOUBLE) / {float(1 << 4 * DRAW_DIGITS)!r} AS draw
  FROM documents)""",
             "cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS tokens FROM d GROUP BY ALL)"]
    for m, p in (powers or POWERS).items():
        parts.append(f"""t_{m} AS MATERIALIZED (SELECT {m}, p / sum(p) OVER () AS share
  FROM (SELECT {m}, pow(CAST(sum(tokens) AS DOUBLE), {p}) AS p FROM cells GROUP BY {m}))""")
    joins = " ".join(f"JOIN t_{m} ON cells.{m} IS NOT DISTINCT FROM t_{m}.{m}" for m in MARGINS)
    shares = ", ".join(f"t_{m}.share AS to_{m}" for m in MARGINS)
    parts.append(f"""w0 AS MATERIALIZED (SELECT cells.*, {shares}, CAST(tokens AS DOUBLE) AS weight,
  CAST((SELECT sum(tokens) FROM cells) AS DOUBLE) AS total FROM cells {joins})""")
    step = 0
    for _ in range(rounds):
        for m in MARGINS:
            own = f"sum(weight) OVER (PARTITION BY {m})"
            parts.append(f"""w{step + 1} AS MATERIALIZED (SELECT * REPLACE (
  CASE WHEN {own} > 0 THEN weight * (to_{m} * total) / {own} ELSE weight END AS weight) FROM w{step})""")
            step += 1
    same = " AND ".join(f"d.{m} IS NOT DISTINCT FROM w.{m}" for m in MARGINS)
    times = f"(CASE WHEN w.tokens > 0 THEN {rate} * w.weight / w.tokens ELSE {rate} END)"
    chance = f"least(1.0, {times})"
    return f"""WITH {', '.join(parts)}
SELECT d.doc_id, d.source, d.lang, d.topic, CAST(d.tokens AS BIGINT) AS tokens, round(w.weight, 3) AS weight,
       round({chance}, 6) AS probability, d.draw < {chance} AS kept,
       CAST(floor({times}) AS BIGINT) + CAST(d.draw < {times} - floor({times}) AS BIGINT) AS copies
FROM d JOIN w{step} AS w ON {same}"""
