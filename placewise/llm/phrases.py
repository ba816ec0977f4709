"""Phrase mining by dynamic itemset counting: word sequences that occur together more than their parts.

Texts become pieces and words once, as blocks of word numbers with the block's own dictionary, dealt
over ``SHARDS`` shards. Then the shards are scanned in a circle, one for each step. A phrase becomes
active at the first step at which both its subphrases (without its last and without its first
word) have reached the threshold in what was scanned so far; it is counted in every shard from
that step on until it has seen each shard once. So words, pairs, triples and quadruples are counted
in the same scans, and the scans end one full cycle after the last phrase became active.

Which phrases have reached the threshold travels to the scans as a table of fixed size
(``SLOTS`` bytes, ``PROBES`` places for each phrase): a place holds the step from which it counts
as reached. Two phrases that share places can make a longer one active too early, never too late, so
the counts of all frequent phrases stay exact; a table that fills up costs counting, not results.

Bounded: a block has at most ``BLOCK_WORDS`` words or is one text; a task counts a block before the shuffle,
so a frequent phrase has one row for each block; only the places of the table reach the driver.
After each step the counts are written to the shared folder, and only phrases still in their
cycle go on to the next.

Defined results: a null text has no words, a null language is ``und``; repeated rows count each;
order is score, count, then the phrase in byte order, so ranks have no ties; an empty table gives an
empty table; only the text and language columns are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewise.llm.blocks import as_bytes, slices, stored, whole_text
from placewise.session import scratch_path, shuffle_partitions

SHARDS = 3
LONGEST = 4
THRESHOLD = 30
COVERED = 80          # per cent of a phrase's places that a longer phrase must reach to replace it
SCALE = 2_000_000
FIRST = 2_000
BLOCK_WORDS = 2 << 20
TEXT_BYTES = 2 << 20
SLOTS = 1 << 24
PROBES = 3
NEVER = 255
#: Steps fit one byte: each of up to LONGEST cycles is SHARDS steps.
MOST_SHARDS = (NEVER - 1) // LONGEST

CUT = b"\xff"         # a byte that no UTF-8 text has
#: A-Z to lower case, tab to space, the characters that end a piece to the cut.
PIECES = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BLOCK = "shard int, lang string, words array<binary>, hashes binary, ids binary, n_words bigint"
_COUNT = "lang string, phrase binary, size int, start int, n bigint"


# ------------------------------------------------------------------ texts to blocks

class _Block:
    """Word numbers of one language's texts: 0 is a cut, k the word k of the dictionary."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {CUT: 0}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[bytes]) -> None:
        # Only ASCII white space splits bytes; all of it but the space and the tab has become a cut.
        words = (CUT.join(texts).translate(PIECES) + CUT).replace(CUT, b" \xff ").split()
        numbers = self.numbers
        for word in set(words).difference(numbers):
            numbers[word] = len(numbers)
        self.parts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        self.size += len(words)

    def row(self, lang: str, shard: int) -> pa.RecordBatch:
        ids = np.concatenate([np.zeros(1, dtype=np.int32), *self.parts])
        ids = ids[np.concatenate([[True], (ids[1:] != 0) | (ids[:-1] != 0)])]  # one cut is enough
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([lang]), pa.array([list(self.numbers)], pa.list_(pa.binary())),
             pa.array([word_hash(lang.encode(), list(self.numbers)).tobytes()], pa.binary()),
             pa.array([ids.tobytes()], pa.binary()), pa.array([int((ids > 0).sum())], pa.int64())],
            names=["shard", "lang", "words", "hashes", "ids", "n_words"])


def _blocks(batches: Iterator[pa.RecordBatch], shards: int, most: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Block] = {}
    number = TaskContext.get().partitionId()
    for batch in slices(batches, "text", TEXT_BYTES):
        texts, langs = as_bytes(batch.column("text")), batch.column("lang").to_pylist()
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, texts):
            by_lang.setdefault(lang, []).append(text)
        for lang, some in by_lang.items():
            block = held.setdefault(lang, _Block())
            block.add(some)
            # Languages together stay under twice the bound, and what is passed on is large.
            while sum(b.size for b in held.values()) >= most:
                largest = max(held, key=lambda x: held[x].size)
                yield held.pop(largest).row(largest, number % shards)
                number += 1
    for lang, block in held.items():
        yield block.row(lang, number % shards)
        number += 1


def word_blocks(docs: DataFrame, text: str | Column = "text", lang: str | Column = "lang", shards: int = SHARDS,
                block_words: int = BLOCK_WORDS) -> DataFrame:
    """The texts as blocks of word numbers, stored with a folder for each shard."""
    lang = F.col(lang) if isinstance(lang, str) else lang
    plain = docs.select(whole_text(text).alias("text"), F.coalesce(lang.cast("string"), F.lit("und")).alias("lang"))
    made = plain.mapInArrow(partial(_blocks, shards=shards, most=block_words), _BLOCK)
    path = scratch_path(docs.sparkSession, "phrase-blocks")
    made.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


# ------------------------------------------------------------------ phrase hashes and reached steps

def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def longer(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its words but the last and of the last word."""
    return mixed(first * np.uint64(0xD6E8FEB86659FD93) + word)


def word_hash(lang: bytes, words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(lang + b" " + w) for w in words), dtype=np.uint64, count=len(words))


def slots(hashes: np.ndarray, probe: int, size: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(probe + 1)) & np.uint64(size - 1)).astype(np.int64)


def reached(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The step from which each phrase counts as one that has reached the threshold, ``NEVER`` if none."""
    out = table[slots(hashes, 0, len(table))]
    for probe in range(1, PROBES):
        np.maximum(out, table[slots(hashes, probe, len(table))], out=out)
    return out


def _places(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Places of phrases in the table, as bits of 64-bit words."""
    for batch in batches:
        if not batch.num_rows:
            continue
        found = []
        for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
            own = word_hash(lang.encode(), phrase.split(b" "))
            value = own[:1]
            for k in range(1, len(own)):
                value = longer(value, own[k:k + 1])
            found.append(value)
        hashes = np.concatenate(found)
        at = np.unique(np.concatenate([slots(hashes, probe, size) for probe in range(PROBES)]))
        word, first = np.unique(at >> 6, return_index=True)
        bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(bits.view(np.int64))], names=["word", "bits"])


def enter(table: np.ndarray, phrases: DataFrame, step: int) -> np.ndarray:
    """The table with newly reached phrases (lang, phrase), which count as reached from ``step`` on."""
    made = phrases.select("lang", "phrase").mapInArrow(partial(_places, size=len(table)), "word bigint, bits bigint")
    found = made.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most len(table) / 64 rows
    words, bits = found.column("word").to_numpy(), found.column("bits").to_numpy().view(np.uint64)
    out = table.copy()
    for bit in range(64):
        at = words[(bits >> np.uint64(bit)) & np.uint64(1) == 1] * 64 + bit
        out[at] = np.minimum(out[at], step)
    return out


# ------------------------------------------------------------------ scans

def distinct(columns: list[np.ndarray], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of each distinct row of word numbers."""
    code, most = columns[0].astype(np.int64), n_words
    for column in columns[1:]:
        if most > (1 << 62) // n_words:
            code = np.unique(code, return_inverse=True)[1]
            most = int(code.max()) + 1
        code, most = code * n_words + column, most * n_words
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n


def block_counts(own: np.ndarray, ids: np.ndarray, table: np.ndarray, step: int,
                 shards: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray], np.ndarray]]:
    """Counts of a block's active phrases: size, start step, word numbers, count, one entry for each phrase.

    ``own`` are the hashes of the block's words."""
    n_words = len(own)
    if step < shards:
        n = np.bincount(ids, minlength=n_words)
        n[0] = 0
        at = np.flatnonzero(n)
        yield 1, np.zeros(len(at), dtype=np.int32), [at], n[at]
    # Places where a phrase of the size at hand may stand: start, its hash, when it counts as reached.
    at = np.flatnonzero(ids)
    hashes, when = own[ids[at]], reached(table, own)[ids[at]]
    for size in range(2, LONGEST + 1):
        good = np.flatnonzero(when <= step)
        at, hashes, when = at[good], hashes[good], when[good]
        follows = np.flatnonzero(np.diff(at, append=-1) == 1)  # the phrase one place on also stands
        start = np.maximum(when[follows], when[follows + 1]) if len(follows) else when[:0]
        at = at[follows]
        now = np.flatnonzero(start.astype(np.int64) > step - shards)
        if len(now):
            columns = [ids[at[now] + k] for k in range(size)]
            first, n = distinct(columns, n_words)
            yield size, start[now][first].astype(np.int32), [c[first] for c in columns], n
        if size < LONGEST:
            hashes = longer(hashes[follows], own[ids[at + size - 1]])
            # By chance its places may be taken from before its own start; it cannot be reached there.
            when = np.maximum(reached(table, hashes), start)


def _scan(batches: Iterator[pa.RecordBatch], table, step: int, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words, hashes, ids in zip(*(batch.column(n) for n in ("lang", "words", "hashes", "ids"))):
            lang, dictionary = lang.as_py(), words.values
            own, ids = np.frombuffer(hashes.as_buffer(), dtype=np.uint64), np.frombuffer(ids.as_buffer(), dtype=np.int32)
            for size, start, columns, n in block_counts(own, ids, table.value, step, shards):
                for a in range(0, len(n), 1 << 17):
                    taken = [dictionary.take(pa.array(c[a:a + (1 << 17)])) for c in columns]
                    phrase = taken[0] if size == 1 else pc.binary_join_element_wise(*taken, pa.scalar(b" ", pa.binary()))
                    rows = len(phrase)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]).take(pa.array(np.zeros(rows, dtype=np.int32))), phrase,
                         pa.array(np.full(rows, size, dtype=np.int32)), pa.array(start[a:a + rows]),
                         pa.array(n[a:a + rows].astype(np.int64))],
                        names=["lang", "phrase", "size", "start", "n"])


def frequent_phrases(blocks: DataFrame, shards: int = SHARDS, threshold: int = THRESHOLD, n_slots: int = SLOTS) -> DataFrame:
    """(lang, phrase, size, n) of every phrase of up to ``LONGEST`` words with ``n`` of at least ``threshold``, exact."""
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"from 1 to {MOST_SHARDS} shards")
    context = blocks.sparkSession.sparkContext
    table = np.full(n_slots, NEVER, dtype=np.uint8)
    shared, held, done, last, step = context.broadcast(table), None, [], 0, 0
    while step < last + shards:
        run = partial(_scan, table=shared, step=step, shards=shards)
        made = blocks.where(F.col("shard") == step % shards).mapInArrow(run, _COUNT).withColumn("held", F.lit(0).cast("long"))
        if held is not None:
            made = made.unionByName(held)
        # What has been through its cycle and stays below the threshold is not written.
        often, complete = F.col("n") >= threshold, F.col("start") <= step - shards + 1
        counts = stored(made.groupBy("lang", "phrase", "size", "start").agg(F.sum("n").alias("n"), F.max("held").alias("held"))
                        .where(~complete | often), "phrase-counts")
        done.append(counts.where(complete & often).select("lang", "phrase", "size", "n"))
        entered = enter(table, counts.where(often & (F.col("held") < threshold) & (F.col("size") < LONGEST)), step + 1)
        if (entered != table).any():
            shared.unpersist()
            table, shared, last = entered, context.broadcast(entered), step + 1
        # Phrases that are still in their cycle go on, with what they had before the next step.
        held = counts.where(~complete).withColumn("held", F.col("n"))
        step += 1
    return reduce(DataFrame.unionByName, done)


# ------------------------------------------------------------------ scores

def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def scored(frequent: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates with their lowest-scoring cut: lang, phrase, a, l, r, score; without those inside a longer one."""
    words = F.split(F.col("phrase"), " ")
    counted = frequent.select("lang", F.col("phrase").cast("string").alias("phrase"), "size", "n")
    candidates = counted.where("size > 1").withColumnRenamed("n", "a")
    cut = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), words.alias("w"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                     F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("right"))
    part = counted.select("lang", "phrase", "n")
    both = (cut.join(part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]))
    value = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = (both.withColumn("score", value).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inside = candidates.where("size > 2").select("lang", "a", words.alias("w"), "size")
    inside = inside.select("lang", "a", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inside = inside.select("lang", "a", "w", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
    inside = (inside.select("lang", F.array_join(F.expr("slice(w, at, m)"), " ").alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    hidden = F.lit(100).cast("decimal(4,0)") * _wide("most") >= F.lit(covered).cast("decimal(4,0)") * _wide("a")
    return (lowest.join(inside, ["lang", "phrase"], "left").where(~F.coalesce(hidden, F.lit(False)))
            .select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score")))


def ranked(candidates: DataFrame, first: int = FIRST) -> DataFrame:
    """Each language's first candidates. A language is ranked in parts before its best meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(candidates.sparkSession)))
    some = (candidates.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= first).drop("part", "rank"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return some.withColumn("rank", rank).where(F.col("rank") <= first)


def collocations(docs: DataFrame, text: str | Column = "text", lang: str | Column = "lang", first: int = FIRST,
                 shards: int = SHARDS, threshold: int = THRESHOLD, covered: int = COVERED, n_slots: int = SLOTS,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score."""
    blocks = word_blocks(docs, text, lang, shards, block_words)
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    frequent = stored(frequent_phrases(blocks, shards, threshold, n_slots), "phrases")
    found = ranked(scored(frequent, covered), first)
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(first: int = FIRST, threshold: int = THRESHOLD, covered: int = COVERED) -> str:
    """The same for DuckDB, by counting every sequence of words."""
    return f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
f AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS n FROM (
    SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k))
  GROUP BY 1, 2, 3 HAVING count(*) >= {threshold}),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, k AS size, n AS a FROM f WHERE k > 1),
cut AS (SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS x, array_to_string(list_slice(w, k + 1, size), ' ') AS y
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
best AS (SELECT cut.lang, cut.phrase, cut.a, min((CAST((CAST({SCALE} AS HUGEINT) * a) // (x.n + y.n) AS BIGINT), cut.k, x.n, y.n)) AS s
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y
  GROUP BY 1, 2, 3),
inside AS (SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase FROM (
      SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i FROM (SELECT lang, a, w, size, unnest(range(2, size)) AS m FROM c)))
  GROUP BY 1, 2),
kept AS (SELECT lang, phrase, a, s FROM best LEFT JOIN inside USING (lang, phrase)
  WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST({covered} AS HUGEINT) * a)
SELECT lang, rank, phrase, a, s[3] AS l, s[4] AS r, n, s[1] AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY s[1] DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= {first}"""
