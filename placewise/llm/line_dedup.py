"""Line dedup by a segment-partition edit join, with DataFrame functions only.

A line is dropped when an equal line, or one within ``EDITS`` edits, stands earlier (in an earlier
document, or earlier in the same one). Lines shorter than ``LEAST`` characters are only compared
for equality, since an edit makes another word of them.

1. Lines are exploded and joined to distinct ones by a 128-bit digest, partly before the shuffle, with their first
   position. Only digests and keys travel until candidates are known, then the texts of those.
2. A line is split into EDITS + 1 segments. Of two lines within EDITS edits the shorter has a
   segment that the longer has unchanged, at a place that its number and the lengths bound. So
   each line is stored under its segments, with number and length, and probes the substrings
   at those places for its own and each smaller length.
3. A key under which more than ``HOT`` lines are stored makes no pairs. Its lines are grouped by what is left of them
   without one character of the other segment (``crowded_links``): what stands in one group is linked, so work and rows
   follow the lines and not their square. That segment is narrowed before (``narrowed``): it is cut into ``PARTS`` parts
   again and again, and a line stays with the parts outside of which another one agrees with it. A pair that shares both
   its segments counts by the first (``_elsewhere``), so none is counted twice.
   More than one edit would need too many such groups; there all keys make pairs.
4. Pairs that share any other key are dealt evenly and judged, each pair by itself: by the counts of some letters, which
   differ by no more than the edits allow; then, without their common start and end, by a banded
   bit-parallel automaton: for each number of edits one integer holds the diagonals of the band reached so far.
   The automaton goes over its input once, so a pair costs time in proportion to its lines.

Skew: a line that a third of all documents share is one row from step 1 on; a group of step 3 has at most a line for each
character of the alphabet, and the lines with one more.

Defined results: a null text has no lines; lines are split at \\n and compared whole, empty ones
too; each row is a document of its own, in the order of doc_id, rows of one doc_id in the order of a digest of their
texts, null ids last; of equal rows any one counts as the first; an empty table gives an empty table. Very long
lines cost memory and time in proportion. Ids must be integers; a document has fewer than 2**27 lines.
Input columns travel in one struct and cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewise.llm.blocks import stored
from placewise.operators.ordering import number_rows
from placewise.session import shuffle_partitions

EDITS = 1
LEAST = 16
#: Letters whose counts are compared before verification; an edit changes at most two counts by one.
LETTERS = "etaonisrhldumc"
#: A position is the document's place and, in the lower bits, the line's number.
LINES_BITS = 27
PLACES = 1 << (63 - LINES_BITS)
#: The last bits of a key are the number of its segment.
NUMBER_BITS = 4
#: Lines stored under one key beyond which they are grouped and not paired.
HOT = 8
#: Parts into which the free places of a crowded line are cut at a time, until there are ``FEW`` of them.
PARTS = 8
FEW = 8
#: Bits of the filter of paired lines (2 MB). A full one only costs moving lines that have no partner.
FILTER_BITS = 1 << 24


def _segment(length: Column, number: int, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and size of a segment: all sizes differ by one at most, longer ones last."""
    parts = edits + 1
    size, longer = F.floor(length / parts).cast("int"), F.pmod(length, F.lit(parts))
    before = number * size + F.greatest(number - (parts - longer), F.lit(0))
    return before + 1, size + F.when(number >= parts - longer, 1).otherwise(0)


def _key(number: int, length: Column, piece: Column) -> Column:
    return F.shiftleft(F.xxhash64(length, piece), NUMBER_BITS) + F.lit(number)


def _number(key: str) -> Column:
    return F.col(key).bitwiseAND(F.lit((1 << NUMBER_BITS) - 1)).cast("int")


def _stored_keys(line: Column, edits: int) -> list[Column]:
    length = F.char_length(line)
    out = []
    for number in range(edits + 1):
        start, size = _segment(length, number, edits)
        out.append(_key(number, length, F.substr(line, start, size)))
    return out


def _probe_keys(line: Column, edits: int, less: int | None = None) -> list[Column]:
    """Keys under which lines of own length or shorter by up to ``edits`` (or by ``less``) may be stored."""
    length, out = F.char_length(line), []
    for less in range(edits + 1) if less is None else (less,):
        other = length - less
        for number in range(edits + 1):
            start, size = _segment(other, number, edits)
            low, high = max(-number, less - (edits - number)), min(number, less + (edits - number))
            out += [_key(number, other, F.substr(line, start + shift, size)) for shift in range(low, high + 1)]
    return out


def placed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: list[str] | None = None) -> DataFrame:
    """row (a struct), place (a number for each row, in the order of documents), text.

    Ids that are different and small enough are places themselves; otherwise the rows are sorted and numbered.
    """
    kept = docs.columns if row is None else row
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    n, different, least, most = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc")).agg(
        F.count(F.lit(1)), F.count_distinct("doc"), F.min("doc"), F.max("doc")).first()
    if n == different and (not n or (least >= 0 and most < PLACES)):
        return plain.withColumnRenamed("doc", "place")
    order = [F.asc_nulls_last("doc"), F.asc("a"), F.asc("b")]
    marked = plain.withColumns({"a": F.xxhash64("text"), "b": F.xxhash64("text", F.lit("text"))})
    return number_rows(marked, order, "place").select("row", "place", "text")


def lines_of(documents: DataFrame) -> DataFrame:
    """id (a 128-bit digest), position, line of every line of documents with their places."""
    lines = documents.select("place", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    fits = F.when(F.col("no") < (1 << LINES_BITS), F.col("no")).otherwise(F.raise_error(F.lit("a document has too many lines")).cast("int"))
    digest = F.struct(F.xxhash64("line").alias("high"), F.xxhash64("line", F.lit("line")).alias("low"))
    return lines.select(digest.alias("id"), (F.shiftleft("place", LINES_BITS) + fits).alias("position"), "line")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """A stored row for each distinct line, without its text: id, first position, number of places ``n``."""
    return stored(lines.groupBy("id").agg(F.min("position").alias("position"), F.count(F.lit(1)).alias("n")), "distinct-lines", "zstd")


def compared(lines: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """The lines that are long enough to have near ones."""
    return lines.where(F.char_length("line") >= max(least, edits + 1))


def stored_keys(lines: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """o_id, o_length, o_key: the keys of each distinct line. Those of repeated lines become one before they move."""
    return (compared(lines, edits, least)
            .select(F.col("id").alias("o_id"), F.char_length("line").alias("o_length"), F.explode(F.array(*_stored_keys(F.col("line"), edits))).alias("o_key"))
            .distinct())


def crowded_keys(keys: DataFrame, hot: int = HOT) -> DataFrame:
    """Keys under which more than ``hot`` lines are stored."""
    return keys.groupBy(F.col("o_key").alias("key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("key")


def candidate_pairs(lines: DataFrame, edits: int = EDITS, least: int = LEAST, keys: DataFrame | None = None) -> DataFrame:
    """Ids of a line and an as long or shorter one (id, o_id) that share a key, and the segments they share (``numbers``, a bit
    for each): each pair once. ``keys`` are the stored keys to look into, by default all."""
    length = F.char_length("line").alias("length")
    left = compared(lines, edits, least).select("id", length, F.explode(F.array(*_probe_keys(F.col("line"), edits))).alias("key")).distinct()
    right = stored_keys(lines, edits, least) if keys is None else keys
    less = F.col("length") - F.col("o_length")
    once = (less > 0) | (F.col("id") > F.col("o_id"))
    meet = (F.col("key") == F.col("o_key")) & (less >= 0) & (less <= edits) & once
    return left.join(right, meet).groupBy("id", "o_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), _number("key"))).alias("numbers"))


def _bit(id: str = "id") -> tuple[Column, Column]:
    """The word of the filter and the bit in it of a line."""
    place = F.col(f"{id}.high").bitwiseAND(F.lit(FILTER_BITS - 1))
    return F.shiftright(place, 6).cast("int"), F.expr(f"shiftleft(1L, cast({id}.high & 63 AS INT))")


def marked(wanted: DataFrame) -> Column:
    """``FILTER_BITS`` bits as an array, those of the ``wanted`` ids set: a table of fixed size, so that most lines
    that no pair names need not move to find that out."""
    word, bit = _bit()
    found = wanted.select(word.cast("long").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = wanted.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "word").join(found, "word", "left")
    ordered = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(ordered, lambda x: x["bits"]).alias("bits")).scalar()


def texts_of(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """A stored row (id, line) for each ``wanted`` id."""
    wanted = stored(wanted.distinct(), "wanted-lines")
    word, bit = _bit()
    likely = lines.where(F.get(marked(wanted), word).bitwiseAND(bit) != 0)
    return stored(likely.groupBy("id").agg(F.min("line").alias("line")).join(wanted, "id", "left_semi"), "paired-lines", "zstd")


def _parts(members: DataFrame) -> DataFrame:
    """A row for each of ``PARTS`` parts of the free places of ``members``, under a key of what is free outside of it."""
    size, piece, i = F.col("size"), F.col("piece"), F.col("long").cast("int")
    out = []
    for part in range(PARTS):
        before, upto = (F.floor(size * n / PARTS).cast("int") for n in (part, part + 1))
        key = F.xxhash64("key", F.lit(part), F.left(piece, before), F.right(piece, size - upto))
        out.append(F.struct(key.alias("key"), (F.col("start") + before).alias("start"), (upto - before).alias("size"),
                            F.substr(piece, before + 1, upto - before + i).alias("piece")))
    return members.select("id", "long", F.explode(F.filter(F.array(*out), lambda x: x["size"] > 0)).alias("part")).select("id", "part.key", "long", "part.start", "part.size", "part.piece")


def narrowed(members: DataFrame) -> DataFrame:
    """``members`` (id, key, long, start and size of the free places, and the ``piece`` of the line that is there, which
    in a long line has a character more) with at most ``FEW`` free places each.

    Lines of a key agree but for their free places. If two of them are one edit apart, the edit is in one part and they agree
    in the others, so each part makes a key of the others, and only lines that share it stay, with this part alone.
    Places are dealt to parts, so a line never has more of them than before, and a pair is met in one part only.
    """
    width = members.agg(F.max("size")).first()[0] or 0
    while width > FEW:
        wide = _parts(members.where(F.col("size") > FEW))
        # Stored for its size to be known: a few keys are broadcast, so no crowded key meets in one task.
        shared = stored(wide.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("long")).alias("short"))
                        .where((F.col("n") > 1) & (F.col("short") > 0)).select("key"), "crowded-parts")
        members = stored(wide.join(shared, "key", "left_semi").unionByName(members.where(F.col("size") <= FEW)), "crowded-pieces", "zstd")
        width = -(-width // PARTS)
    return members


def crowded_links(lines: DataFrame, known: DataFrame, keys: DataFrame, crowded: DataFrame, least: int = LEAST) -> DataFrame:
    """id, n_links and o_position (the first position of a linked line) by the ``crowded`` keys, for one edit and without pairs.

    Lines of one length that agree without their character ``at`` are one edit apart; so are a line and one that is left of
    it without a character, here the last of a run of equal ones. Under a crowded key this character is in the segment
    that the key does not hold, and of this in the parts that ``narrowed`` leaves: a line is written once for each place there.
    """
    short = keys.join(crowded, F.col("o_key") == F.col("key"), "left_semi").select(F.col("o_id").alias("id"), F.col("o_key").alias("key"))
    probes = compared(lines, 1, least).select("id", F.explode(F.array(*_probe_keys(F.col("line"), 1, less=1))).alias("key"))
    long = probes.join(crowded, "key", "left_semi").select("id", "key").distinct()
    members = stored(short.withColumn("long", F.lit(False)).unionByName(long.withColumn("long", F.lit(True))), "crowded-lines")
    texts = texts_of(lines, members.select("id"))
    line, i = F.col("line"), F.col("long").cast("int")
    length = F.char_length(line) - i  # of the short lines
    half, first = F.floor(length / 2).cast("int"), _number("key") == 0  # the key holds the first segment
    free = (members.join(texts, "id").withColumns({"start": F.when(first, half + 1).otherwise(F.lit(1)), "size": F.when(first, length - half).otherwise(half)})
            .select("id", "key", "long", "start", "size", F.substr(line, F.col("start"), F.col("size") + i).alias("piece")))
    members = narrowed(stored(free, "crowded-pieces", "zstd")).select("id", "long", "start", "size")
    end = F.col("start") + F.col("size") - 1
    # What a long line has more at its very end is a place of the last part.
    places = F.sequence(F.col("start"), end + F.when(end == length, i).otherwise(F.lit(0)))
    last = F.filter(places, lambda k: F.substr(line, k, F.lit(1)) != F.substr(line, k + 1, F.lit(1)))

    def left(k: Column) -> Column:
        rest = F.concat(F.substr(line, F.lit(1), k - 1), F.substr(line, k + 1))
        return F.struct(F.when(F.col("long"), F.lit(0)).otherwise(k).alias("at"),
                        F.struct(F.xxhash64(rest).alias("high"), F.xxhash64(rest, F.lit("line")).alias("low")).alias("rest"))

    placed = members.join(texts, "id").join(known.select("id", "position"), "id")
    cut = (placed.select("id", "position", "long", F.explode(F.transform(F.when(F.col("long"), last).otherwise(places), left)).alias("cut"))
           .select("id", "position", "long", "cut.at", "cut.rest"))
    whole = placed.where(~F.col("long")).select("id", "position", "long", F.lit(0).alias("at"), F.col("id").alias("rest")).distinct()
    group, at = Window.partitionBy("at", "rest"), cut.unionByName(whole)

    def others(count, position) -> dict[str, Column]:
        return {"n": count, "first": F.min(position).over(group)}

    long, position = F.col("long"), F.col("position")
    cases = {"same": others(F.count(F.lit(1)).over(group) - 1, position),
             "long": others(F.count_if(~long).over(group), F.when(~long, position)),
             "short": others(F.count_if(long).over(group), F.when(long, position))}
    pick = lambda c: F.when(F.col("at") > 0, cases["same"][c]).when(long, cases["long"][c]).otherwise(cases["short"][c])
    return (at.select("id", pick("n").alias("n"), pick("first").alias("first")).where(F.col("n") > 0)
            .groupBy("id").agg(F.min("first").alias("o_position"), F.sum("n").alias("n_links")))


def letters_apart(a: Column, b: Column) -> Column:
    """By how much the counts of ``LETTERS`` differ, together."""
    def times(line: Column, c: str) -> Column:
        return F.char_length(line) - F.char_length(F.replace(line, F.lit(c), F.lit("")))

    return reduce(Column.__add__, [F.abs(times(a, c) - times(b, c)) for c in LETTERS])


def without_common_ends(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the strings ``a`` and ``b`` cut to what is between their common start and end.

    Each step is a column of its own, so that nothing is computed once for each use."""
    def differ(df: DataFrame) -> DataFrame:
        apart = F.zip_with(F.split(F.col(a), ""), F.split(F.col(b), ""), lambda x, y: ~x.eqNullSafe(y))
        at = df.withColumn("_at", F.array_position(apart, F.lit(True)))
        rest = {c: F.when(F.col("_at") == 0, F.lit("")).otherwise(F.substr(F.col(c), F.col("_at").cast("int"))) for c in (a, b)}
        return at.withColumns({c: F.reverse(x) for c, x in rest.items()}).drop("_at")

    return differ(differ(pairs))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings are within ``edits`` edits, by a banded bit-parallel automaton.

    After j characters of b, bit d + edits of state k is set if the first j + d characters of a
    can be reached with k edits. Each character of b comes with those of a in its band.
    """
    band = (1 << (2 * edits + 1)) - 1
    left, right = F.split(a, ""), F.split(b, "")
    nothing = F.array(*[F.lit(None).cast("string")] * edits)
    # Element j of ``shown`` is the character of a in diagonal d; arrays end in nulls where a does.
    padded = F.concat(nothing, left)
    shown = {d: F.slice(padded, F.lit(edits + d + 1), F.greatest(F.size(left) - d, F.lit(0))) for d in range(-edits, edits + 1)}
    bands = F.slice(F.arrays_zip(right.alias("now"), *[x.alias(f"d{d + edits}") for d, x in shown.items()]), F.lit(1), F.size(right))

    def shifted(x: Column, by: int) -> Column:
        return (F.shiftleft(x, by) if by > 0 else F.shiftright(x, -by)).bitwiseAND(band)

    def step(state: Column, c: Column) -> Column:
        match = reduce(Column.bitwiseOR, [F.when(c[f"d{d}"] == c["now"], F.lit(1 << d)).otherwise(F.lit(0)) for d in range(2 * edits + 1)])
        after: list[Column] = []
        for k in range(edits + 1):
            reached = state[f"r{k}"].bitwiseAND(match)
            if k:
                before = state[f"r{k - 1}"]
                reached = reached.bitwiseOR(before).bitwiseOR(shifted(before, -1)).bitwiseOR(shifted(after[k - 1], 1))
            after.append(reached)
        return F.struct(*[x.alias(f"r{k}") for k, x in enumerate(after)])

    start = [reduce(int.__or__, [1 << (d + edits) for d in range(k + 1)]) for k in range(edits + 1)]
    first = F.struct(*[F.lit(x).alias(f"r{k}") for k, x in enumerate(start)])
    last = F.when(F.char_length(b) > 0, F.aggregate(bands, first, step)).otherwise(first)
    shift = F.char_length(a) - F.char_length(b) + edits
    ok = last[f"r{edits}"].bitwiseAND(reduce(
        lambda so_far, s: F.when(shift == s, F.lit(1 << s)).otherwise(so_far), range(2 * edits + 1), F.lit(0)))
    return (F.abs(F.char_length(a) - F.char_length(b)) <= edits) & (ok != 0)


def _elsewhere(numbers: Column, start: Column, o_start: Column) -> Column:
    """Whether a pair that was found by its second segment only has the first one in common, whose key is crowded then."""
    return (numbers == 2) & (start == o_start)


def judged_pairs(lines: DataFrame, pairs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The ``pairs`` and whether their lines are within ``edits`` edits (``near``). Only paired lines bring their texts.

    With one edit, a pair whose lines share the first segment too, but not in ``pairs``, is left to ``crowded_links``."""
    texts = texts_of(lines, pairs.select("id").union(pairs.select("o_id")))
    met = (pairs.join(texts, "id").join(texts.select(F.col("id").alias("o_id"), F.col("line").alias("o_line")), "o_id")
           .where(letters_apart(F.col("line"), F.col("o_line")) <= 2 * edits))
    if edits == 1:
        _, half = _segment(F.char_length("o_line"), 0, edits)
        met = met.where(~_elsewhere(F.col("numbers"), F.substr(F.col("line"), F.lit(1), half), F.substr(F.col("o_line"), F.lit(1), half)))
    # Few bytes but much work: dealt by number, since sizes would leave it in a few tasks. The verdict is a column and
    # not a filter, which would be moved back into the join.
    met = met.repartition(shuffle_partitions(pairs.sparkSession)).select("id", "o_id", F.col("line").alias("a"), F.col("o_line").alias("b"))
    return without_common_ends(met, "a", "b").select("id", "o_id", within_edits(F.col("a"), F.col("b"), edits).alias("near"))


def judged_lines(documents: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """A row for each distinct line: n, place and no of its first position, n_links, and whether an
    earlier line within the edits makes it ``near``."""
    lines = lines_of(documents)
    known = distinct_lines(lines)
    keys = stored(stored_keys(lines, edits, least), "line-keys", "zstd")
    sparse, crowded = keys, None
    if edits == 1:
        crowded = stored(crowded_keys(keys, HOT), "crowded-keys")
        sparse = keys.join(crowded, F.col("o_key") == F.col("key"), "left_anti")
    pairs = stored(candidate_pairs(lines, edits, least, sparse), "line-pairs")
    links = stored(judged_pairs(lines, pairs, edits), "line-links").where("near").select("id", "o_id")
    place = known.select("id", "position")
    both = (links.union(links.select("o_id", "id"))
            .join(place.select(F.col("id").alias("o_id"), F.col("position").alias("o_position")), "o_id")
            .select("id", "o_position", F.lit(1).cast("long").alias("n_links")))
    if crowded is not None:
        both = both.unionByName(crowded_links(lines, known, keys, crowded, least))
    earliest = both.groupBy("id").agg(F.min("o_position").alias("o_position"), F.sum("n_links").alias("n_links"))
    return (known.select("id", "n", "position").join(earliest, "id", "left")
            .select("n", F.shiftright("position", LINES_BITS).alias("place"),
                    F.col("position").bitwiseAND(F.lit((1 << LINES_BITS) - 1)).cast("int").alias("no"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce(F.col("o_position") < F.col("position"), F.lit(False)).alias("near")))


def dedupe_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS, least: int = LEAST,
                 row: list[str] | None = None) -> DataFrame:
    """Column ``row`` (the document), n_lines, n_equal (dropped for an equal earlier line), n_near (for a
    near one), n_kept, n_links of its first lines, and kept_text."""
    documents = placed_documents(docs, doc_id, text, row)
    own = judged_lines(documents, edits, least).groupBy("place").agg(
        F.count_if(~F.col("near")).alias("n_kept"), F.count_if("near").alias("n_near"), F.sum("n_links").alias("n_links"),
        F.collect_list(F.when(~F.col("near"), F.col("no"))).alias("places"))
    lines = F.coalesce(F.split("text", "\n", -1), F.array().cast("array<string>"))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    places = F.coalesce("places", F.array().cast("array<int>"))
    picked = F.array_join(F.transform(F.array_sort(places), lambda i: F.get("lines", i)), "\n")
    return (documents.join(own, "place", "left").withColumn("lines", lines)
            .select("row", F.size("lines").cast("long").alias("n_lines"),
                    (F.size("lines") - F.coalesce("n_kept", F.lit(0)) - F.coalesce("n_near", F.lit(0))).cast("long").alias("n_equal"),
                    count("n_near"), count("n_kept"), count("n_links"), picked.alias("kept_text")))


def dedupe_sql(edits: int = EDITS, least: int = LEAST) -> str:
    """The same for DuckDB with one edit: lines of equal or next length that agree but for one place."""
    if edits != 1:
        raise ValueError("the SQL form is written for one edit")
    return f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                     unnest(range(len(string_split(text, chr(10))))) AS no FROM documents),
d AS MATERIALIZED (SELECT line, length(line) AS n, min((doc_id, no)) AS place,
  left(line, length(line) // 2) AS head, substr(line, length(line) // 2 + 1) AS tail FROM l GROUP BY line),
pairs AS (
  SELECT a.line, b.line AS other, a.place, b.place AS other_place, a.n AS n, b.n AS m FROM d a JOIN d b
    ON a.n = b.n AND a.head = b.head AND a.line <> b.line WHERE a.n >= {least}
  UNION SELECT a.line, b.line, a.place, b.place, a.n, b.n FROM d a JOIN d b
    ON a.n = b.n AND a.tail = b.tail AND a.line <> b.line WHERE a.n >= {least}
  UNION SELECT a.line, b.line, a.place, b.place, a.n, b.n FROM d a JOIN d b
    ON a.n = b.n + 1 AND left(a.line, b.n // 2) = b.head WHERE b.n >= {least}
  UNION SELECT a.line, b.line, a.place, b.place, a.n, b.n FROM d a JOIN d b
    ON a.n = b.n + 1 AND substr(a.line, b.n // 2 + 2) = b.tail WHERE b.n >= {least}),
links AS (SELECT * FROM pairs WHERE len(list_filter(range(m + 1), lambda k:
    left(line, k) = left(other, k) AND substr(line, k + 2) = substr(other, CASE WHEN n = m THEN k + 2 ELSE k + 1 END))) > 0),
sides AS (SELECT line, place, other_place FROM links
  UNION ALL SELECT other, other_place, place FROM links WHERE n > m),
near AS (SELECT line, count(*) AS n_links, min(other_place) < any_value(place) AS near FROM sides GROUP BY line),
own AS (SELECT place[1] AS doc_id, count(*) FILTER (WHERE NOT coalesce(near, FALSE)) AS n_kept,
  count(*) FILTER (WHERE near) AS n_near, sum(coalesce(n_links, 0)) AS n_links,
  string_agg(d.line, chr(10) ORDER BY place) FILTER (WHERE NOT coalesce(near, FALSE)) AS kept_text
  FROM d LEFT JOIN near USING (line) GROUP BY 1)
SELECT documents.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(string_split(text, chr(10))), 0) - coalesce(n_kept, 0) - coalesce(n_near, 0) AS BIGINT) AS n_equal,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CAST(coalesce(n_kept, 0) AS BIGINT) AS n_kept,
  CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM documents LEFT JOIN own USING (doc_id)"""
