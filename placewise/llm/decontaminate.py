"""Benchmark decontamination with suffix arrays over the training documents.

The documents are the training side. Each block of documents (a shard) becomes one sequence of
word numbers, cut between documents, with a suffix array over it; every suffix of every
benchmark item is then binary-searched in the array. That gives, for each item suffix, the
length of its longest verbatim match in the shard and where it stands, and, for each window of
``WINDOW`` item words, all its occurrences. Words that no item has cannot be part of a match,
so they share the number 0 and no suffix starts at them: the array is sparse but complete.

A shard is bounded in bytes and never leaves its task: no shuffle, and a passage that a third
of all documents share costs each shard only its own copies. Items go to the tasks in pieces of
at most ``PIECE_BYTES`` of text; a larger benchmark takes one pass for each piece, and the
passes are joined for each document.

Defined results: a null or empty text has no words and is clean; an item without words has no
window; a short item is one window; repeated items count under each own item_id; repeated rows
get equal verdicts; a null item_id counts as an item but cannot be named in the digest; an
empty benchmark leaves every document clean; a very long text is a block of its own; the documents' columns
travel in one struct and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placewise.llm.blocks import WORDS_ONLY, as_bytes, bounds, over_blocks, stored, whole_text

WINDOW = 10
PIECE_BYTES = 16 << 20
UID = "_document_number"
FIELDS = ("n_words bigint, hits array<bigint>, items array<string>, n_unnamed bigint, "
          "longest struct<n_words:bigint,before:bigint,item_id:string,item_word:bigint>")
LONGEST = pa.struct([("n_words", pa.int64()), ("before", pa.int64()), ("item_id", pa.string()), ("item_word", pa.int64())])


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORDS_ONLY).split()


@dataclass
class Items:
    """Some items as one sequence of word numbers (from 1), cut by 0, with their windows."""

    numbers: dict[bytes, int]
    ids: list[str | None]
    sequence: np.ndarray
    item_of: np.ndarray     # of each place in the sequence, -1 at a cut
    window: np.ndarray      # window length at each place, 0 where none starts
    begins: np.ndarray      # where each item begins in the sequence

    @classmethod
    def of(cls, rows: list[tuple[str | None, bytes]], window: int) -> Items:
        numbers: dict[bytes, int] = {}
        sequence, item_of, lengths, begins = [], [], [], []
        for i, (_, data) in enumerate(rows):
            words = words_of(data)
            begins.append(len(sequence))
            size = min(window, len(words))
            for at, word in enumerate(words):
                sequence.append(numbers.setdefault(word, len(numbers) + 1))
                item_of.append(i)
                lengths.append(size if at + size <= len(words) else 0)
            sequence.append(0)
            item_of.append(-1)
            lengths.append(0)
        return cls(numbers, [r[0] for r in rows], np.array(sequence, dtype=np.int64),
                   np.array(item_of, dtype=np.int64), np.array(lengths, dtype=np.int64), np.array(begins, dtype=np.int64))


class SuffixArray:
    """Suffixes of a number sequence that start at a non-zero number, in order.

    0 ends a suffix. Sorting doubles the compared length; suffixes already apart rest. Ties
    beyond ``depth`` numbers stay in text order, which is all that searches up to it need.
    """

    def __init__(self, sequence: np.ndarray, depth: int):
        self.sequence = np.concatenate([sequence, np.zeros(1, dtype=np.int64)])
        self.places = np.flatnonzero(sequence)
        rank = self.sequence.copy()
        known = 1
        n = len(self.sequence)
        order = np.argsort(rank[self.places], kind="stable")
        while known < depth and len(self.places):
            after = np.minimum(self.places + known, n - 1)
            # A suffix that met its end has rank 0 from there on, whatever follows the cut.
            after = np.where(self._ended(known), n - 1, after)
            key = (rank[self.places].astype(np.uint64) << np.uint64(32)) | rank[after].astype(np.uint64)
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.cumsum(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
            rank = np.zeros(n, dtype=np.int64)
            rank[self.places[order]] = new
            known *= 2
            if new[-1] == len(new):
                break
        self.order = self.places[order]

    def _ended(self, length: int) -> np.ndarray:
        """Whether a 0 stands within the next ``length`` numbers of each suffix."""
        zeros = np.flatnonzero(self.sequence == 0)
        return zeros[np.searchsorted(zeros, self.places)] < self.places + length

    def longest(self, sequence: np.ndarray, places: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For suffixes of another sequence: longest common prefix with any suffix here (at most
        ``most`` words), and the range of the array that shares it."""
        low, high = np.zeros(len(places), dtype=np.int64), np.full(len(places), len(self.order), dtype=np.int64)
        length = np.zeros(len(places), dtype=np.int64)
        active = np.arange(len(places))
        depth = 0
        while len(active):
            active = active[most[active] > depth]
            wanted = sequence[places[active] + depth]
            a = self._bound(low[active], high[active], depth, wanted, right=False)
            b = self._bound(low[active], high[active], depth, wanted, right=True)
            found = b > a
            active, depth = active[found], depth + 1
            low[active], high[active] = a[found], b[found]
            length[active] = depth
        return length, low, high

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray, right: bool) -> np.ndarray:
        """Binary search, all queries at once: first place in [low, high) whose number at ``depth``
        is not below (or, to the right, above) the wanted one."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            middle = (low + high) // 2
            at = np.minimum(self.order[np.minimum(middle, len(self.order) - 1)] + depth, len(self.sequence) - 1)
            below = self.sequence[at] <= wanted if right else self.sequence[at] < wanted
            open_ = low < high
            low = np.where(open_ & below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low


def shard(data: list[bytes], items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents' words as item word numbers with a 0 after each document, the offsets of the
    documents in it, and their word counts."""
    words = [words_of(x) for x in data]
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    offsets = bounds(counts + 1, len(words))
    sequence = np.zeros(offsets[-1], dtype=np.int64)
    number = items.numbers.get
    for own, start in zip(words, offsets.tolist()):
        sequence[start:start + len(own)] = [number(w, 0) for w in own]
    return sequence, offsets, counts


def find_hits(block: dict[str, pa.Array], items: Items) -> list:
    """Per document: word places inside an occurrence of a window, items with one, unnamed items, and its longest match."""
    sequence, offsets, counts = shard(as_bytes(block["text"]), items)
    starts = np.flatnonzero(items.window)
    size = items.window[starts]
    hits = [[] for _ in counts]
    named: list[set[str]] = [set() for _ in counts]
    unnamed: list[set[int]] = [set() for _ in counts]
    longest: list[tuple | None] = [None] * len(counts)
    if len(starts) and sequence.any():
        array = SuffixArray(sequence, int(size.max()))
        length, low, high = array.longest(items.sequence, starts, size)
        whole = np.flatnonzero(length == size)
        runs = high[whole] - low[whole]
        begin = np.repeat(low[whole] - (np.cumsum(runs) - runs), runs)
        places = array.order[begin + np.arange(runs.sum())]
        which = np.repeat(whole, runs)
        marks = np.zeros(len(sequence) + 1, dtype=np.int64)
        np.add.at(marks, places, 1)
        np.add.at(marks, places + size[which], -1)
        covered = np.flatnonzero(np.cumsum(marks) > 0)
        of = np.searchsorted(offsets, covered, side="right") - 1
        for d in np.unique(of):
            hits[d] = covered[of == d] - offsets[d]
        pairs = np.unique(np.stack([np.searchsorted(offsets, places, side="right") - 1,
                                    items.item_of[starts[which]]]), axis=1)
        for d, i in pairs.T:
            (named[d].add(items.ids[i]) if items.ids[i] is not None else unnamed[d].add(i))
        for d, found in _longest_of(places, starts[which], size[which], offsets, items):
            longest[d] = found
    return [counts, pa.array([list(map(int, h)) for h in hits], pa.list_(pa.int64())),
            pa.array([sorted(x) for x in named], pa.list_(pa.string())), [len(x) for x in unnamed],
            pa.array([x and dict(zip(("n_words", "before", "item_id", "item_word"), x)) for x in longest], LONGEST)]


def _longest_of(places: np.ndarray, starts: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, items: Items) -> Iterator[tuple[int, tuple]]:
    """(document, (words, minus its place, item id, place in the item)) of each document's longest verbatim match.

    Windows that follow each other in the item and in the document are one match."""
    if not len(places):
        return
    order = np.lexsort((starts, places - starts))
    places, starts, sizes = places[order], starts[order], sizes[order]
    new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(places) != 1)])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(places))) + sizes[first] - 1
    doc = np.searchsorted(offsets, places[first], side="right") - 1
    word = places[first] - offsets[doc]
    best = np.lexsort((starts[first], word, -n, doc))
    for k in best[np.flatnonzero(np.diff(doc[best], prepend=-1))]:
        item = items.item_of[starts[first[k]]]
        yield int(doc[k]), (int(n[k]), -int(word[k]), items.ids[item], int(starts[first[k]] - items.begins[item]))


def longest_matches(block: dict[str, pa.Array], items: Items) -> Iterator[tuple]:
    """For each item suffix that has a match here: item id, its start, longest length, the row of
    the block and the word place of the first such match."""
    sequence, offsets, _ = shard(as_bytes(block["text"]), items)
    starts = np.flatnonzero(items.item_of >= 0)
    if not len(starts) or not sequence.any():
        return
    firsts = np.searchsorted(items.item_of[starts], items.item_of[starts])
    ends = np.flatnonzero(items.item_of < 0)
    most = ends[np.searchsorted(ends, starts)] - starts
    array = SuffixArray(sequence, int(most.max()))
    length, low, high = array.longest(items.sequence, starts, most)
    for k in np.flatnonzero(length):
        place = array.order[low[k]:high[k]].min()
        row = int(np.searchsorted(offsets, place, side="right") - 1)
        yield items.ids[items.item_of[starts[k]]], int(k - firsts[k]), int(length[k]), row, int(place - offsets[row])


def pieces(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items, fetched partition by partition, in pieces of bounded size."""
    rows: list[tuple[str | None, bytes]] = []
    size = 0
    for name, value in (benchmark.select(F.col(item_id).cast("string"), whole_text(text)).toLocalIterator()):
        data = value.encode()
        if rows and size + len(data) > limit:
            yield rows
            rows, size = [], 0
        rows.append((name, data))
        size += len(data)
    if rows:
        yield rows


def contamination(docs: DataFrame, benchmark: DataFrame, text: str | Column = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, row: list[str] | None = None,
                  piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Column ``row`` (the document), n_words, n_hit, n_items, items (sorted item ids, those found), and the
    longest verbatim match with an item: longest (words), item_id, item_word and doc_word (where it begins).

    Of equally long matches the first in the document counts, then the first item."""
    spark = docs.sparkSession
    kept = docs.columns if row is None else row

    def one_pass(source: DataFrame, own: str | Column, rows: list, columns: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast(Items.of(rows, window))
        return over_blocks(source, {"text": whole_text(own)}, lambda b: find_hits(b, shared.value), FIELDS, columns)

    parts = pieces(benchmark, item_id, item_text, piece_bytes)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        found = one_pass(docs, text, first, kept)
    else:  # the documents are numbered once, and the passes are joined by that number
        numbered = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), whole_text(text).alias("text"),
                                      F.monotonically_increasing_id().alias(UID)), "numbered")
        passes = [stored(one_pass(numbered, "text", rows, [UID]).withColumn("pass", F.lit(-number)), "hits")
                  for number, rows in enumerate(chain([first, second], parts))]
        joined = (reduce(DataFrame.union, passes).groupBy(F.col(f"row.{UID}").alias(UID))
                  .agg(F.max("n_words").alias("n_words"), F.sum("n_unnamed").alias("n_unnamed"),
                       F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
                       F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                       F.max_by("longest", F.when(F.col("longest").isNotNull(), F.struct("longest.n_words", "longest.before", "pass"))).alias("longest")))
        found = numbered.select(UID, "row").join(joined, UID).drop(UID)
    return found.select("row", "n_words", F.size("hits").cast("long").alias("n_hit"),
                        (F.size("items") + F.col("n_unnamed")).cast("long").alias("n_items"),
                        F.array_sort("items").alias("items"), F.coalesce("longest.n_words", F.lit(0)).cast("long").alias("longest"),
                        "longest.item_id", "longest.item_word", (-F.col("longest.before")).alias("doc_word"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    return contamination(docs, benchmark, **options).where("n_hit = 0").select("row.*")


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str | Column = "text",
            item_id: str = "item_id", item_text: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Longest verbatim match of every item suffix in every shard: item_id, item_word (start),
    n_words, doc_id, doc_word (place). Take the maximum over shards for the whole corpus."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = StructType.fromDDL(f"item_id string, item_word bigint, n_words bigint, doc_id {kind}, doc_word bigint")
    out = None
    for rows in pieces(benchmark, item_id, item_text, piece_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Items.of(rows, WINDOW))

        def run(batches, s=shared):
            from placewise.llm.blocks import BLOCK_BYTES, slices

            for block in slices(batches, "text", BLOCK_BYTES):
                ids = block.column("doc_id")
                found = [(i, w, n, ids[r].as_py(), p)
                         for i, w, n, r, p in longest_matches({"text": block.column("text")}, s.value)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], t) for k, t in
                     enumerate([pa.string(), pa.int64(), pa.int64(), ids.type, pa.int64()])],
                    names=[f.name for f in schema])

        part = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def items_digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", items), 256)
