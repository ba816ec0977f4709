"""SimHash near-duplicates by covering locality-sensitive hashing.

A text gets a 64-bit fingerprint; two fingerprints link when they differ in at most
``RADIUS`` bits; documents of one connected component are near-duplicates.

Candidate search. Bit i carries a non-zero code c(i) of RADIUS + 1 bits, and table v, one for
each non-zero v of as many bits, keeps exactly the fingerprint bits whose code has an odd
number of ones in common with v. If two fingerprints differ in at most RADIUS bits, the codes
of these bits span at most RADIUS dimensions, so some v is orthogonal to all of them: its mask
keeps none of the differing bits and the pair shares a bucket of table v. With radius 4 these
are 31 tables of 32 or 34 bits, and no pair within the radius can be missed.

Size. Copies collapse to distinct fingerprints before any table is made. Buckets of one
fingerprint go at once. A bucket is compared in tiles of at most two slices of ``SLICE``
fingerprints, one for each pair of slices, so a task holds a bounded piece of the hottest
bucket and every pair still meets. A tile returns one link to a root for each member of a
linked set and never its pairs. Links are joined to components by alternating large-star and
small-star rounds, each written to the shared folder.

Defined results: a null or empty text has fingerprint zero, which links like any other; rows
with equal text share a component; a null doc_id never is a component's id unless all its ids
are null; an empty table gives an empty table; input columns travel in one struct, so they
cannot clash. Whole texts count, with repeated shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm.blocks import as_bytes, bounds, over_blocks, whole_text
from placewise.llm.components import components
from placewise.session import scratch_path, shuffle_partitions

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
SLICE = 4096


# ---------------------------------------------------------------- fingerprints

def shingle_hashes(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """Hash of each run of ``shingle`` words joined by a space; of all words if they are fewer."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    starts = bounds((len(w) + 1 for w in words), len(words))
    firsts, ends = starts[:-shingle].tolist(), (starts[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(firsts, ends)),
                       dtype=np.uint64, count=len(firsts))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(block: dict[str, pa.Array], shingle: int, seed: int) -> list:
    prints = [fingerprint(shingle_hashes(x.lower().split(), shingle, seed)) for x in as_bytes(block["text"])]
    return [pa.array(np.array(prints, dtype=np.uint64).view(np.int64))]


def with_fingerprint(docs: DataFrame, text: str | Column = "text", row: list[str] | None = None,
                     shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Column ``row`` (the document) and its fingerprint ``fp`` as a signed long. No shuffle."""
    return over_blocks(docs, {"text": whole_text(text)}, partial(_fingerprints, shingle=shingle, seed=seed),
                       "fp bigint", row)


# ---------------------------------------------------------------- links

def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The masks, as signed longs. Codes run through all non-zero values in turn, so that every
    mask keeps about half of the bits."""
    top = (1 << (radius + 1)) - 1
    codes = [i % top + 1 for i in range(bits)]
    masks = [sum(1 << i for i, c in enumerate(codes) if (c & v).bit_count() % 2) for v in range(1, top + 1)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def linked_sets(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each of some distinct fingerprints the smallest one reachable by links among them."""
    roots, left, bits = prints.copy(), np.arange(len(prints)), prints.view(np.uint64)
    while len(left):
        frontier, members = left[:1], [left[:1]]
        left = left[1:]
        while len(frontier) and len(left):
            here, frontier = frontier[0], frontier[1:]
            near = np.bitwise_count(bits[left] ^ bits[here]) <= radius
            if near.any():  # found ones are never compared with each other again
                members.append(left[near])
                frontier = np.concatenate([frontier, left[near]])
                left = left[~near]
        own = np.concatenate(members)
        roots[own] = prints[own].min()
    return roots


def _link_tiles(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by tile; the last tile of a batch waits for the next batch."""
    names = ["mask", "bucket", "tile", "fp"]
    held: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * 4

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        *key, prints = columns
        change = np.zeros(len(prints), dtype=bool)
        change[:1] = True
        for k in key:
            change[1:] |= k[1:] != k[:-1]
        starts = np.flatnonzero(change)
        out_a, out_b = [], []
        for a, b in zip(starts, [*starts[1:], len(prints)]):
            roots = linked_sets(prints[a:b], radius)
            moved = roots != prints[a:b]
            out_a.append(prints[a:b][moved])
            out_b.append(roots[moved])
        none = np.zeros(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *out_a])),
                                           pa.array(np.concatenate([none, *out_b]))], names=["a", "b"])

    for batch in batches:
        columns = [np.concatenate([h, batch.column(n).to_numpy(zero_copy_only=False)]) for h, n in zip(held, names)]
        if not len(columns[0]):
            continue
        last = np.ones(len(columns[0]), dtype=bool)
        for c in columns[:3]:
            last &= c == c[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        held = [c[cut:] for c in columns]
        if cut:
            yield links([c[:cut] for c in columns])
    if len(held[0]):
        yield links(held)


def links(prints: DataFrame, radius: int = RADIUS, slice_rows: int = SLICE) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp`` within the radius."""
    masks = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius)])
    bucketed = (prints.select("fp", F.posexplode(masks).alias("mask", "kept"))
                .select("fp", F.col("mask").cast("long").alias("mask"), F.col("fp").bitwiseAND(F.col("kept")).alias("bucket")))
    shared = bucketed.groupBy("mask", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    n_slices = F.ceil(F.col("n") / slice_rows)
    own = F.pmod(F.xxhash64("fp"), n_slices)
    other = F.explode(F.sequence(F.lit(0).cast("long"), n_slices - 1))
    # Spark takes the rows of an explode to be as many as before it, so it would broadcast the tables' 31 rows for each print.
    tiles = (bucketed.join(shared.hint("merge"), ["mask", "bucket"])
             .select("mask", "bucket", "fp", own.alias("own"), n_slices.alias("slices"), other.alias("other"))
             .select("mask", "bucket", "fp",
                     (F.least("own", "other") * F.col("slices") + F.greatest("own", "other")).alias("tile")))
    parts = shuffle_partitions(prints.sparkSession)
    return (tiles.repartition(parts, "mask", "bucket", "tile").sortWithinPartitions("mask", "bucket", "tile")
            .mapInArrow(partial(_link_tiles, radius=radius), "a bigint, b bigint"))


def fingerprint_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for every distinct fingerprint that links to another one."""
    return components(links(prints, radius)).withColumnRenamed("node", "fp")


# ---------------------------------------------------------------- documents

def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text",
                    radius: int = RADIUS) -> DataFrame:
    """One row for each document: doc_id, fp and component_id, the smallest doc_id reachable."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    with_fingerprint(docs, text, [doc_id]).select(F.col(f"row.`{doc_id}`").alias("doc_id"), "fp").write.parquet(path)
    rows = spark.read.parquet(path)
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = fingerprint_components(firsts.select("fp"), radius)
    rooted = (firsts.join(roots, "fp", "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text",
             radius: int = RADIUS) -> DataFrame:
    """The documents' own columns, one document of each component: that of the smallest doc_id.

    Of repeated rows of that doc_id one stays. A component whose ids are all null keeps one row.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprinted")
    # Written with a row number, so that repeated rows can be told apart also after a lost executor.
    (with_fingerprint(docs, text).withColumn("uid", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path)
    key = F.struct(F.col(f"row.`{doc_id}`").isNull().alias("last"), F.col(f"row.`{doc_id}`").alias("id"), F.col("uid"))
    firsts = rows.groupBy("fp").agg(F.min(key).alias("first"))
    roots = fingerprint_components(firsts.select("fp"), radius)
    kept = (firsts.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("first").alias("first")).select(F.col("first.uid").alias("uid")))
    return rows.join(kept, "uid", "left_semi").select("row.*")
