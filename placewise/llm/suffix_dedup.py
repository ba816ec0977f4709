"""Removal of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in an earlier document,
or earlier in the same one) is removed. Strings are compared as bytes, on the input.

1. Anchors. The ``GRAM``-byte string of the smallest hash inside a window of ``LENGTH`` bytes is the
   window's anchor (the leftmost of equal ones). Equal windows have equal anchors at equal distances,
   so windows are dealt by anchor and can only meet there. Neighbouring windows with one anchor
   form a segment; an anchor that the corpus has once settles its windows without more work.
2. Segments of the other anchors are dealt by anchor. Of equal segments the first stays and the
   others are repeats. Anchors with several different segments go to step 3.
3. Transform. A shard of segments is ordered by its suffixes, which gives its Burrows-Wheeler
   transform. Rows that start with different symbols have a common prefix of 0. Breadth first, by
   increasing value, each neighbouring pair of equal symbols in the transform is extended backward:
   once the interval between them is split by a prefix of length l, the rows they lead to share
   l + 1 symbols. The expansion stops below ``LENGTH``; rows not split by then share ``LENGTH`` bytes
   or more, and in each such interval the first window stays and the others are repeats.

Skew. Equal segments are joined inside each block before any shuffle. An anchor with more than
``HOT`` segments is dealt over several shards by segment; the windows that remain there as first
meet again by a 128-bit digest of their bytes. Tasks hold one shard; documents stay in their
blocks, which read the anchors and repeats that concern them from the shared folder.

Defined results: a null text is the empty text; strings never cross documents; texts shorter than
``LENGTH`` bytes are kept; equal doc_ids are ordered by their row number, so of repeated rows the
first stays; null doc_ids come last; an empty table gives an empty table. Ids must be integers.
Input columns travel in one struct and cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewise.llm.blocks import BLOCK_BYTES, as_bytes, bounds, slices, stored, whole_text
from placewise.llm.side_tables import block_rows, by_block, write_by_block
from placewise.session import shuffle_partitions

LENGTH = 100
GRAM = 32
HOT = 20_000
SHARD_BYTES = 2 << 20

_PLACE_BITS = 31  # of a place in a block; the hash order uses the bits above
_PIECE = "kind int, block bigint, doc bigint, uid bigint, start bigint, stop bigint, anchor bigint, before bigint, segment binary"
_REPEAT = "block bigint, uid bigint, start bigint, stop bigint"
_WINDOW = f"{_REPEAT}, doc bigint, high bigint, low bigint"


# ---------------------------------------------------------------- anchors

def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE_VALUES = _odd(1, 256)
_BASE = int(_odd(2, 1)[0])
_MIX = int(_odd(3, 1)[0])


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Polynomial hash of the ``gram`` (a power of two) bytes from each place on, mixed."""
    out, width, factor = _BYTE_VALUES[data], 1, _BASE
    while width < gram:
        out = out[:-width] * np.uint64(factor) + out[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    out ^= out >> np.uint64(32)
    out *= np.uint64(_MIX)
    out ^= out >> np.uint64(29)
    return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        values, have = np.minimum(values[:-have], values[have:]), 2 * have
    return np.minimum(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor place: document, first and last window start, anchor place
    (places in the joined texts) and the anchor's hash; and the joined texts and their offsets."""
    joined = b"".join(texts)
    offsets = bounds(map(len, texts), len(texts))
    if len(joined) < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none, joined, offsets
    hashes = gram_hashes(np.frombuffer(joined, dtype=np.uint8), gram)
    keys = (hashes >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least(keys, length - gram + 1)
    place = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    doc = np.searchsorted(offsets, np.arange(len(place)), side="right") - 1 if len(texts) > 1 else np.zeros(len(place), np.int64)
    valid = np.flatnonzero(np.arange(len(place)) + length <= offsets[doc + 1])
    if not len(valid):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none, joined, offsets
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (place[valid[1:]] != place[valid[:-1]]) | (valid[1:] != valid[:-1] + 1)
    first = valid[new]
    last = valid[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(valid) - 1]])]
    return doc[first], first, last, place[first], hashes[place[first]].view(np.int64), joined, offsets


def _anchors(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(anchor, block, n) for the anchors of each block; n is 2 if the block has it again."""
    for batch in slices(batches, "text", BLOCK_BYTES):
        blocks = batch.column("block").to_numpy()
        *_, hashes, _, _ = found = segments(as_bytes(batch.column("text")), length, gram)
        own = blocks[found[0]] if len(hashes) else np.zeros(0, dtype=np.int64)
        for block in np.unique(own):
            anchor, n = np.unique(hashes[own == block], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(np.full(len(anchor), block, dtype=np.int64)),
                                              pa.array(np.minimum(n, 2))], names=["anchor", "block", "n"])


# ---------------------------------------------------------------- segments

def _pieces(batches: Iterator[pa.RecordBatch], shared: str, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Segments of repeated anchors (kind 0), equal ones of a block only once, their repeats (kind 1)."""
    at, known = None, np.zeros(0, dtype=np.int64)
    for block, batch in by_block(batches):
        if block != at:
            rows = block_rows(shared, block, ["anchor"])
            at, known = block, np.unique(rows.column("anchor").to_numpy()) if rows is not None else np.zeros(0, np.int64)
        if not len(known):
            continue
        doc, first, last, place, anchor, joined, offsets = segments(as_bytes(batch.column("text")), length, gram)
        spot = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
        own = np.flatnonzero(known[spot] == anchor)
        ids, uids = batch.column("doc").to_numpy()[doc[own]].tolist(), batch.column("uid").to_numpy()[doc[own]].tolist()
        starts = (first[own] - offsets[doc[own]]).tolist()
        firsts: dict[tuple, tuple] = {}
        kept, repeats = [], []
        for k, (a, b, p, h) in enumerate(zip(first[own].tolist(), (last[own] + length).tolist(), place[own].tolist(), anchor[own].tolist())):
            row = (ids[k], uids[k], starts[k], starts[k] + b - a)
            key = (h, p - a, joined[a:b])
            before = firsts.setdefault(key, row)
            if before is not row:
                firsts[key], other = (row, before) if row < before else (before, row)
                repeats.append(other)
        kept = [(*row, *key) for key, row in firsts.items()]
        n, m = len(kept), len(repeats)
        columns = [[0] * n + [1] * m, [block] * (n + m)]
        columns += [[r[i] for r in kept] + [r[i] for r in repeats] for i in range(4)]
        columns += [[r[i] for r in kept] + [None] * m for i in (4, 5, 6)]
        kinds = [pa.int32(), *[pa.int64()] * 7, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         names=[f.split()[0] for f in _PIECE.split(", ")])


# ---------------------------------------------------------------- transform

def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``symbols`` (0 ends a suffix, others up to 511) by the suffix that starts there,
    compared over at least ``depth`` symbols; equal ones by place."""
    n, width = len(symbols), 7
    ends = np.flatnonzero(symbols == 0)
    to_end = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    padded = np.concatenate([symbols, np.zeros(width, dtype=symbols.dtype)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        key = key << np.uint64(9) | np.where(to_end >= k, padded[k:k + n], np.uint64(0))
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        if width >= depth:
            return order
        after = np.minimum(np.arange(n) + width, n - 1)
        key = rank << np.uint64(32) | np.where(to_end >= width, rank[after] + np.uint64(1), np.uint64(0))
        width *= 2


def prefix_intervals(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order, and for each whether it shares less than ``length`` symbols with the one before.

    Values are found by increasing length, by backward extension on the transform."""
    order = suffix_order(symbols, length)
    n = len(order)
    transform = np.where(order > 0, symbols[order - 1], 0).astype(np.uint16)
    came_from = np.argsort(transform, kind="stable")  # row of the suffix without its first symbol
    starts = transform[came_from]
    split = np.ones(n, dtype=bool)
    split[1:] = (starts[1:] != starts[:-1]) | (starts[1:] == 0)
    waiting = np.flatnonzero(~split)
    low, high = came_from[waiting - 1], came_from[waiting]
    for _ in range(1, length):
        below = np.cumsum(split, dtype=np.int32)
        apart = below[high] != below[low]
        if not apart.any():
            break
        split[waiting[apart]] = True
        waiting, low, high = waiting[~apart], low[~apart], high[~apart]
    return order, split


def _shard(rows: dict[str, np.ndarray | list], length: int, again: bool) -> tuple[list[tuple], list[tuple]]:
    """Repeats (row number, from, to) among rows sorted by anchor, salt, before, segment and position;
    with ``again``, the windows that stay as first (row number, start, high and low digest)."""
    anchor, segment, n = rows["anchor"], rows["segment"], len(rows["anchor"])
    equal = np.zeros(n, dtype=bool)
    equal[1:] = ((anchor[1:] == anchor[:-1]) & (rows["before"][1:] == rows["before"][:-1])
                 & np.fromiter((a == b for a, b in zip(segment[1:], segment[:-1])), dtype=bool, count=n - 1))
    repeats = [(int(k), 0, len(segment[k])) for k in np.flatnonzero(equal)]
    alone = np.flatnonzero(~equal)
    _, inverse, counts = np.unique(anchor[alone], return_inverse=True, return_counts=True)
    contested = alone[counts[inverse] > 1]
    gone: dict[int, list[int]] = {}
    if len(contested):
        own = [segment[k] for k in contested]
        offsets = bounds((len(s) + 1 for s in own), len(own))
        symbols = np.zeros(offsets[-1], dtype=np.uint16)
        raw = np.frombuffer(b"\0".join(own) + b"\0", dtype=np.uint8)
        symbols[:] = raw.astype(np.uint16) + 1
        symbols[offsets[1:] - 1] = 0
        order, split = prefix_intervals(symbols, length)
        group = np.cumsum(split)
        size = np.bincount(group)
        member = np.flatnonzero(size[group] > 1)
        place, group = order[member], group[member]
        row = np.searchsorted(offsets, place, side="right") - 1
        at = place - offsets[row]
        k = contested[row]
        position = np.lexsort((rows["start"][k] + at, rows["uid"][k], rows["doc"][k], group))
        first = np.ones(len(position), dtype=bool)
        first[1:] = group[position[1:]] != group[position[:-1]]
        for j in position[~first]:
            gone.setdefault(int(k[j]), []).append(int(at[j]))
        for r, places in gone.items():
            places.sort()
            begin = before = places[0]
            for p in places[1:]:
                if p > before + 1:
                    repeats.append((r, begin, before + length))
                    begin = p
                before = p
            repeats.append((r, begin, before + length))
    stay = []
    if again:
        for k in alone.tolist():
            out = set(gone.get(k, ()))
            for p in range(len(segment[k]) - length + 1):
                if p not in out:
                    digest = xxhash.xxh3_128_digest(segment[k][p:p + length])
                    stay.append((k, p, int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
    return repeats, stay


def _shards(batches: Iterator[pa.RecordBatch], length: int, shard_bytes: int, again: bool) -> Iterator[pa.RecordBatch]:
    """Shards of whole anchors from rows sorted by anchor."""
    numbers = ["block", "doc", "uid", "start", "anchor", "salt", "before"]
    held: list[pa.RecordBatch] = []

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = {c: table.column(c).to_numpy() for c in numbers} | {"segment": table.column("segment").to_pylist()}
        repeats, stay = _shard(rows, length, again)
        take = lambda c, found: pa.array(rows[c][np.array([f[0] for f in found], dtype=np.int64)], pa.int64())
        start = lambda found: rows["start"][np.array([f[0] for f in found], dtype=np.int64)]
        for found, is_window in ((repeats, False), (stay, True)):
            if found:
                a = start(found) + np.array([f[1] for f in found])
                b = a + length if is_window else start(found) + np.array([f[2] for f in found])
                columns = [take("block", found), take("uid", found), pa.array(a), pa.array(b)]
                if again:
                    columns += [take("doc", found)] + [pa.array([f[i] if is_window else None for f in found], pa.int64()) for i in (2, 3)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in (_WINDOW if again else _REPEAT).split(", ")])

    size = 0
    for batch in slices(batches, "segment", shard_bytes):
        if size >= shard_bytes:
            last = held[-1]
            key = [last.column(c)[-1].as_py() for c in ("anchor", "salt")]
            same = (batch.column("anchor").to_numpy() == key[0]) & (batch.column("salt").to_numpy() == key[1])
            cut = int(same.sum())  # sorted, so these are the first rows
            held.append(batch.slice(0, cut))
            if cut < batch.num_rows:
                yield from flush(pa.Table.from_batches(held))
                held, size = [batch.slice(cut)], 0
                size = sum(map(len, held[0].column("segment").to_pylist()))
            continue
        held.append(batch)
        size += sum(map(len, batch.column("segment").to_pylist()))
    if held:
        yield from flush(pa.Table.from_batches(held))


# ---------------------------------------------------------------- documents

def repeats_of(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Repeated spans (block, uid, start, stop) of ``rows`` (block, doc, uid, text): overlapping, unordered."""
    spark, parts = rows.sparkSession, shuffle_partitions(rows.sparkSession)
    anchors = rows.select("block", "text").mapInArrow(partial(_anchors, length=length, gram=gram), "anchor bigint, block bigint, n bigint")
    # Dealt by anchor once: an anchor has at most a row or two for each block.
    total = F.sum("n").over(Window.partitionBy("anchor"))
    shared = write_by_block(anchors.withColumn("n", total).where("n > 1").select("block", "anchor"), "repeated-anchors")
    pieces = stored(rows.mapInArrow(partial(_pieces, shared=shared, length=length, gram=gram), _PIECE), "segments", "zstd")
    local = pieces.where("kind = 1").select("block", "uid", "start", "stop")
    owned = pieces.where("kind = 0").drop("kind", "stop")
    busy = stored(owned.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot), "hot-anchors")
    columns = ["block", "doc", "uid", "start", "anchor", "salt", "before", "segment"]
    order = ["anchor", "salt", "before", "segment", "doc", "uid", "start"]

    def dealt(df: DataFrame) -> DataFrame:
        return df.select(*columns).repartition(parts, "anchor", "salt").sortWithinPartitions(*order)

    plain = owned.join(busy, "anchor", "left_anti").withColumn("salt", F.lit(0).cast("long"))
    found = local.union(dealt(plain).mapInArrow(partial(_shards, length=length, shard_bytes=shard_bytes, again=False), _REPEAT))
    salted = owned.join(busy, "anchor").withColumn("salt", F.pmod(F.xxhash64("segment"), F.ceil(F.col("n") / hot)))
    windows = stored(dealt(salted).mapInArrow(partial(_shards, length=length, shard_bytes=shard_bytes, again=True), _WINDOW), "windows")
    place = F.struct("doc", "uid", "start")
    firsts = windows.where("high is not null").groupBy("high", "low").agg(F.min(place).alias("first"))
    later = windows.join(firsts, ["high", "low"]).where(place != F.col("first"))
    return (found.union(windows.where("high is null").select("block", "uid", "start", "stop"))
            .union(later.select("block", "uid", "start", "stop")))


def _merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts.tolist(), stops.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _apply(batches: Iterator[pa.RecordBatch], repeats: str) -> Iterator[pa.RecordBatch]:
    at, spans = None, {}
    for block, batch in by_block(batches):
        if block != at:
            at, spans = block, {}
            table = block_rows(repeats, block, ["uid", "start", "stop"])
            if table is not None:
                uid, start, stop = (table.column(c).to_numpy() for c in ("uid", "start", "stop"))
                order = np.argsort(uid, kind="stable")
                cuts = np.flatnonzero(np.diff(uid[order])) + 1
                spans = {int(uid[o[0]]): (start[o], stop[o]) for o in np.split(order, cuts)}
        made = []
        for uid, data in zip(batch.column("uid").to_pylist(), as_bytes(batch.column("text"))):
            runs = _merged(*spans[uid]) if uid in spans else []
            edges = [0, *[x for run in runs for x in run], len(data)]
            made.append((len(data), runs, b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array([m[0] for m in made], pa.int64()),
             pa.array([sum(b - a for a, b in m[1]) for m in made], pa.int64()),
             pa.array([[{"start": a, "stop": b} for a, b in m[1]] for m in made],
                      pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
             pa.array([m[2] for m in made], pa.binary()),
             pa.array([hashlib.sha256(m[2]).hexdigest() for m in made], pa.string())],
            names=["row", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text", row: list[str] | None = None,
                   length: int = LENGTH, gram: int = GRAM, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Column ``row`` (the document), n_bytes, n_removed, spans (removed runs), kept (remaining bytes), kept_sha256."""
    kept = docs.columns if row is None else row
    last = F.lit((1 << 63) - 1)
    # Written once: block and row number stay what they are when a task is repeated.
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
                              F.spark_partition_id().cast("long").alias("block"), F.monotonically_increasing_id().alias("uid"),
                              F.coalesce(F.col(f"`{doc_id}`").cast("long"), last).alias("doc"), whole_text(text).alias("text")),
                  "documents", "zstd")
    found = write_by_block(repeats_of(rows.drop("row"), length, gram, hot, shard_bytes), "repeats")
    schema = (f"row {rows.schema['row'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, "
              "spans array<struct<start:bigint,stop:bigint>>, kept binary, kept_sha256 string")
    return rows.mapInArrow(partial(_apply, repeats=found), schema)
