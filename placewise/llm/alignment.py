"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and in how many documents.

Each text is encoded by tokenizer A (byte-level BPE) and tokenizer B (pieces with byte fallback). Both
id sequences spell the same bytes, so their token ends cut the bytes into segments: each
segment lies in exactly one A and one B token, which is a link; ends that both have close a group.

The counts come from an inverted index. A block of documents keeps for each id pair a compressed
bitmap of its documents (a sorted list of 16-bit numbers, or bits where that is smaller), OR-merged
from the batches of the block, and multiplicity planes: plane ``k`` >= 1 has the documents whose number of links
less one has bit ``k - 1``. Documents of different blocks are different bits, so the OR over blocks has the sum of
their popcounts, which is all that leaves a block: a pair in a third of all documents has one row
for each block and is summed before the shuffle. The totals then return to the blocks that hold the pair, and
its postings add them to the documents, a plane with its weight.

The tokenizers are asked once for each distinct chunk and Python worker: blanks and what follows
them up to the next blank. That neither sequence runs over a chunk's start is checked on the vocabulary
(``cuts_hold``) and by tests; texts with other white space or with B's sign for a space are encoded whole.

Defined results: a null or empty text, and one that either tokenizer does not spell byte by byte, has
no tokens and only zeros; special strings are plain text; repeated rows are documents of
their own; ties for an A id's highest count all count; a very long text is a block of its
own; an empty table gives an empty table; input columns travel in one struct and cannot clash.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placewise.llm.blocks import BLOCK_BYTES, as_bytes, slices, stored, whole_text
from placewise.llm.subwords import CHUNKS, ODD_SPACE
from placewise.llm.token_counts import byte_characters

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
SPACE = "▁"              # B's sign for a space
MEMORY = 250_000
RUN = 2000                    # chunks that are encoded together
BATCH_BYTES = 1 << 20
BLOCK_ROWS = 1 << 16          # documents of a block have 16-bit numbers
B_IDS = 1 << 32

_SCAN = ("block bigint, at int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
         "a bigint, b bigint, plane int, n_docs bigint, docs binary")


class Aligner:
    """Encodes texts by both tokenizers and aligns the ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are then plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of_byte = byte_characters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for piece, number in self.a.get_vocab().items():
            self.a_bytes[number] = (bytes(of_byte[c] for c in piece) if all(c in of_byte for c in piece) else piece.encode())
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id(SPACE)
        self.cuts_hold = not any("\n" in p or any(x != SPACE and y == SPACE for x, y in zip(p, p[1:])) for p in pieces)
        self.labels = [b"%d%s" % (k, x) for k in range(max(len(self.a_bytes), len(pieces))) for x in (b",", b"|", b";", b"")]
        self.label_size = np.array(list(map(len, self.labels)), dtype=np.int64)
        self.memory: dict[str, tuple[bytes, bytes, str] | None] = {}

    def spelled(self, a: list[int], b: list[int], data: bytes) -> bool:
        return (b"".join(map(self.a_bytes.__getitem__, a)) == data) and b"".join(map(self.b_bytes.__getitem__, b)) == data

    def group_text(self, a: list[int], b: list[int]) -> str:
        """The groups as text: ids of A and of B in order, groups apart by semicolons."""
        out, left, right, i, j, a_end, b_end = [], [], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if a_end <= b_end and i < len(a):
                a_end += len(self.a_bytes[a[i]])
                left.append(str(a[i]))
                i += 1
            else:
                b_end += len(self.b_bytes[b[j]])
                right.append(str(b[j]))
                j += 1
            if a_end == b_end:
                out.append(",".join(left) + "|" + ",".join(right))
                left, right = [], []
        return ";".join(out)

    def _entries(self, texts: list[str], b_ids: list[list[int]]) -> Iterator[tuple[bytes, bytes, str] | None]:
        for text, made, b in zip(texts, self.a.encode_batch_fast(texts, add_special_tokens=False), b_ids):
            a = made.ids
            if not self.spelled(a, b, text.encode()):
                yield None
                continue
            yield array("I", a).tobytes(), array("I", b).tobytes(), self.group_text(a, b)

    def _learn(self, chunks: list[str]) -> None:
        """Chunks begin with a blank. Most go to the tokenizers in runs, as a text of their own."""
        run = [c for c in chunks if c[-1] not in " \n"]
        single = [c for c in chunks if c[-1] in " \n"]
        for a in range(0, len(run), RUN):
            part = run[a:a + RUN]
            made = self._run(part)
            if made is None:
                single += part
            else:
                self.memory.update(zip(part, made))
        # B adds a space by itself, which stands for the first one or is taken away.
        b_ids = self.b.encode([c[1:] if c[0] == " " else c for c in single], num_threads=1)
        b_ids = [[self.space] if c == " " else ids if c[0] == " " else ids[1:] for c, ids in zip(single, b_ids)]
        self.memory.update(zip(single, self._entries(single, b_ids)))

    def _run(self, chunks: list[str]) -> Iterator[tuple[bytes, bytes, str]] | None:
        """Entries of chunks encoded as one text; none if not both tokenizers spell each of them."""
        text = "".join(chunks)
        data, ends = text.encode(), np.cumsum([len(c.encode()) for c in chunks])
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        b = np.array(self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:], dtype=np.uint32)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_cut, b_cut = np.searchsorted(a_end, ends) + 1, np.searchsorted(b_end, ends) + 1
        if not (a_end[-1] == b_end[-1] == len(data) and (a_end[a_cut - 1] == ends).all() and (b_end[b_cut - 1] == ends).all()
                and b"".join(map(self.a_bytes.__getitem__, a)) == data and b"".join(map(self.b_bytes.__getitem__, b)) == data):
            return None
        shared = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        # Each id as text with what follows it: a comma, the bar after a group's last A id, a semicolon, nothing.
        a_kind = np.where(np.diff(a_group, append=-1) != 0, 1, 0)
        b_kind = np.where(np.diff(b_group, append=-1) != 0, 2, 0)
        b_kind[b_cut - 1] = 3
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        number = np.concatenate([a * np.int64(4) + a_kind, b * np.int64(4) + b_kind])[order]
        places = np.concatenate([[0], np.cumsum(self.label_size[number])])
        labels = b"".join(map(self.labels.__getitem__, number.tolist())).decode()
        stops = places[a_cut + b_cut].tolist()
        a_bytes, b_bytes, a_cut, b_cut = a.tobytes(), b.tobytes(), (4 * a_cut).tolist(), (4 * b_cut).tolist()
        return zip((a_bytes[x:y] for x, y in zip([0, *a_cut], a_cut)), (b_bytes[x:y] for x, y in zip([0, *b_cut], b_cut)),
                   (labels[x:y] for x, y in zip([0, *stops], stops)))

    def align(self, texts: list[str]) -> list[tuple[bytes, bytes, str] | None]:
        """For each text (given without the added space): both id sequences as 32-bit numbers, and the groups as text."""
        if len(self.memory) > MEMORY:
            self.memory = {}
        plain = [bool(t) and self.cuts_hold and SPACE not in t and not ODD_SPACE.search(t) for t in texts]
        cut = [CHUNKS.findall(" " + t) if p else () for t, p in zip(texts, plain)]
        self._learn([c for c in set(chain.from_iterable(cut)) if c not in self.memory])
        known, out = self.memory.__getitem__, []
        for text, chunks in zip(texts, cut):
            found = list(map(known, chunks))
            if chunks and None not in found:
                a, b, groups = zip(*found)
                out.append((b"".join(a), b"".join(b), ";".join(groups)))
            else:
                out.append(next(self._entries([" " + text], [self.b.encode(text)])) if text else None)
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of two files, loaded once for each Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def links(own: Aligner, aligned: list[tuple[bytes, bytes, str] | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (A id, B id) of all links, and for each text the number of its links and of its groups.

    All texts are one run of bytes, since every text ends in both sequences."""
    made = [x or (b"", b"", "") for x in aligned]
    a, b = (np.frombuffer(b"".join(x[i] for x in made), dtype=np.uint32) for i in range(2))
    a_end, b_end = np.cumsum(own.a_size[a]), np.cumsum(own.b_size[b])
    size = int(a_end[-1]) if len(a_end) else 0
    cuts_a, cuts_b = np.zeros(size + 1, dtype=bool), np.zeros(size + 1, dtype=bool)
    cuts_a[a_end], cuts_b[b_end] = True, True
    ends = np.flatnonzero(cuts_a | cuts_b)
    of_a = np.cumsum(cuts_a)[ends] - cuts_a[ends]   # tokens that end before this end
    of_b = np.cumsum(cuts_b)[ends] - cuts_b[ends]
    codes = a[of_a].astype(np.int64) * B_IDS + b[of_b]
    last = np.cumsum([len(x[0]) // 4 for x in made]) if made else np.zeros(0, dtype=np.int64)
    text_end = np.concatenate([[0], a_end])[last]   # where each text ends
    n_links = np.diff(np.searchsorted(ends, text_end, side="right"), prepend=0)
    n_groups = np.diff(np.searchsorted(np.flatnonzero(cuts_a & cuts_b), text_end, side="right"), prepend=0)
    return codes, n_links, n_groups


# ------------------------------------------------------------------ bitmaps

def packed(codes: np.ndarray, docs: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Pairs, popcounts and bitmaps from (code, document) rows that are distinct and in order."""
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    counts = np.diff(np.append(first, len(codes)))
    most = -(-n_docs // 8)
    dense = np.flatnonzero(2 * counts > most)
    sizes = np.where(2 * counts > most, most, 2 * counts)
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    if not len(dense):
        data = docs.astype("<u2").tobytes()
    else:
        listed, parts, at = docs.astype("<u2"), [], 0
        for k in dense:
            parts.append(listed[at:first[k]].tobytes())
            bits = np.zeros(n_docs, dtype=bool)
            bits[docs[first[k]:first[k] + counts[k]]] = True
            parts.append(np.packbits(bits).tobytes())
            at = first[k] + counts[k]
        data = b"".join([*parts, listed[at:].tobytes()])
    return codes[first], counts, pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(counts: np.ndarray, bitmaps: pa.Array, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the bitmap, document) of every set bit."""
    rows, docs = [], []
    most, sparse = -(-n_docs // 8), []
    for k, (n, data) in enumerate(zip(counts.tolist(), bitmaps.to_pylist())):
        if 2 * n > most:
            found = np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n_docs))
            rows.append(np.full(len(found), k))
            docs.append(found)
        else:
            sparse.append((k, n, data))
    if sparse:
        rows.append(np.repeat([k for k, _, _ in sparse], [n for _, n, _ in sparse]))
        docs.append(np.frombuffer(b"".join(d for _, _, d in sparse), dtype="<u2"))
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows).astype(np.int64), np.concatenate(docs).astype(np.int64)


def block_postings(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n_docs: int) -> Iterator[tuple]:
    """(pairs, plane, popcounts, bitmaps) of a block from its batches' (code, document, times).

    A document is in one batch only, so the OR of the batches' bitmaps is their rows in order."""
    if not parts:
        return
    codes, docs, times = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(codes, kind="stable")
    codes, docs, times = codes[order], docs[order], times[order]
    plane = 0
    while len(codes):
        yield (*packed(codes, docs, n_docs), plane)
        more = times - 1
        if plane == 0:
            left = np.flatnonzero(more > 0)
            rest_codes, rest_docs, rest = codes[left], docs[left], more[left]
        plane += 1
        if not len(rest) or int(rest.max()) < 1 << (plane - 1):
            return
        chosen = np.flatnonzero(rest >> (plane - 1) & 1)
        while not len(chosen):  # a plane that is empty between others
            plane += 1
            chosen = np.flatnonzero(rest >> (plane - 1) & 1)
        codes, docs, times = rest_codes[chosen], rest_docs[chosen], np.ones(len(chosen), dtype=np.int64)


# ------------------------------------------------------------------ jobs

def _rows(n: int, **columns) -> dict[str, pa.Array]:
    kinds = {"block": pa.int64(), "at": pa.int32(), "groups": pa.string(), "plane": pa.int32(), "docs": pa.binary()}
    names = [f.split()[0] for f in _SCAN.split(", ")]
    return {k: pa.array(columns[k], kinds.get(k, pa.int64())) if k in columns and not isinstance(columns[k], pa.Array)
            else columns.get(k, pa.nulls(n, kinds.get(k, pa.int64()))) for k in names}


def _scan(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Documents and postings, block by block."""
    own = aligner(a_path, b_path)
    part, number, at, size = TaskContext.get().partitionId(), 0, 0, 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    row_type = None

    def block_id() -> int:
        return (part << 32) + number

    def flush() -> Iterator[pa.RecordBatch]:
        for codes, counts, bitmaps, plane in block_postings(held, at):
            n = len(codes)
            made = _rows(n, block=np.full(n, block_id()), a=codes // B_IDS, b=codes % B_IDS, plane=np.full(n, plane),
                         n_docs=counts, docs=bitmaps)
            for a in range(0, n, 1 << 16):
                yield pa.RecordBatch.from_pydict({"row": pa.nulls(n, row_type), **made}).slice(a, 1 << 16)

    for batch in slices(batches, "text", BATCH_BYTES):
        row_type = batch.schema.field("row").type
        for a in range(0, batch.num_rows, BLOCK_ROWS):
            piece = batch.slice(a, BLOCK_ROWS)
            data = as_bytes(piece.column("text"))
            if at and (size + sum(map(len, data)) > block_bytes or at + len(data) > BLOCK_ROWS):
                yield from flush()
                number, at, size, held = number + 1, 0, 0, []
            aligned = own.align([x.decode() for x in data])
            codes, n_links, n_groups = links(own, aligned)
            doc = np.repeat(np.arange(len(data)), n_links)
            key, pair = np.unique(codes, return_inverse=True)
            both, n = np.unique(pair * len(data) + doc, return_counts=True)
            held.append((key[both // len(data)], at + both % len(data), n))
            digests = [x and hashlib.sha256(x[2].encode()).hexdigest() or "" for x in aligned]
            made = _rows(len(data), block=np.full(len(data), block_id()), at=np.arange(at, at + len(data)),
                         n_a=[len(x[0]) // 4 if x else 0 for x in aligned], n_b=[len(x[1]) // 4 if x else 0 for x in aligned],
                         n_groups=n_groups, n_links=n_links, groups=digests)
            yield pa.RecordBatch.from_pydict({"row": piece.column("row"), **made})
            at, size = at + len(data), size + sum(map(len, data))
    if at:
        yield from flush()


def scan(docs: DataFrame, text: str | Column = "text", row: list[str] | None = None, a_path: str | None = None,
         b_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stored rows of both kinds: documents (``at`` is not null) and bitmaps of pairs (``plane`` is not null)."""
    kept = docs.columns if row is None else row
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), whole_text(text).alias("text"))
    run = partial(_scan, a_path=a_path or public_tokenizers.path(A_FILE), b_path=b_path or public_tokenizers.path(B_FILE),
                  block_bytes=block_bytes)
    return stored(plain.mapInArrow(run, f"row {plain.schema['row'].dataType.simpleString()}, {_SCAN}"), "alignment", "zstd")


def pair_counts(scanned: DataFrame) -> DataFrame:
    """Corpus-wide (a, b, docs, links) of every linked id pair: popcounts of its bitmaps, planes with their weight."""
    weight = F.expr("CASE WHEN plane = 0 THEN 1L ELSE shiftleft(1L, plane - 1) END")
    return (scanned.where("plane is not null").groupBy("a", "b")
            .agg(F.sum(F.when(F.col("plane") == 0, F.col("n_docs")).otherwise(0)).alias("docs"),
                 F.sum(F.col("n_docs") * weight).alias("links")))


def _scores(key: tuple, rows: pa.Table, totals: pa.Table) -> pa.Table:
    """Adds the pairs' totals to the documents of a block, by its postings."""
    is_doc = rows.column("at").is_valid()
    docs, pairs = rows.filter(is_doc), rows.filter(rows.column("plane").is_valid())
    docs = docs.take(pa.array(np.argsort(docs.column("at").to_numpy(), kind="stable")))
    n_best, count_sum = np.zeros(docs.num_rows, dtype=np.int64), np.zeros(docs.num_rows, dtype=np.int64)
    code = lambda t, a, b: t.column(a).to_numpy() * B_IDS + t.column(b).to_numpy()
    if pairs.num_rows:
        known = code(totals, "of_a", "of_b")
        order = np.argsort(known)
        at = order[np.searchsorted(known[order], code(pairs, "a", "b"))]
        count, best = totals.column("total").to_numpy()[at], totals.column("best").to_numpy(zero_copy_only=False)[at]
        plane = pairs.column("plane").to_numpy().astype(np.int64)
        times = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))
        bitmaps = pairs.column("docs").combine_chunks()
        of, doc = unpacked(pairs.column("n_docs").to_numpy(), bitmaps, docs.num_rows)
        np.add.at(count_sum, doc, (count * times)[of])
        np.add.at(n_best, doc, (best * times)[of])
    return pa.table({**{n: docs.column(n) for n in ("row", "n_a", "n_b", "n_groups", "n_links")},
                     "n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": docs.column("groups")})


def align(docs: DataFrame, text: str | Column = "text", row: list[str] | None = None, a_path: str | None = None,
          b_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Column ``row`` (the document), n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    scanned = scan(docs, text, row, a_path, b_path, block_bytes)
    totals = stored(pair_counts(scanned).select("a", "b", F.col("docs").alias("total")), "alignment-pairs")
    best = totals.groupBy("a").agg(F.max("total").alias("most"))  # a row for each id of A's vocabulary at most
    totals = totals.join(F.broadcast(best), "a").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    wanted = (scanned.where("plane = 0").select("block", "a", "b").join(totals, ["a", "b"])
              .select(F.col("block").alias("of_block"), F.col("a").alias("of_a"), F.col("b").alias("of_b"), "total", "best"))
    schema = (f"row {scanned.schema['row'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "n_best bigint, count_sum bigint, groups_sha256 string")
    return scanned.groupBy("block").cogroup(wanted.groupBy("of_block")).applyInArrow(_scores, schema)
