"""Token ids in Arrow files: fixed-size lists of equal-length sequences with masks.

Documents are dealt by ranges of doc_id, encoded, closed with an end id, and each range becomes
one run of ids, cut into sequences of ``SEQUENCE`` ids. A range is written as two Arrow IPC
files: the sequences (column ``ids``, a fixed-size list of unsigned integers just wide enough
for the vocabulary, and column ``mask``, one bit for each place, 0 in the padding of the last
sequence) in batches of ``BATCH`` sequences, and the index of its documents (doc_id, at,
n_tokens). Fixed-size lists have no offsets, so a sequence is found by arithmetic and read from
the mapped file without a copy (``Sequences``).

Lost executors: an attempt writes files of its own name, and only files listed in the manifest
count. The manifest is a Parquet table written by the same job, so it lists exactly the
attempts that Spark committed. All of it lies in the shared folder.

Defined results: a null or empty text is its end id alone; documents are in ascending doc_id,
null ids first, equal ids by their text; repeated rows each get their ids; an empty table gives
an empty manifest. Only the id and text columns are read, whatever else there is.
"""

from __future__ import annotations

import bisect
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placewise.llm.blocks import slices, whole_text
from placewise.llm.subwords import default_path, encoder
from placewise.session import scratch_path, shuffle_partitions

SEQUENCE = 2048
BATCH = 128
END = 0
MANIFEST = "part bigint, n_docs bigint, n_tokens bigint, sequences string, documents string"


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI that executors can reach, and the path on it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    head, tail = uri.split(":", 1)
    if head == "file":
        return fs.LocalFileSystem(), "/" + tail.lstrip("/")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(head, head) + ":" + tail)


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


def _batch(ids: np.ndarray, n_real: int, length: int) -> pa.RecordBatch:
    mask = pa.array(np.arange(len(ids)) < n_real)
    return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(ids), length),
                                       pa.FixedSizeListArray.from_arrays(mask, length)], names=["ids", "mask"])


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, length: int, end: int) -> Iterator[pa.RecordBatch]:
    """Writes the rows of one range, in their order; gives its manifest row."""
    from pyspark import TaskContext

    encode = encoder(tokenizer)
    stop = np.array([end], dtype=encode.dtype)
    part = TaskContext.get().partitionId()
    system, root = located(folder)
    stem = f"{root}/{part:06d}-{uuid.uuid4().hex}"
    full = BATCH * length
    waiting: list[np.ndarray] = []
    held = n_tokens = n_docs = 0
    out = index = None
    for block in slices(batches, "text", 4 << 20):
        if out is None:
            out_file = system.open_output_stream(f"{stem}.sequences.arrow")
            out = pa.ipc.new_file(out_file, sequence_schema(encode.dtype, length))
            index_schema = pa.schema([("doc_id", block.schema.field("doc_id").type), ("at", pa.int64()), ("n_tokens", pa.int64())])
            index_file = system.open_output_stream(f"{stem}.documents.arrow")
            index = pa.ipc.new_file(index_file, index_schema)
        made = encode.encode(block.column("text").to_pylist())
        sizes = np.array([len(x) + 1 for x in made], dtype=np.int64)
        index.write_batch(pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(n_tokens + np.cumsum(sizes) - sizes), pa.array(sizes)], schema=index_schema))
        waiting += [x for ids in made for x in (ids, stop)]
        n_docs, n_tokens, held = n_docs + len(made), n_tokens + int(sizes.sum()), held + int(sizes.sum())
        if held >= full:
            ids = np.concatenate(waiting)
            for at in range(0, held - full + 1, full):
                out.write_batch(_batch(ids[at:at + full], full, length))
            waiting, held = [ids[held // full * full:]], held % full
    if out is None:
        return
    if held:
        padded = np.zeros(-(-held // length) * length, dtype=encode.dtype)
        padded[:held] = np.concatenate(waiting)
        out.write_batch(_batch(padded, held, length))
    for writer, file in ((out, out_file), (index, index_file)):
        writer.close()
        file.close()
    scheme = folder[:folder.index(root.rstrip("/"))] if root.rstrip("/") in folder else ""
    yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_tokens": [n_tokens],
                                      "sequences": [f"{scheme}{stem}.sequences.arrow"],
                                      "documents": [f"{scheme}{stem}.documents.arrow"]})


def write_tokens(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str | Column = "text",
                 tokenizer: str | None = None, length: int = SEQUENCE, end: int = END) -> DataFrame:
    """Writes the files under ``folder`` and gives the manifest: a row for each range, with the ids
    before it (``start``)."""
    spark = docs.sparkSession
    system, root = located(folder)
    system.create_dir(root, recursive=True)
    ordered = (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(text).alias("text"))
               .repartitionByRange(shuffle_partitions(spark), F.col("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    write = partial(_write, folder=folder, tokenizer=tokenizer or default_path(), length=length, end=end)
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    return (spark.read.parquet(f"{folder}/manifest")
            .withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))))


class Sequences:
    """Random access to the sequences of one file. Local files are mapped and not copied."""

    def __init__(self, uri: str):
        system, path = located(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        sizes = [self.file.get_batch(k).num_rows for k in range(self.file.num_record_batches)]
        self.ends = np.cumsum(sizes).tolist()

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def batch(self, number: int) -> np.ndarray:
        """All ids of a batch, as one view."""
        return self.file.get_batch(number).column("ids").flatten().to_numpy(zero_copy_only=True)

    def __getitem__(self, number: int) -> np.ndarray:
        k = bisect.bisect_right(self.ends, number)
        at = (number - (self.ends[k - 1] if k else 0)) * self.length
        return self.batch(k)[at:at + self.length]

    def mask(self, number: int) -> np.ndarray:
        k = bisect.bisect_right(self.ends, number)
        row = number - (self.ends[k - 1] if k else 0)
        return self.file.get_batch(k).column("mask").slice(row, 1).flatten().to_numpy(zero_copy_only=False)

    def span(self, at: int, n: int) -> Iterator[np.ndarray]:
        """The ids from place ``at`` on, as views."""
        while n:
            k = bisect.bisect_right(self.ends, at // self.length)
            ids = self.batch(k)
            first = at - (self.ends[k - 1] if k else 0) * self.length
            piece = ids[first:first + n]
            yield piece
            at, n = at + len(piece), n - len(piece)


def documents_of(sequences: str, documents: str) -> Iterator[tuple[pa.RecordBatch, list[list[np.ndarray]]]]:
    """Index batches of a range with the ids of each of their documents, as views of the file."""
    ids = Sequences(sequences)
    system, path = located(documents)
    with system.open_input_file(path) as source:
        reader = pa.ipc.open_file(source)
        for k in range(reader.num_record_batches):
            batch = reader.get_batch(k)
            yield batch, [ids.span(at, n) for at, n in zip(batch.column("at").to_pylist(), batch.column("n_tokens").to_pylist())]


def checksum(pieces: Iterator[np.ndarray]) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    crc = 0
    for piece in pieces:
        crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
    return crc


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        for part, sequences, documents in zip(*(files.column(n).to_pylist() for n in ("part", "sequences", "documents"))):
            for batch, ids in documents_of(sequences, documents):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * batch.num_rows, pa.int64()), *batch.columns, pa.array(map(checksum, ids), pa.int64())],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, folder: str, id_type: str) -> DataFrame:
    """One row for each document, read from the files: doc_id, start, n_tokens, ids_crc32."""
    files = manifest(spark, folder)
    schema = f"part bigint, doc_id {id_type}, at bigint, n_tokens bigint, ids_crc32 bigint"
    read = files.select("part", "sequences", "documents").repartition(shuffle_partitions(spark)).mapInArrow(_read, schema)
    # One row per range, so this side does not grow with a range; left alone, Spark takes the other one.
    starts = F.broadcast(files.select("part", F.col("start").alias("before")))
    return (read.join(starts, "part")
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def tokens_round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text", **options) -> DataFrame:
    """Writes the files to a new folder under the shared one and reads every document back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, doc_id, text, **options)
    return read_documents(docs.sparkSession, folder, docs.schema[doc_id].dataType.simpleString())
