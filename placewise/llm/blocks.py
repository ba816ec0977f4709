"""Run a numpy or Arrow step over the texts of a table, block by block.

A block is a run of rows of one partition whose texts stay under a byte bound (one longer
text is a block of its own), so a task's memory does not follow the number of rows Spark
puts into an Arrow batch. Rows never leave their partition: no shuffle.

The original columns travel inside one struct column, so a step's own columns can never
clash with them, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.session import scratch_path

BLOCK_BYTES = 8 << 20

Step = Callable[[dict[str, pa.Array]], list]


def whole_text(column: str | Column = "text") -> Column:
    """The text as a string; null is the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def stored(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the plan, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], sized: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows, cut so that column ``sized`` has about ``limit`` bytes in each batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.binary_length(batch.column(sized)).cast(pa.int64()))
        block = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def over_blocks(df: DataFrame, inputs: dict[str, Column], step: Step, fields: str,
                row: list[str] | None = None, sized: str = "text",
                limit: int = BLOCK_BYTES) -> DataFrame:
    """``df`` as column ``row`` (a struct of the named or all columns) plus the columns of ``step``.

    ``step`` gets the ``inputs`` of a block as Arrow arrays and returns one array per field.
    """
    kept = df.columns if row is None else row
    picked = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
                       *[c.alias(f"in_{n}") for n, c in inputs.items()])
    schema = f"row {picked.schema['row'].dataType.simpleString()}, {fields}"
    names, keys = [f.split()[0] for f in fields.split(", ")], list(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, f"in_{sized}", limit):
            made = step({n: block.column(f"in_{n}") for n in keys})
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), *[m if isinstance(m, pa.Array) else pa.array(m) for m in made]],
                names=["row", *names])

    return picked.mapInArrow(run, schema)


def as_bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary()).to_pylist()


def bounds(lengths: Iterable[int], n: int) -> np.ndarray:
    """Offsets of consecutive runs of these lengths: n + 1 numbers, starting at 0."""
    out = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.fromiter(lengths, dtype=np.int64, count=n), out=out[1:])
    return out


def totals(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each run, also for empty runs."""
    before = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=before[1:])
    return before[offsets[1:]] - before[offsets[:-1]]


#: The six ASCII space characters between words; bytes.split() cuts at exactly these.
SPACES = " \t\n\r\x0b\x0c"

#: A-Z to lower case; every byte that belongs to no word of letters and digits to a space.
WORDS_ONLY = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
                   else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
