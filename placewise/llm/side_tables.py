"""Tables that a task reads for the block of documents it is at.

A block is a file of a written table of documents and has a number. What a later step must know
about the documents of a block is written with a folder for each block under the shared folder,
and a task opens the folder of its block there: the documents need no shuffle to meet it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame

from placewise.llm.blocks import BLOCK_BYTES, slices
from placewise.llm.token_files import located
from placewise.session import scratch_path, shuffle_partitions


def block_rows(folder: str, block: int, columns: list[str]) -> pa.Table | None:
    """The rows of one block of a table that was written with a folder for each block."""
    system, root = located(f"{folder}/block={block}")
    if system.get_file_info(root).type == fs.FileType.NotFound:
        return None
    return ds.dataset(root, filesystem=system, format="parquet").to_table(columns=columns)


def write_by_block(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    (df.repartition(shuffle_partitions(df.sparkSession), "block").write.partitionBy("block").parquet(path))
    return path


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows with their block number, in pieces of bounded text and of one block each."""
    for batch in slices(batches, "text", BLOCK_BYTES):
        blocks = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(blocks[a]), batch.slice(a, b - a)
