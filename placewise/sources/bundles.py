"""Zip bundles holding one JSON-lines file per entity.

Spark lists the archives and gives each one to a task, which streams a member line by
line; neither the archive nor the member is held whole, so archives above the 2 GB
binary-column limit work too. A deflated member cannot be split, so the size of one
member bounds one task's reading time; parsing can be spread with ``spread``.
"""

from __future__ import annotations

import io
import itertools
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.schemas import entity_schema
from placewise.sources.json_lines import BAD_LINE, LINE, LINE_JSON, MODIFIED, PATH, accepted, with_bad_line

# Member name of each entity inside a bundle.
MEMBERS = {"business": "business.json", "review": "review.json", "user": "user.json"}
BINARY_FILE_DDL = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
_LINES_PER_BATCH = 8192


def list_bundles(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime) of every archive under ``path``; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "modificationTime")


def member_lines(bundles: DataFrame, entity: str) -> DataFrame:
    """(path, modified, number, line, failure) of one entity for a table of archive paths and times.

    ``modified`` (microseconds) travels with the lines: joined afterwards, the lines would look as small as the list
    of archives and be broadcast through the driver.

    Bytes that are no UTF-8 become replacement characters, so the line's JSON is judged like any
    other. An archive that cannot be read further gives one row with the reason as ``failure``.
    """
    member, batch_lines = MEMBERS[entity], _LINES_PER_BATCH

    # Self-contained, so that tasks run it without importing this package.
    def open_stream(path: str):
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if scheme in ("s3a", "s3n"):
            path = f"s3:{rest}"
        elif scheme == "file":
            path = f"file:///{rest.lstrip('/')}"
        filesystem, location = fs.FileSystem.from_uri(path)
        return filesystem.open_input_file(location)

    def made(path: str, modified: int, numbers: Sequence[int], lines: list, failure: str | None = None) -> pa.RecordBatch:
        same = lambda value, kind: pa.repeat(pa.scalar(value, kind), len(lines))
        columns = {"path": same(path, pa.string()), "modified": same(modified, pa.int64()), "number": pa.array(numbers, pa.int64()),
                   "line": pa.array(lines, pa.string()), "failure": same(failure, pa.string())}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, modified in zip(batch.column("path").to_pylist(), batch.column("modified").to_pylist()):
                try:
                    with open_stream(path) as raw, zipfile.ZipFile(raw) as archive:
                        if member not in archive.namelist():
                            continue
                        with archive.open(member) as stream:
                            text, first = io.TextIOWrapper(stream, "utf-8", errors="replace"), 0
                            while chunk := list(itertools.islice(text, batch_lines)):
                                lines = [line.rstrip("\r\n") for line in chunk]
                                numbers = range(first, first := first + len(lines))
                                if not all(map(str.strip, lines)):
                                    numbers = [n for n, line in zip(numbers, lines) if line.strip()]
                                    lines = list(filter(str.strip, lines))
                                if lines:
                                    yield made(path, modified, numbers, lines)
                except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError) as error:
                    yield made(path, modified, [-1], [None], f"{type(error).__name__}: {error}")

    return (bundles.select("path", F.unix_micros("modificationTime").alias("modified"))
            .mapInArrow(read, "path STRING, modified BIGINT, number BIGINT, line STRING, failure STRING"))


def scan_member(bundles: DataFrame, entity: str, spread: int | None = None, place: bool = False,
                extras: bool = False) -> DataFrame:
    """Parsed lines of one entity plus ``_bad_line``; works on a stream of archives too.

    An unreadable archive is a row whose ``_bad_line`` is the reason. ``place`` adds ``_modified``,
    ``_path`` and ``_line``; ``extras`` adds ``_line_json``, the whole line, for columns that are not declared.
    """
    lines = member_lines(bundles, entity)
    if spread:
        lines = lines.repartition(spread)
    schema = with_bad_line(entity_schema(entity))
    parsed = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
    bad = F.coalesce(F.col(f"r.{BAD_LINE}"), "failure").alias(BAD_LINE)
    more = [F.timestamp_micros("modified").alias(MODIFIED), F.col("path").alias(PATH), F.col("number").alias(LINE)] if place else []
    more += [F.col("line").alias(LINE_JSON)] if extras else []
    return (lines.select(parsed.alias("r"), "path", "modified", "number", "line", "failure")
            .select(*[F.col(f"r.{f.name}") for f in entity_schema(entity).fields], bad, *more))


def read_bundle(spark: SparkSession, path: str, entity: str, spread: int | None = None) -> DataFrame:
    """Accepted records of one entity from all archives under ``path``."""
    return accepted(scan_member(list_bundles(spark, path), entity, spread), entity)
