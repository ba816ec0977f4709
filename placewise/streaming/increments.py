"""Incremental ingest: every newly arrived file or bundle is taken exactly once.

The file source remembers in its checkpoint which files it has taken. A micro-batch is written to a
folder of its own number, replacing what a broken attempt left there, so neither a second run nor
a run repeated after a failure adds a record twice. Rejected records of the same batch go to
``<target>_rejected`` in the same way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.operators.business import latest_by_key
from placewise.plans.ingest import KEYED
from placewise.schemas import entity_schema
from placewise.sources.bundles import BINARY_FILE_DDL, MEMBERS, scan_member
from placewise.sources.json_lines import (BAD_LINE, LINE, LINE_JSON, MODIFIED, PATH, accepted, extra_columns, rejected,
                                          with_bad_line, with_place)
from placewise.sources.versions import BUCKETS, adopt

BATCH = "_batch"
PLACE = [MODIFIED, PATH, LINE]
#: Folders of a table (one for each batch of reviews) beyond which the job makes one of them.
MOST_FOLDERS = 24


def ingest_new_files(spark: SparkSession, source: str, entity: str, target: str, checkpoint: str,
                     files_per_batch: int = 1000) -> None:
    """Take the JSON-lines files of one entity that arrived since the last call, then stop."""
    arriving = (spark.readStream.schema(with_bad_line(entity_schema(entity)))
                .option("columnNameOfCorruptRecord", BAD_LINE)
                .option("maxFilesPerTrigger", files_per_batch).json(source))
    # A row's number can only be told inside a batch, so the files' metadata travels until there.
    _take(arriving.select("*", "_metadata"), entity, target, f"{checkpoint}/{entity}", with_place)


def ingest_new_bundles(spark: SparkSession, source: str, target: str, checkpoint: str,
                       entities: Iterable[str] = tuple(MEMBERS), bundles_per_batch: int = 100, extras: bool = False) -> None:
    """Take the zip bundles that arrived since the last call into ``<target>/<entity>``, then stop.

    ``extras`` keeps columns that are not declared as a map of JSON texts in ``_extra``.
    """
    for entity in entities:
        _take(_arriving_bundles(spark, source, bundles_per_batch), entity, f"{target}/{entity}", f"{checkpoint}/{entity}",
              lambda batch, entity=entity: _bundle_records(batch, entity, extras))


def taken_records(spark: SparkSession, target: str) -> DataFrame:
    """Everything taken so far with its place (file time, file, line)."""
    return spark.read.parquet(target).drop(BATCH)


def all_records(spark: SparkSession, target: str) -> DataFrame:
    """Everything taken so far, as it came."""
    return taken_records(spark, target).drop(*PLACE)


def rejected_records(spark: SparkSession, target: str) -> DataFrame:
    """Everything rejected so far, with its file and raw text or reason."""
    return spark.read.parquet(f"{target}_rejected").drop(BATCH)


def current_records(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The record of each key from the newest file, in it the last line."""
    return _newest(taken_records(spark, target), key)


def with_increments(base: DataFrame, target: str, key: str | None = None) -> DataFrame:
    """A bootstrap table followed by what arrived since; with ``key`` the newest record of each."""
    taken = taken_records(base.sparkSession, target)
    if key is None:
        return base.unionByName(taken.drop(*PLACE), allowMissingColumns=True)
    arrived = _newest(taken, key)
    return base.join(arrived.select(key), key, "left_anti").unionByName(arrived, allowMissingColumns=True)


def update_tables(spark: SparkSession, source: str, target: str, checkpoint: str, prefix: str = "",
                  bundles_per_batch: int = 100, extras: bool = False, buckets: int = BUCKETS) -> dict[str, str]:
    """One job from newly arrived bundles to the tables that ``build_features`` reads.

    The tables are versioned ones under ``<target>/tables`` and views ``<prefix><entity>`` of the catalog; a plain table of
    that name, as ``ingest`` writes it, is taken over first. Each batch is merged once, however often the
    job is repeated: a business or user keeps its record of the last place, a review is added. Rejected
    records go to ``<prefix><entity>_rejected`` in the same way.
    """
    names = {entity: f"{prefix}{entity}" for entity in MEMBERS}
    stored = {entity: (adopt(spark, name, f"{target}/tables/{entity}", KEYED.get(entity), buckets),
                       adopt(spark, f"{name}_rejected", f"{target}/tables/{entity}_rejected")) for entity, name in names.items()}

    def store(batch: DataFrame, number: int) -> None:
        for entity, (table, refused) in stored.items():
            # Each member of an archive is opened once; accepted and rejected records are told apart afterwards.
            path = f"{target}/batches/{entity}/{BATCH}={number}"
            _bundle_records(batch, entity, extras).write.mode("overwrite").parquet(path)
            records = spark.read.parquet(path)
            table.merge(accepted(records, entity), KEYED.get(entity), checkpoint, number, buckets)
            refused.merge(rejected(records, entity), None, checkpoint, number)

    (_arriving_bundles(spark, source, bundles_per_batch).writeStream.foreachBatch(store)
     .option("checkpointLocation", f"{checkpoint}/bundles").trigger(availableNow=True).start().awaitTermination())
    for entity, name in names.items():
        for table, own in zip(stored[entity], (name, f"{name}_rejected")):
            if table.state().version:
                table.compact(MOST_FOLDERS)
                table.publish(own)
    return names


def _arriving_bundles(spark: SparkSession, source: str, bundles_per_batch: int) -> DataFrame:
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_DDL)
            .option("maxFilesPerTrigger", bundles_per_batch).load(source).select("path", "modificationTime"))


def _bundle_records(batch: DataFrame, entity: str, extras: bool) -> DataFrame:
    """Parsed records of a batch of archives with their place."""
    records = scan_member(batch, entity, place=True, extras=extras)
    if extras:
        records = records.withColumn("_extra", extra_columns(F.col(LINE_JSON), entity_schema(entity).names)).drop(LINE_JSON)
    return records


def _newest(stored: DataFrame, key: str) -> DataFrame:
    rest = [F.col(c) for c in stored.columns if c not in (key, *PLACE)]
    return latest_by_key(stored, key, [*map(F.col, PLACE), *rest]).drop(*PLACE)


def _take(arriving: DataFrame, entity: str, target: str, checkpoint: str, scan=None) -> None:
    def store(batch: DataFrame, number: int) -> None:
        records = scan(batch) if scan else batch
        accepted(records, entity).write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")
        (rejected(records, entity).drop(MODIFIED, LINE).write.mode("overwrite").parquet(f"{target}_rejected/{BATCH}={number}"))

    (arriving.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
