"""Bootstrap and incremental ingest of the three entities into catalog tables.

Every job stores what it rejects: ``<prefix><entity>_rejected`` holds the parsed columns, the raw
text or the reason in ``_bad_line``, and the file in ``_path``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.operators.business import latest_by_key
from placewise.schemas import entity_schema
from placewise.sources.bundles import list_bundles, scan_member
from placewise.sources.json_lines import (BAD_LINE, LINE, LINE_JSON, MODIFIED, PATH, accepted, extra_columns,
                                          rejected, scan_entity, scan_inferred, with_place)
from placewise.sources.tables import append_table, delete_path, location_of, overwrite_table, widen_table
from placewise.sources.versions import find

# Entities that keep one row per key; a review is an event and stays as it came.
KEYED = {"business": "business_id", "user": "user_id"}
PLACE = [MODIFIED, PATH, LINE]


def newest(records: DataFrame, entity: str) -> DataFrame:
    """One record per business or user: that of the newest file, in it the last line.

    Equal places (records that came without one) are decided by the record, so a rerun picks the same.
    """
    place = [c for c in PLACE if c in records.columns]
    if entity not in KEYED:
        return records.drop(*place)
    rest = [F.col(c) for c in records.columns if c not in (KEYED[entity], *place)]
    return latest_by_key(records, KEYED[entity], [*map(F.col, place), *rest]).drop(*place)


def ingest(spark: SparkSession, paths: Mapping[str, str], mode: str = "overwrite", prefix: str = "",
           fmt: str = "parquet", infer: bool = False) -> dict[str, str]:
    """Load JSON-lines files into tables ``<prefix><entity>``; returns the table names.

    ``paths`` maps entity to path. ``mode`` is ``overwrite`` (bootstrap) or ``append``: reviews are
    appended, a business or user replaces the stored one. ``infer`` keeps every column of the files.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    tables = {}
    for entity, path in paths.items():
        tables[entity] = f"{prefix}{entity}"
        scan = scan_inferred(spark, path) if infer else scan_entity(spark, path, entity)
        _store(with_place(scan), entity, tables[entity], mode, fmt)
    return tables


def ingest_bundles(spark: SparkSession, path: str, prefix: str = "", fmt: str = "parquet",
                   entities: tuple[str, ...] = ("business", "review", "user"), extras: bool = False) -> dict[str, str]:
    """Bring all bundles under ``path`` into the tables, as ``ingest`` does with ``mode='append'``.

    ``extras`` keeps columns that are not declared as a map of JSON texts in ``_extra``. Every call
    takes what it reads; to take each bundle's reviews once however often it is offered, use
    ``placewise.streaming.increments``.
    """
    bundles = list_bundles(spark, path)
    tables = {}
    for entity in entities:
        tables[entity] = f"{prefix}{entity}"
        scan = scan_member(bundles, entity, place=True, extras=extras)
        if extras:
            scan = scan.withColumn("_extra", extra_columns(F.col(LINE_JSON), entity_schema(entity).names)).drop(LINE_JSON)
        _store(scan, entity, tables[entity], "append", fmt)
    return tables


def merge_table(records: DataFrame, name: str, key: str, fmt: str = "parquet") -> None:
    """Replace the stored rows of the keys in ``records`` (one row each) and add the others.

    The new rows are written once, beside the table; then the table is pointed to them, which is one change of
    the catalog. Until then, and if the job is lost, the table is the old one.
    """
    spark = records.sparkSession
    if not spark.catalog.tableExists(name):
        return overwrite_table(records, name, fmt)
    stored = spark.table(name)
    kept = stored.join(records.select(key), key, "left_anti")
    merged = kept.unionByName(records, allowMissingColumns=True)
    place = location_of(spark, name)
    path = f"{place}-{uuid.uuid4().hex}"
    merged.write.format(fmt).save(path)
    widen_table(spark, name, merged)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    delete_path(spark, place)


def _store(scanned: DataFrame, entity: str, name: str, mode: str, fmt: str) -> None:
    spark, key = scanned.sparkSession, KEYED.get(entity)
    good = newest(accepted(scanned, entity), entity)
    bad = rejected(scanned, entity).drop(MODIFIED, LINE)
    if (table := find(spark, name)) is not None:
        # The name is a view of a versioned table, which keeps where each record stood.
        table.merge(accepted(scanned, entity), key, replace=mode == "overwrite")
        table.publish(name)
    elif mode == "overwrite":
        overwrite_table(good, name, fmt)
    elif key:
        merge_table(good, name, key, fmt)
    else:
        append_table(good, name, fmt, widen=True)
    refused = f"{name}_rejected"
    if (table := find(spark, refused)) is not None:
        table.merge(rejected(scanned, entity), None, replace=mode == "overwrite")
        table.publish(refused)
    elif mode == "overwrite":
        overwrite_table(bad, refused, fmt)
    else:
        append_table(bad, refused, fmt, widen=True)


def quarantine(spark: SparkSession, name: str) -> DataFrame:
    """(_path, _bad_line) of everything a job rejected for table ``name``."""
    refused = find(spark, f"{name}_rejected")
    rows = refused.read(places=True) if refused is not None else spark.table(f"{name}_rejected")
    return rows.select(PATH, BAD_LINE)
