"""Business, review and user tables projected from the driver's tables.

Each projection is one SQL text that Spark and DuckDB both run.
"""

from __future__ import annotations

import math
import zipfile
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.session import scratch_path
from placewise.sources.bundles import MEMBERS

BUSINESS_SQL = """
SELECT concat('b', CAST(p_partkey AS STRING)) AS business_id, p_name AS name,
       CASE WHEN p_partkey % 50 = 0 THEN NULL
            ELSE concat(p_type, ', ', p_brand, ', ', replace(p_name, ' ', ', ')) END AS categories,
       concat('City', CAST(p_partkey % 17 AS STRING)) AS city,
       concat('S', CAST(p_partkey % 5 AS STRING)) AS state,
       CAST(p_partkey % 2 AS BIGINT) AS is_open,
       CASE WHEN p_partkey % 97 = 0 THEN NULL
            ELSE CAST((p_partkey * 7919) % 18000 AS DOUBLE) / 100.0 - 90.0 END AS latitude,
       CAST((p_partkey * 104729) % 36000 AS DOUBLE) / 100.0 - 180.0 AS longitude,
       CAST(5 + (p_partkey * 31) % 997 AS BIGINT) AS review_count,
       CAST(1 + p_partkey % 3 AS DOUBLE) + CAST(p_size % 5 AS DOUBLE) / 2 AS stars
FROM {part}
"""

REVIEW_SQL = """
SELECT concat('u', CAST(o_custkey AS STRING)) AS user_id,
       concat('b', CAST(CASE WHEN l_partkey % 40 = 1 THEN l_partkey + 1 ELSE l_partkey END AS STRING)) AS business_id,
       CAST(greatest(1, 1 + o_custkey % 3 + l_partkey % 3 - l_linenumber % 2) AS DOUBLE) AS stars
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

USER_SQL = """
SELECT concat('u', CAST(c_custkey AS STRING)) AS user_id, c_acctbal AS average_stars,
       CAST(c_custkey % 100 AS BIGINT) AS review_count, CAST(c_custkey % 7 AS BIGINT) AS fans,
       c_mktsegment AS elite
FROM {customer}
"""

POINT_SQL = """
SELECT concat('u', CAST(c_custkey AS STRING)) AS point_id,
       CAST((c_custkey * 4111) % 18000 AS DOUBLE) / 100.0 - 90.0 AS latitude,
       CAST((c_custkey * 6997) % 36000 AS DOUBLE) / 100.0 - 180.0 AS longitude
FROM {customer}
"""

RUN_SQL = """
SELECT event_type AS experiment, concat('run', CAST(event_id AS STRING)) AS run_id, ts AS start_time
FROM {events}
"""


class Tables:
    """The projected tables of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _project(self, sql: str, *names: str) -> DataFrame:
        return self.spark.sql(sql, **{name: self.raw(name) for name in names})

    @cached_property
    def business(self) -> DataFrame:
        return self._project(BUSINESS_SQL, "part")

    @cached_property
    def review(self) -> DataFrame:
        return self._project(REVIEW_SQL, "lineitem", "orders")

    @cached_property
    def user(self) -> DataFrame:
        return self._project(USER_SQL, "customer")

    @cached_property
    def points(self) -> DataFrame:
        return self._project(POINT_SQL, "customer")

    @cached_property
    def runs(self) -> DataFrame:
        return self._project(RUN_SQL, "events")


def full_business(business: DataFrame) -> DataFrame:
    """Business records with all declared fields, ``hours`` as the nested object of real files."""
    number = F.substring("business_id", 2, 20).cast("long")
    return business.select(
        F.concat(F.col("city"), F.lit(" street")).alias("address"),
        F.struct(F.when(number % 2 == 0, "True").otherwise("False").alias("ByAppointmentOnly")).alias("attributes"),
        "business_id", "categories", "city",
        F.struct(F.concat((number % 12).cast("string"), F.lit(":0-20:0")).alias("Monday")).alias("hours"),
        "is_open", "latitude", "longitude", "name",
        F.concat(F.lit("P"), (number % 100).cast("string")).alias("postal_code"),
        "review_count", "stars", "state")


def write_json(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.json(path)
    return path


#: Rows that one archive holds at most on average, as one task sorts and packs it and another one reads it.
ROWS_PER_BUNDLE = 500_000


def write_bundles(entities: dict[str, DataFrame], bundles: int, folder: str) -> str:
    """Pack entity rows into zip archives, each written by one task: ``bundles``, or more where those would hold too many rows."""
    bundles = max(bundles, math.ceil(sum(df.count() for df in entities.values()) / ROWS_PER_BUNDLE))
    lines = None
    for entity, df in entities.items():
        part = df.select(F.lit(entity).alias("entity"), F.to_json(F.struct(*df.columns)).alias("line"))
        lines = part if lines is None else lines.unionByName(part)
    spark = lines.sparkSession
    # The folder is made by Spark, so that it lies where the session's file system is.
    spark.range(0).write.mode("overwrite").parquet(folder)
    uri = folder if "://" in folder else "file:///" + folder.removeprefix("file:").lstrip("/")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        filesystem, location = fs.FileSystem.from_uri(uri)
        name = f"{location}/{1000 + TaskContext.get().partitionId()}.zip"
        member = stream = None
        with filesystem.open_output_stream(name) as out, \
                zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for batch in batches:
                # Rows come sorted by entity, and each run of one is written at once.
                start = 0
                for run in pc.value_counts(batch.column("entity")).to_pylist():
                    entity, end = run["values"], start + run["counts"]
                    if entity != member:
                        if stream:
                            stream.close()
                        member, stream = entity, archive.open(MEMBERS[entity], "w")
                    stream.write("".join(f"{line}\n" for line in batch.column("line")[start:end].to_pylist()).encode())
                    start = end
            if stream:
                stream.close()
        yield pa.RecordBatch.from_pydict({"bundle": [name]})

    key = F.xxhash64("line")
    (lines.repartition(bundles, key).sortWithinPartitions("entity")
     .mapInArrow(pack, "bundle STRING").write.format("noop").mode("overwrite").save())
    return f"{folder}/*.zip"
