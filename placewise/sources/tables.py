"""Catalog tables and path tables: scans, overwrites, appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_FORMAT = "parquet"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by one-, two- or three-part name."""
    return spark.table(name)


def read_path(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def overwrite_table(df: DataFrame, name: str, fmt: str = DEFAULT_FORMAT) -> None:
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


def align_to(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` with the target's columns and types; a missing column becomes null.

    A column the target does not have is an error, so nothing is lost unnoticed.
    """
    extra = set(df.columns) - set(target.columns)
    if extra:
        raise ValueError(f"columns not in the target table: {sorted(extra)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in target.schema.fields])


def append_table(df: DataFrame, name: str, fmt: str = DEFAULT_FORMAT, widen: bool = False) -> None:
    """Append a batch whose columns may be a subset of the table's; ``widen`` adds new columns to the table."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        if widen:
            widen_table(spark, name, df)
        df = align_to(df, spark.table(name))
    df.write.mode("append").format(fmt).saveAsTable(name)


def widen_table(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Add the columns of ``df`` that a catalog table does not have."""
    known = spark.table(name).columns
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")


def location_of(spark: SparkSession, name: str) -> str:
    """The folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Location").collect()
    return rows[0].data_type.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever the session's file systems have it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def overwrite_path(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def write_by_key(df: DataFrame, path: str, key: str) -> None:
    """Overwrite a Parquet path range-sorted by ``key``, so lookups skip most row groups."""
    overwrite_path(df.repartitionByRange(F.col(key)).sortWithinPartitions(key), path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Overwrite a catalog table dealt to ``buckets`` files by a hash of ``key`` and sorted by it in each.

    Tables with the same key and number of buckets join without a shuffle, also when asked again and again, and a
    lookup of some keys reads the buckets that hold them. Dealt before it is written, so that a bucket is one file.
    """
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def create_external_table(spark: SparkSession, name: str, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Register files already written at ``path`` as a catalog table."""
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
