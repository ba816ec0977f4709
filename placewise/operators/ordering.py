"""Dense global numbering without a single-task window.

A sort range-partitions the rows; each row's number is its position inside its
partition plus the rows in all earlier partitions. The sorted rows are written
once, so partition and position cannot change between the two passes, also when
an executor is lost in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewise.session import scratch_path

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


def number_rows(df: DataFrame, order: list[Column], number: str, start: int = 0,
                path: str | None = None) -> DataFrame:
    """``df`` plus a gap-free long column counting rows in ``order`` (a total order)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"ordered-{number}")
    (df.orderBy(*order)
       .withColumn("_seq", F.monotonically_increasing_id())
       .write.mode("overwrite").parquet(path))
    stored = spark.read.parquet(path).withColumn("_part", F.shiftright("_seq", _POSITION_BITS))
    # One row per sort partition, so this window and broadcast do not grow with the data.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")))
    position = F.col("_seq").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (stored.join(F.broadcast(offsets), "_part")
            .withColumn(number, position + F.col("_before") + F.lit(start))
            .drop("_seq", "_part", "_before"))
