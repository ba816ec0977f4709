"""String ids to dense numbers, most frequent first, ties by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.operators.ordering import number_rows
from placewise.session import shuffle_partitions

#: Keys that are broadcast because many rows may share them: about 1 MB, whatever the size of the data.
HEAD = 10_000


def label_counts(df: DataFrame, column: str) -> DataFrame:
    """(label, n) for every non-null label; partial aggregation absorbs hot labels."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n")))


def frequency_index(df: DataFrame, column: str, index: str, path: str | None = None) -> DataFrame:
    """(column, index) for any number of labels; nothing is gathered on the driver."""
    return index_counts(label_counts(df, column), column, index, path)


def index_counts(counts: DataFrame, column: str, index: str, path: str | None = None) -> DataFrame:
    """(column, index) from already counted labels (column, n)."""
    counts = counts.where(F.col(column).isNotNull()).select(column, "n")
    return number_rows(counts, [F.desc("n"), F.asc(column)], index, path=path).select(column, index)


def grown_index(known: DataFrame, counts: DataFrame, column: str, index: str, path: str | None = None) -> DataFrame:
    """(column, index): all known numbers as they are, then the labels that are new in ``counts`` (column, n) by falling count.

    Maps, ratings and factors that were stored under the old numbers stay valid. A known label that is
    gone keeps its number.
    """
    new = counts.where(F.col(column).isNotNull()).join(known.select(column), column, "left_anti").select(column, "n")
    last = known.agg(F.max(index)).first()[0]
    numbered = number_rows(new, [F.desc("n"), F.asc(column)], index, start=0 if last is None else last + 1, path=path)
    return known.select(column, F.col(index).cast("long").alias(index)).unionByName(numbered.select(column, index))


def with_popular(rows: DataFrame, mapping: DataFrame, key: str, rank: Column, head: int = HEAD) -> DataFrame:
    """``rows`` joined with ``mapping`` (one row for each ``key``), whose ``rank`` numbers the keys by falling count from 0.

    A key that many rows share would send them all to one task. So the first ``head`` keys are broadcast, a table
    of fixed size, and their rows stay where they are; only rows of rarer keys are shuffled.
    """
    popular = F.broadcast(mapping.where(rank < head))
    rest = rows.join(popular.select(key), key, "left_anti").join(mapping.where(rank >= head), key)
    return rows.join(popular, key).unionByName(rest)


def with_index(rows: DataFrame, mapping: DataFrame, key: str, index: str, head: int = HEAD) -> DataFrame:
    """``rows`` plus ``index`` of their ``key`` from ``mapping``, in one pass over them; rows without a number drop out.

    As in ``with_popular`` the first ``head`` keys are broadcast. Their rows are dealt over all tasks of the join
    with the rarer keys, so no task gets all rows of a popular key and the rows are not computed for each side.
    """
    popular = F.broadcast(mapping.where(F.col(index) < head).select(key, F.col(index).alias("_popular")))
    rare = mapping.where(F.col(index) >= head).select(key, F.xxhash64(key).alias("_deal"), F.col(index).alias("_rare"))
    found = rows.where(F.col(key).isNotNull()).join(popular, key, "left")
    # Copies of a row differ in the task that has them.
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in rows.columns])
    dealt = found.withColumn("_deal", F.when(F.col("_popular").isNull(), F.xxhash64(key)).otherwise(spread))
    numbered = dealt.join(rare, [key, "_deal"], "left").withColumn(index, F.coalesce("_popular", "_rare"))
    return numbered.where(F.col(index).isNotNull()).select(*rows.columns, index)


def index_reviews(review: DataFrame, user_map: DataFrame, business_map: DataFrame, head: int = HEAD) -> DataFrame:
    """Reviews plus businessIndex and userIndex, read once; rows without either id drop out."""
    return with_index(with_index(review, business_map, "business_id", "businessIndex", head), user_map, "user_id", "userIndex", head)


def dimension_map(indexed: DataFrame, key: str, index: str, head: int = HEAD) -> DataFrame:
    """Distinct (id, index) pairs of already indexed rows.

    A task that groups before a shuffle holds every id of its rows, which may be most of them. So only the first
    ``head`` ids, which may be popular, are grouped where they are; rows of the others are dealt by id first.
    """
    pairs = indexed.select(key, index)
    popular = pairs.where(F.col(index) < head).distinct()
    rare = (pairs.where(F.col(index).isNull() | (F.col(index) >= head))
            .repartition(shuffle_partitions(indexed.sparkSession), key).distinct())
    return popular.unionByName(rare)


def ids_of(mapping: DataFrame, indexes: DataFrame, key: str, index: str) -> DataFrame:
    """Original ids of a set of indexes, from the map rather than from the reviews."""
    return mapping.join(indexes.select(index), index, "left_semi").select(key)
