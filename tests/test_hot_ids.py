"""Joins on ids that a third of all rows share."""

import re

import pytest
from pyspark.sql import functions as F

from placewise.operators import indexing


@pytest.fixture(scope="module")
def reviews(spark):
    n = 60_000
    hot = F.col("id") % 3 == 0
    return (spark.range(n).repartition(8)
            .select(F.when(hot, "u0").otherwise(F.concat(F.lit("u"), F.col("id") % 5000)).alias("user_id"),
                    F.when(hot, "b0").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("b"), F.col("id") % 1999)).alias("business_id"),
                    (F.col("id") % 5).cast("double").alias("stars")))


@pytest.fixture(scope="module")
def maps(reviews, spark, tmp_path_factory):
    out = []
    for key, index in (("user_id", "userIndex"), ("business_id", "businessIndex")):
        path = str(tmp_path_factory.mktemp(key) / "map")
        indexing.frequency_index(reviews, key, index).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


@pytest.mark.parametrize("head", [0, 1, 100, 10_000])
def test_any_head_gives_the_same_rows(reviews, maps, head):
    plain = (reviews.join(maps[1], "business_id").join(maps[0], "user_id").groupBy("businessIndex", "userIndex", "stars").count())
    got = indexing.index_reviews(reviews, *maps, head=head)
    assert got.columns == ["user_id", "business_id", "stars", "businessIndex", "userIndex"]
    got = got.groupBy("businessIndex", "userIndex", "stars").count()
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_rows_of_hot_ids_stay_where_they_are(spark, reviews, maps):
    """No task of the result has more than its share of the rows, without adaptive splitting."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for key, value in zip(before, ("false", "-1", "16")):
        spark.conf.set(key, value)
    try:
        def most(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

        plain = reviews.join(maps[1], "business_id").join(maps[0], "user_id")
        split = indexing.index_reviews(reviews, *maps, head=10)
        n = split.count()
        assert most(plain) > n / 3 and most(split) < n / 8
        text = split._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" in text and not re.search("Cartesian|NestedLoop", text)
        assert re.search(r"businessIndex#\d+L? < 10", text) and re.search(r"businessIndex#\d+L? >= 10", text)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_reviews_are_read_once_to_be_numbered(spark, reviews, maps, tmp_path):
    reviews.write.parquet(str(tmp_path / "review"))
    stored = spark.read.parquet(str(tmp_path / "review"))
    plan = indexing.index_reviews(stored, *maps, head=10)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(rf"FileScan parquet .*{re.escape(str(tmp_path / 'review'))}", plan)) == 1


@pytest.mark.parametrize("head", [[], [0], [10]])
def test_map_of_indexed_rows_deals_rare_ids_before_it_groups_them(spark, reviews, maps, head):
    indexed = indexing.index_reviews(reviews, *maps)
    got = indexing.dimension_map(indexed, "business_id", "businessIndex", *head)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, maps[1].select("business_id", "businessIndex").collect()))
    # Under the first grouping of rare ids stands the shuffle that deals them.
    rare = got._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    assert re.search(r"Aggregate.*\n.*RepartitionByExpression \[business_id", rare)
