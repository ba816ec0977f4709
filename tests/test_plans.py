"""The physical plans are the ones the jobs are designed for."""

import re

import pytest
from pyspark.sql import functions as F

from placewise.operators import business as ops
from placewise.operators import lookup, nearest, similar
from placewise.plans import features, recommend
from placewise.sources.tables import read_path
from placewise.suite import queries


@pytest.fixture(scope="module")
def built(tables):
    return features.build_features(tables.business, tables.review)


@pytest.fixture
def shuffled(spark):
    """Plans as for tables too large to broadcast unasked."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def count(name: str, text: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(rf"[-+] {name}\b", tree))


def no_cross_join(text: str) -> bool:
    return "CartesianProduct" not in text and "NestedLoop" not in text


def test_review_counts_aggregate_before_the_shuffle(spark, built):
    text = plan(ops.review_counts(read_path(spark, built.review_transformed)))
    assert "partial_count" in text and count("Exchange", text) == 1
    assert "ReadSchema: struct<business_id:string,stars:double>" in text


def test_category_fan_out_needs_no_join(tables):
    text = plan(ops.with_categories(tables.business))
    assert count("Exchange", text) == 0 and "Join" not in text


def test_feature_table_shuffles_for_counts_and_category_numbers(spark, built, shuffled):
    """The rows move once for the review counts and once for the numbers of their categories, which may
    be many; the index moves once, and twice more as one row for each of its sort partitions."""
    counts = read_path(spark, built.review_counts).drop("n")
    text = plan(features.business_features(read_path(spark, built.business), counts))
    assert count("Exchange", text) == 6 and count("SortMergeJoin", text) == 2
    assert "EvalPython" not in text and no_cross_join(text)


def test_one_point_is_a_top_n_over_three_columns(spark, built):
    text = plan(nearest.nearest_to(read_path(spark, built.business_hashed), 1.0, 2.0, 5))
    assert "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<business_id:string,latitude:double,longitude:double>" in text


def test_one_point_over_stored_locations_needs_no_shuffle(spark, built):
    text = plan(nearest.nearest_to(read_path(spark, built.locations), 1.0, 2.0, 5, repeated=False))
    assert "TakeOrderedAndProject" in text and count("Exchange", text) == 0


def test_point_table_search_never_crosses(spark, built, tables, shuffled):
    index = nearest.location_index(read_path(spark, built.business_hashed), 5)
    text = plan(nearest.search(index, tables.points, 5))
    assert no_cross_join(text) and "WindowGroupLimit" in text and "EvalPython" not in text
    assert count("BroadcastHashJoin", text) == 3  # depths 5, 7 and 9, bounded in size


def test_similar_pairs_never_cross(tables, shuffled):
    known = similar.profiles(similar.category_sets(tables.business))
    assert no_cross_join(plan(similar.similar_profiles(known, 0.5)))


def test_lists_are_regrouped_once(spark, built, shuffled):
    lists = spark.createDataFrame([(0, [(0, 1.0)])],
                                  "userIndex int, recommendations array<struct<businessIndex: int, rating: float>>")
    text = plan(recommend.resolve_ids(lists, read_path(spark, built.user_map), read_path(spark, built.business_map)))
    assert count("Exchange", text) == 4  # both sides by business, lists and map by user


def test_id_lists_reach_the_scan(spark, built):
    text = plan(lookup.details(read_path(spark, built.business), ["b1", "b2"]))
    assert "In(business_id, [b1,b2])" in text
    by_table = plan(lookup.details(read_path(spark, built.business), read_path(spark, built.business_map)))
    assert "LeftSemi" in by_table


def test_stored_lists_are_clustered_by_key(spark, built):
    """Each file of the business table covers its own id range, so lookups skip files."""
    ranges = (read_path(spark, built.business).groupBy(F.input_file_name().alias("f"))
              .agg(F.min("business_id").alias("low"), F.max("business_id").alias("high")).orderBy("low").collect())
    assert all(a.high < b.low for a, b in zip(ranges, ranges[1:]))


def test_bucketed_tables_join_without_a_shuffle_and_prune(spark, tables, shuffled):
    from placewise.sources.tables import write_bucketed

    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    write_bucketed(tables.user, "bucketed.users", "user_id", 4)
    write_bucketed(tables.review, "bucketed.review", "user_id", 4)
    users, review = spark.table("bucketed.users"), spark.table("bucketed.review")
    text = plan(users.join(review, "user_id"))
    assert count("Exchange", text) == 0 and count("SortMergeJoin", text) == 1 and "SelectedBucketsCount: 4 out of 4" in text
    # Buckets are pruned either way; the plan only tells for scans it keeps by bucket.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    found = plan(lookup.point_lookup(spark.table("bucketed.users"), "user_id", "u7"))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in found
    counted = plan(review.groupBy("user_id").count())
    assert count("Exchange", counted) == 0


def test_lists_for_all_users_make_no_product(spark, built):
    model = recommend.fit_als(recommend.rating_rows(read_path(spark, built.review_transformed)), rank=3, maxIter=2)
    text = plan(recommend.recommend_all(model, read_path(spark, built.user_map), read_path(spark, built.business_map)))
    assert no_cross_join(text) and "MapInArrow" in text


def test_point_search_by_blocks_shuffles_little(spark, built, tables, shuffled):
    """After the index and the distinct places are written: the points' curve, and the join back."""
    from placewise.operators import proximity

    found = proximity.nearest_places(read_path(spark, built.business_hashed), tables.points, 5)
    text = plan(found)
    assert no_cross_join(text) and count("Exchange", text) <= 3 and "EvalPython" not in text


def test_rating_rows_of_the_queries_are_made_once(tables):
    """Each pass of a fit or a prediction would join and count all reviews again."""
    rows = queries._rating_rows(tables)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and queries._rating_rows(tables) is rows
    made = features.rating_features(tables.business, ops.review_counts(tables.review))
    assert rows.schema == made.schema and rows.count() == made.count()
    assert made.join(rows.withColumnsRenamed({"label": "l", "features": "f"}), "business_id").where("label = l and features = f").count() == made.count()
