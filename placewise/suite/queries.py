"""The registered queries. Each takes (spark, folder) and reads whole tables of the folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placewise.functions.columns import as_label, densify, haversine_distance, id_list, is_train, planar_distance
from placewise.operators import business as ops
from placewise.operators import lookup, similar, stats, weighted
from placewise.operators.indexing import dimension_map, frequency_index, grown_index, ids_of, index_reviews, label_counts
from placewise.operators.nearest import located, nearest, nearest_to
from placewise.operators.proximity import nearest_places
from placewise.operators.topk import top_lists
from placewise.plans import features as feature_plan
from placewise.plans import foldin, rating, recommend, statistics
from placewise.plans.ingest import ingest, ingest_bundles, quarantine
from placewise.session import scratch_path
from placewise.sources import json_lines, runs, tables
from placewise.sources.bundles import read_bundle
from placewise.streaming import increments
from placewise.suite.fixtures import Tables, full_business, write_bundles, write_json

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

POINT = (40.5, -73.9)
POINT_HITS = 5
BATCH_HITS = 10
ID_LIST = ["b1", "b7", "b20", "b33", "b150", "b-unknown"]
USER_ID = "u7"
SIMILAR_BELOW = 0.5
WEIGHTED_FROM = 0.8
SPLIT = (("businessIndex", 7919), ("userIndex", 104729))


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(spark, folder))

    QUERIES[fn.__name__] = run
    return run


_SHARED: dict[tuple, object] = {}


def shared(fn):
    """Reuse a written table set or a fitted model between the queries of one session."""
    @wraps(fn)
    def once(t: Tables):
        key = (fn.__name__, t.spark.sparkContext.applicationId, t.folder)
        if key not in _SHARED:
            _SHARED[key] = fn(t)
        return _SHARED[key]

    return once


def number(column: str) -> Column:
    """The numeric part of a fixture id such as b17 or u3."""
    return F.substring(column, 2, 20).cast("long")


def scratch_database(spark: SparkSession) -> str:
    name = f"placewise_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


def rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column).cast("double"), digits).alias(column)


# ---------------------------------------------------------------- sources

@query
def scan_json_explicit(t: Tables) -> DataFrame:
    path = write_json(full_business(t.business), "business-json")
    return (json_lines.read_entity(t.spark, path, "business")
            .withColumn("by_appointment", F.col("attributes.ByAppointmentOnly")).drop("attributes"))


@query
def scan_json_inferred(t: Tables) -> DataFrame:
    return json_lines.read_entity(t.spark, write_json(t.review, "review-json"), "review", infer=True)


@query
def scan_json_quarantine(t: Tables) -> DataFrame:
    key = number("business_id")
    line = (F.when(key % 50 == 3, F.concat(F.lit("not json "), F.col("business_id")))
            .when(key % 41 == 5, F.to_json(F.struct("name", "stars")))
            .otherwise(F.to_json(F.struct("business_id", "name", "stars"))))
    path = scratch_path(t.spark, "mixed-lines")
    t.business.select(line.alias("value")).write.text(path)
    scanned = json_lines.scan_entity(t.spark, path, "business")
    kept = json_lines.accepted(scanned, "business").select("business_id", "name", "stars")
    out = json_lines.rejected(scanned, "business")
    return (kept.withColumn("bad_line", F.lit(None).cast("string"))
            .unionByName(out.select("business_id", "name", "stars", F.col("_bad_line").alias("bad_line"))))


@query
def scan_json_view(t: Tables) -> DataFrame:
    name = f"user_{uuid.uuid4().hex}"
    json_lines.create_json_view(t.spark, name, write_json(t.user, "user-json"), "user")
    return t.spark.sql(f"SELECT * FROM {name}")


@query
def scan_catalog_table(t: Tables) -> DataFrame:
    name = f"spark_catalog.{scratch_database(t.spark)}.review"
    tables.overwrite_table(t.review, name)
    return tables.read_table(t.spark, name)


@query
def scan_parquet_path(t: Tables) -> DataFrame:
    return tables.read_path(t.spark, f"{t.folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


def _bundles(t: Tables, bundles: int = 4) -> str:
    entities = {"business": full_business(t.business), "review": t.review, "user": t.user}
    return write_bundles(entities, bundles, scratch_path(t.spark, "bundles"))


@query
def scan_zip_bundle(t: Tables) -> DataFrame:
    return read_bundle(t.spark, _bundles(t), "business").select(
        "business_id", "name", "categories", "hours", "stars", "review_count", "latitude")


@query
def latest_run(t: Tables) -> DataFrame:
    return runs.latest_runs(t.runs)


# ---------------------------------------------------------------- sinks

@query
def sink_overwrite_table(t: Tables) -> DataFrame:
    name = f"{scratch_database(t.spark)}.business"
    tables.overwrite_table(t.user, name)
    tables.overwrite_table(t.business, name)
    return tables.read_table(t.spark, name)


@query
def sink_append_table(t: Tables) -> DataFrame:
    name = f"{scratch_database(t.spark)}.business"
    even = number("business_id") % 2 == 0
    tables.overwrite_table(t.business.where(even), name)
    tables.append_table(t.business.where(~even).drop("city", "stars"), name)
    return tables.read_table(t.spark, name)


@query
def sink_overwrite_path(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "review")
    tables.overwrite_path(t.user, path)
    tables.overwrite_path(t.review, path)
    return tables.read_path(t.spark, path)


@query
def sink_external_table(t: Tables) -> DataFrame:
    path, name = scratch_path(t.spark, "user"), f"{scratch_database(t.spark)}.user_external"
    tables.overwrite_path(t.user, path)
    tables.create_external_table(t.spark, name, path)
    return tables.read_table(t.spark, name)


@query
def sink_sorted_by_key(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "by-key")
    tables.write_by_key(t.business, path, "business_id")
    return lookup.point_lookup(tables.read_path(t.spark, path), "business_id", "b33")


@query
def sink_bucketed(t: Tables) -> DataFrame:
    """Users, their lists and their reviews, each stored by user in buckets, joined without a shuffle of the stored sides."""
    where, built = scratch_database(t.spark), _built(t)
    counts = tables.read_path(t.spark, built.review_transformed).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("stars"))
    lists = _stand_in_lists(t).select("user_id", F.array_join(id_list(), ",").alias("business_ids"))
    for name, df in (("users", t.user), ("counts", counts), ("lists", lists)):
        tables.write_bucketed(df, f"{where}.{name}", "user_id", 8)
    users, counts, lists = (t.spark.table(f"{where}.{n}") for n in ("users", "counts", "lists"))
    return (users.join(counts, "user_id", "left").join(lists, "user_id", "left").select("user_id", "fans", "n", "stars", "business_ids"))


@query
def sink_metric(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "runs")
    runs.log_metric(stats.rmse(_scored(t)), path, "stand-in", "run1", "rmse")
    runs.log_metric(stats.rmse(_scored(t).where(F.col("label") >= 2.5)), path, "stand-in", "run2", "rmse")
    logged = runs.read_runs(t.spark, path)
    newest = runs.latest_runs(logged).withColumn("latest", F.lit(True))
    return (logged.join(newest, ["experiment", "run_id"], "left")
            .select("experiment", "run_id", "metric", rounded("value"),
                    F.coalesce("latest", F.lit(False)).alias("latest")))


@query
def sink_model(t: Tables) -> DataFrame:
    rows = _rating_rows(t)
    model, path = _linear(t), scratch_path(t.spark, "model")
    runs.save_model(model, path)
    before = rating.predict(model, rows).select("business_id", F.col("prediction").alias("before"))
    after = rating.predict(runs.load_model(path), rows).select("business_id", F.col("prediction").alias("after"))
    same = F.col("before") == F.col("after")
    return before.join(after, "business_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("same"))


# ---------------------------------------------------------------- projections and filters

@query
def user_features(t: Tables) -> DataFrame:
    return ops.user_features(t.user)


@query
def business_numerics(t: Tables) -> DataFrame:
    return ops.business_numerics(t.business)


@query
def filter_id_list(t: Tables) -> DataFrame:
    return lookup.with_ids(t.business, ID_LIST).select("business_id", "name", "stars")


@query
def filter_id_table(t: Tables) -> DataFrame:
    wanted = t.review.where(F.col("stars") >= 5).select("business_id")
    return lookup.with_ids(t.business, wanted).select("business_id", "name", "stars")


@query
def lookup_user(t: Tables) -> DataFrame:
    return lookup.point_lookup(t.user, "user_id", USER_ID)


@query
def lookup_user_reviews(t: Tables) -> DataFrame:
    return lookup.point_lookup(t.review, "user_id", USER_ID)


@query
def label_projection(t: Tables) -> DataFrame:
    text = F.when(number("business_id") % 10 == 0, "n/a").otherwise(F.col("stars").cast("string"))
    return t.business.withColumn("stars_text", text).select("business_id", as_label("stars_text"))


@query
def distance_column(t: Tables) -> DataFrame:
    lat, lon = F.lit(POINT[0]), F.lit(POINT[1])
    return (t.business.withColumn("distance", planar_distance(F.col("latitude"), F.col("longitude"), lat, lon))
            .select("business_id", rounded("distance")))


@query
def distance_haversine(t: Tables) -> DataFrame:
    """From one point, and from the place across the antimeridian."""
    lat, lon = F.lit(POINT[0]), F.lit(POINT[1])
    across = haversine_distance(F.col("latitude"), F.col("longitude"), -F.col("latitude"), F.lit(180.0))
    return (t.business.withColumn("distance", haversine_distance(F.col("latitude"), F.col("longitude"), lat, lon))
            .withColumn("across", across).select("business_id", rounded("distance", 3), rounded("across", 3)))


@query
def skip_unlabelled(t: Tables) -> DataFrame:
    encoded = feature_plan.encode_categories(_joined_rows(t), feature_plan.category_index(t.business))
    return encoded.select("business_id", "category", F.col("categoryIndex").cast("long").alias("categoryIndex"))


@query
def skip_incomplete(t: Tables) -> DataFrame:
    joined = _joined_rows(t)
    return ops.without_missing(joined, [*feature_plan.NUMERIC_INPUTS, "category"])


@query
def portable_split(t: Tables) -> DataFrame:
    indexed = tables.read_path(t.spark, _built(t).review_transformed)
    return indexed.withColumn("train", is_train(*SPLIT)).select("user_id", "business_id", "stars", "train")


@query
def random_split(t: Tables) -> DataFrame:
    train, test = recommend.random_split(t.review, seed=42)
    both = train.withColumn("train", F.lit(1)).unionByName(test.withColumn("train", F.lit(0)))
    # Every review once, on one side: per business the counts of both sides add up to its reviews.
    share = both.agg(F.avg("train")).scalar()
    return (both.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("stars"),
                                            F.max((share > 0.75) & (share < 0.85)).alias("about_80_percent")))


@query
def bernoulli_sample(t: Tables) -> DataFrame:
    """Rows of a 1 % sample that are no review or drawn more often than stored, and whether its size is likely."""
    keys = ["user_id", "business_id", "stars"]
    drawn = t.review.sample(False, 0.01, 42)
    have = t.review.groupBy(*keys).agg(F.count(F.lit(1)).alias("have"))
    over = (drawn.groupBy(*keys).agg(F.count(F.lit(1)).alias("drawn")).join(have, keys, "left")
            .where(F.col("have").isNull() | (F.col("drawn") > F.col("have"))))
    n, size = t.review.agg(F.count(F.lit(1))).scalar(), drawn.agg(F.count(F.lit(1))).scalar()
    likely = F.abs(size - n * 0.01) < 6 * F.sqrt(n * 0.01 * 0.99)
    return over.agg(F.count(F.lit(1)).alias("wrong")).select("wrong", likely.alias("likely_size"))


@query
def distinct_reviews(t: Tables) -> DataFrame:
    return t.review.dropDuplicates()


@query
def recommended_ids(t: Tables) -> DataFrame:
    return _stand_in_lists(t).select("user_id", F.array_join(id_list(), ",").alias("business_ids"))


# ---------------------------------------------------------------- joins

@query
def join_review_counts(t: Tables) -> DataFrame:
    return ops.with_review_counts(ops.business_numerics(t.business), t.review)


@query
def join_categories(t: Tables) -> DataFrame:
    return _joined_rows(t)


@query
def join_recommendation_names(t: Tables) -> DataFrame:
    return recommend.flatten(_stand_in_lists(t)).select(
        "user_id", F.col("rank").cast("long").alias("rank"), "business_id", rounded("rating", 4))


@query
def resolve_recommendations(t: Tables) -> DataFrame:
    entries = F.transform("recommendations", lambda e: F.concat(
        e["businessIndex"].cast("string"), F.lit(":"), e["business_id"]))
    return _stand_in_lists(t).select("user_id", F.col("userIndex").cast("long").alias("userIndex"),
                                     F.array_join(entries, ",").alias("entries"))


@query
def ids_of_indexes(t: Tables) -> DataFrame:
    built = _built(t)
    best = (recommend.flatten(_stand_in_lists(t)).where(F.col("rank") == 1)
            .join(tables.read_path(t.spark, built.business_map), "business_id").select("businessIndex"))
    return ids_of(tables.read_path(t.spark, built.business_map), best, "business_id", "businessIndex")


@query
def similar_exact(t: Tables) -> DataFrame:
    known = _profiles(t)
    return similar.similar_profiles(known, SIMILAR_BELOW).select("profile_a", "profile_b", rounded("distance"))


@query
def similar_members(t: Tables) -> DataFrame:
    return similar.profile_members(_sets(t), _profiles(t))


@query
def similar_minhash(t: Tables) -> DataFrame:
    signed = similar.profile_signatures(_profiles(t), feature_plan.category_index(t.business).count())
    return (similar.approx_similar_profiles(signed, SIMILAR_BELOW)
            .select("profile_a", "profile_b", rounded("distance")))


@query
def similar_weighted(t: Tables) -> DataFrame:
    """Pairs of businesses alike over all numbers and categories."""
    profiles, _ = weighted.distinct_vectors(weighted.vectors(t.business, ops.review_counts(t.review)))
    return weighted.similar_vectors(profiles, WEIGHTED_FROM).select("profile_a", "profile_b", rounded("similarity"))


# ---------------------------------------------------------------- aggregates

@query
def review_counts(t: Tables) -> DataFrame:
    return ops.review_counts(t.review)


@query
def distinct_locations(t: Tables) -> DataFrame:
    return located(tables.read_path(t.spark, _built(t).business_hashed))


@query
def category_ranking(t: Tables) -> DataFrame:
    return frequency_index(ops.category_rows(t.business), "category", "categoryIndex")


@query
def rmse_fixed(t: Tables) -> DataFrame:
    return stats.rmse(_scored(t)).select("n", rounded("rmse"))


@query
def prediction_summary(t: Tables) -> DataFrame:
    return stats.describe(_scored(t), ["label", "prediction"]).select(
        "column", *[rounded(c) for c in ("count", "mean", "stddev", "min", "max")])


@query
def row_counts(t: Tables) -> DataFrame:
    named = {"business": t.business, "review": t.review, "user": t.user}
    counted = [stats.row_count(df).withColumn("entity", F.lit(name)) for name, df in named.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# ---------------------------------------------------------------- top-k and ranking

@query
def nearest_to_point(t: Tables) -> DataFrame:
    features = _feature_rows(t)
    return nearest_to(features, *POINT, n=POINT_HITS).select("business_id", rounded("distance"))


@query
def nearest_to_stored_location(t: Tables) -> DataFrame:
    locations = tables.read_path(t.spark, _built(t).locations)
    return nearest_to(locations, *POINT, n=POINT_HITS, repeated=False).select("business_id", rounded("distance"))


@query
def nearest_to_points(t: Tables) -> DataFrame:
    found = nearest(tables.read_path(t.spark, _built(t).business_hashed), t.points, BATCH_HITS)
    return found.select("point_id", "business_id", rounded("distance"), F.col("rank").cast("long").alias("rank"))


def edge_points(t: Tables) -> DataFrame:
    """The points, and for each of them one on the antimeridian and one at a pole."""
    n = number("point_id")
    edge = t.points.select(F.concat(F.lit("e"), "point_id").alias("point_id"), "latitude",
                           F.when(n % 2 == 0, 180.0).otherwise(-180.0).alias("longitude"))
    pole = t.points.select(F.concat(F.lit("p"), "point_id").alias("point_id"),
                           F.when(n % 2 == 0, 90.0).otherwise(-90.0).alias("latitude"), "longitude")
    return t.points.unionByName(edge).unionByName(pole)


@query
def nearest_haversine(t: Tables) -> DataFrame:
    found = nearest_places(tables.read_path(t.spark, _built(t).business_hashed), edge_points(t), BATCH_HITS)
    return found.select("point_id", "business_id", rounded("distance", 3), F.col("rank").cast("long").alias("rank"))


@query
def nearest_planar_blocks(t: Tables) -> DataFrame:
    found = nearest_places(tables.read_path(t.spark, _built(t).business_hashed), t.points, BATCH_HITS, "planar")
    return found.select("point_id", "business_id", rounded("distance"), F.col("rank").cast("long").alias("rank"))


@query
def top_items_exact(t: Tables) -> DataFrame:
    """Best businesses for each user by the inner product of plain columns, whole in single precision."""
    users = t.user.select(number("user_id").cast("int").alias("id"),
                          F.array(F.col("fans") - 2, F.col("review_count") % 10, F.length("elite")).cast("array<float>").alias("features"))
    items = t.business.select(number("business_id").cast("int").alias("id"),
                              F.array(F.col("stars") * 2, F.col("review_count") % 13 - 6, F.col("is_open") * 3).cast("array<float>").alias("features"))
    found = top_lists(users, items, BATCH_HITS).select("userIndex", F.posexplode("recommendations").alias("at", "entry"))
    return found.select(F.col("userIndex").cast("long").alias("user"), (F.col("at") + 1).cast("long").alias("rank"),
                        F.col("entry.businessIndex").cast("long").alias("item"), F.col("entry.rating").cast("double").alias("score"))


@query
def rank_fixed_scores(t: Tables) -> DataFrame:
    scores = t.review.groupBy("business_id").agg(F.round(F.avg("stars"), 6).alias("prediction"))
    return lookup.rank_descending(scores, "prediction", "business_id")


@query
def rank_given_businesses(t: Tables) -> DataFrame:
    wanted = t.review.where(F.col("stars") >= 5).select("business_id")
    path = scratch_path(t.spark, "ranked")
    tables.overwrite_path(rating.rank_businesses(_linear(t), _rating_rows(t), wanted), path)
    ranked = tables.read_path(t.spark, path)
    after = ranked.select((F.col("rank") - 1).alias("rank"), F.col("prediction").alias("after"))
    n, top, total = (ranked.agg(c).scalar() for c in (F.count(F.lit(1)), F.max("rank"), F.sum("rank")))
    gap_free = (top == n) & (total * 2 == n * (n + 1))
    best_first = F.coalesce(F.col("after") <= F.col("prediction"), F.lit(True))
    return ranked.join(after, "rank", "left").select("business_id", gap_free.alias("gap_free"), best_first.alias("best_first"))


# ---------------------------------------------------------------- expressions

@query
def category_rows(t: Tables) -> DataFrame:
    return ops.category_rows(t.business)


@query
def category_rows_trimmed(t: Tables) -> DataFrame:
    loose = t.business.withColumn("categories", F.replace("categories", F.lit(", "), F.lit(" ,  ")))
    return ops.category_rows(loose, r"\s*,\s*")


@query
def feature_slots(t: Tables) -> DataFrame:
    features = _feature_rows(t)
    return _slots(features, "features")


@query
def category_slots(t: Tables) -> DataFrame:
    features = _feature_rows(t)
    return _slots(features, "categoryVec")


@query
def rating_feature_slots(t: Tables) -> DataFrame:
    rows = _rating_rows(t).withColumn("category", F.lit("all"))
    return _slots(rows, "features").drop("category")


def _slots(features: DataFrame, column: str) -> DataFrame:
    return (features.select("business_id", "category", F.posexplode(densify(F.col(column))).alias("slot", "value"))
            .where(F.col("value") != 0).withColumn("slot", F.col("slot").cast("long")))


# ---------------------------------------------------------------- models

@query
def indexed_reviews(t: Tables) -> DataFrame:
    users = frequency_index(t.review, "user_id", "userIndex")
    businesses = frequency_index(t.review, "business_id", "businessIndex")
    return index_reviews(t.review, users, businesses)


@query
def growing_index(t: Tables) -> DataFrame:
    """Numbers of businesses by their good reviews, then grown by all reviews: the first ones stay."""
    path = scratch_path(t.spark, "first-index")
    tables.overwrite_path(frequency_index(t.review.where(F.col("stars") >= 5), "business_id", "businessIndex"), path)
    return grown_index(tables.read_path(t.spark, path), label_counts(t.review, "business_id"), "business_id", "businessIndex")


@query
def user_index_map(t: Tables) -> DataFrame:
    indexed = tables.read_path(t.spark, _built(t).review_transformed)
    return dimension_map(indexed, "user_id", "userIndex")


@query
def business_index_map(t: Tables) -> DataFrame:
    indexed = tables.read_path(t.spark, _built(t).review_transformed)
    return dimension_map(indexed, "business_id", "businessIndex")


@query
def minhash_signatures(t: Tables) -> DataFrame:
    hashed = similar.signatures(_feature_rows(t))
    return hashed.select("business_id", "category",
                         *[densify(F.col("hashes")[i])[0].cast("long").alias(f"h{i}") for i in range(5)])


@query
def als_holdout(t: Tables) -> DataFrame:
    model, test = _als(t)
    scored = recommend.score(model, test)
    error = F.col("stars") - F.col("prediction")
    quality = scored.agg(F.count(F.lit(1)).alias("scored"),
                         (F.sqrt(F.avg(error * error)) < F.stddev_samp("stars")).alias("beats_spread"))
    factors = model.userFactors.select("features").unionByName(model.itemFactors.select("features"))
    smallest = factors.agg((F.min(F.array_min("features")) >= 0).alias("nonnegative"))
    return quality.select("*", smallest.scalar().alias("nonnegative"))


@query
def als_predictions(t: Tables) -> DataFrame:
    model, test = _als(t)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return recommend.score(model, test).select(F.col("userIndex").cast("long").alias("userIndex"),
                                               F.col("businessIndex").cast("long").alias("businessIndex"),
                                               "stars", finite.alias("finite"))


@query
def als_recommendations(t: Tables) -> DataFrame:
    return recommend.flatten(_als_lists(t)).select("user_id", F.col("rank").cast("long").alias("rank"))


@query
def als_recommendation_lists(t: Tables) -> DataFrame:
    ratings_down = F.transform("recommendations", lambda e: -e["rating"])
    listed = _als_lists(t).select("user_id", F.size("recommendations").cast("long").alias("listed"),
                                  (F.array_sort(ratings_down) == ratings_down).alias("best_first"),
                                  F.size(F.array_distinct(id_list())).cast("long").alias("different"))
    return listed


@query
def als_lookup(t: Tables) -> DataFrame:
    strangers = t.user.select(F.concat(F.lit("x"), "user_id").alias("user_id"))
    asked = t.user.select("user_id").unionByName(strangers)
    return (lookup.recommendations_for(_als_lists(t), asked)
            .select("user_id", F.size("business_ids").cast("long").alias("listed")))


@query
def list_lookup(t: Tables) -> DataFrame:
    strangers = t.user.select(F.concat(F.lit("x"), "user_id").alias("user_id"))
    asked = t.user.select("user_id").unionByName(strangers)
    return (lookup.recommendations_for(_stand_in_lists(t), asked)
            .select("user_id", F.array_join("business_ids", ",").alias("business_ids")))


@query
def als_user_subset(t: Tables) -> DataFrame:
    model, _ = _als(t)
    user_map = tables.read_path(t.spark, _built(t).user_map)
    chosen = t.user.where(F.col("elite") == "BUILDING")
    lists = recommend.recommend_users(model, 5, user_map, chosen)
    return (lists.join(user_map, "userIndex")
            .select("user_id", F.size("recommendations").cast("long").alias("listed")))


@query
def als_fold_in(t: Tables) -> DataFrame:
    """Trained users folded in from their ratings: whether they get their factors, and lists as new users."""
    model, _ = _als(t)
    seen = recommend.rating_rows(tables.read_path(t.spark, _built(t).review_transformed)).where(is_train(*SPLIT))
    folded = foldin.fold_in(model.itemFactors, seen, model.rank)
    trained = model.userFactors.select("id", F.col("features").alias("trained"))
    apart = F.aggregate(F.zip_with("features", "trained", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: F.greatest(s, x.cast("double")))
    arrived = seen.withColumn("userIndex", F.col("userIndex") + 1_000_000_000)
    lists = foldin.recommend_arrived(model, arrived, 5).select((F.col("userIndex") - 1_000_000_000).alias("id"), F.size("recommendations").cast("long").alias("listed"))
    return (trained.join(folded, "id", "left").join(lists, "id", "left").join(tables.read_path(t.spark, _built(t).user_map), F.col("id") == F.col("userIndex"))
            .select("user_id", (apart < 0.005).alias("same_factors"), "listed"))


@query
def als_implicit(t: Tables) -> DataFrame:
    built = _built(t)
    ratings = recommend.rating_rows(tables.read_path(t.spark, built.review_transformed))
    model = recommend.fit_implicit(ratings)
    lists = recommend.recommend_users(model, 5)
    named = recommend.resolve_ids(lists, tables.read_path(t.spark, built.user_map),
                                  tables.read_path(t.spark, built.business_map))
    flat = recommend.flatten(named)
    return flat.groupBy("user_id").agg(F.count_distinct("business_id").alias("listed"),
                                       (F.min("rating") >= 0).alias("nonnegative"))


@query
def train_als_random(t: Tables) -> DataFrame:
    ratings = recommend.rating_rows(tables.read_path(t.spark, _built(t).review_transformed))
    train, test = recommend.random_split(ratings, seed=42)
    model, quality = recommend.train_als(ratings, seed=42)
    spread = ratings.agg(F.stddev_samp("stars")).scalar()
    return quality.select((F.col("rmse") < spread).alias("beats_spread"), (F.col("n") > 0).alias("scored"),
                          (F.lit(train.count() + test.count())).cast("long").alias("split_rows"))


@query
def rating_trees(t: Tables) -> DataFrame:
    return _rating_quality(t, "gbt")


@query
def rating_linear(t: Tables) -> DataFrame:
    return _rating_quality(t, "linear")


@query
def rating_predictions(t: Tables) -> DataFrame:
    rows = _rating_rows(t)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return rating.predict(_linear(t), rows).select("business_id", "label", finite.alias("finite"))


@query
def rating_refit(t: Tables) -> DataFrame:
    rows = _rating_rows(t)
    stored, arrived = rating.split_by_business(rows, _train_business())
    model = rating.refit(stored, arrived, kind="linear")
    spread = F.stddev_samp("label")
    error = F.col("label") - F.col("prediction")
    return rating.predict(model, rows).agg(F.count(F.lit(1)).alias("scored"),
                                           (F.sqrt(F.avg(error * error)) < spread).alias("beats_spread"))


@query
def rating_refit_statistics(t: Tables) -> DataFrame:
    """Sums of old rows plus those of new ones against a full fit: the model, and each business's prediction."""
    rows = _rating_rows(t)
    stored, arrived = rating.split_by_business(rows, _train_business())
    path = scratch_path(t.spark, "statistics")
    tables.overwrite_path(statistics.statistics(stored), path)
    added = statistics.solve(statistics.together(tables.read_path(t.spark, path), statistics.statistics(arrived)))
    full = statistics.solve(statistics.statistics(rows))
    after = added.predict(rows).select("business_id", F.col("prediction").alias("after"))
    return (full.predict(rows).join(after, "business_id")
            .select("business_id", "label", (F.abs(F.col("prediction") - F.col("after")) < 1e-9).alias("same"), F.lit(added.rows).cast("long").alias("n")))


def _rating_quality(t: Tables, kind: str) -> DataFrame:
    rows = _rating_rows(t)
    _, quality = rating.train_rating_model(rows, _train_business(), kind=kind)
    _, unseen = rating.split_by_business(rows, _train_business())
    spread = unseen.agg(F.stddev_samp("label").alias("spread")).scalar()
    # Near-zero error would mean that the label had leaked into the features.
    return quality.select(F.col("n").alias("scored"), (F.col("rmse") < spread).alias("within_spread"),
                          (F.col("rmse") > 0.5).alias("no_leak"))


def _train_business() -> Column:
    return F.pmod(number("business_id") * 7919, F.lit(10)) < 8


# ---------------------------------------------------------------- jobs

@query
def bootstrap_ingest(t: Tables) -> DataFrame:
    paths = {"business": write_json(full_business(t.business.unionAll(t.business)), "business-json"),
             "review": write_json(t.review, "review-json"), "user": write_json(t.user, "user-json")}
    names = ingest(t.spark, paths, prefix=f"{scratch_database(t.spark)}.")
    stored = t.spark.table(names["business"]).select("business_id", F.col("stars").alias("value"))
    users = t.spark.table(names["user"]).select(F.col("user_id").alias("business_id"),
                                                F.col("average_stars").alias("value"))
    per_business = (t.spark.table(names["review"]).groupBy(F.concat(F.lit("r"), "business_id").alias("business_id"))
                    .agg(F.sum("stars").alias("value")))
    return (stored.unionByName(users).unionByName(per_business)
            .select(F.col("business_id").alias("id"), "value"))


@query
def append_bundles(t: Tables) -> DataFrame:
    prefix = f"{scratch_database(t.spark)}."
    names = ingest(t.spark, {"review": write_json(t.review, "review-json")}, prefix=prefix)
    ingest_bundles(t.spark, _bundles(t), prefix=prefix, entities=("review",))
    return (t.spark.table(names["review"]).groupBy("business_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("stars")))


@query
def update_job(t: Tables) -> DataFrame:
    """All three tables after a bootstrap, two bundles (the newer one first), both once more, and a later append."""
    key, who = number("business_id"), number("user_id")
    prefix, target, progress = f"{scratch_database(t.spark)}.", scratch_path(t.spark, "updated"), scratch_path(t.spark, "progress")
    # The reviews are a join, which the bootstrap, both bundles and their counts would each do again.
    kept = scratch_path(t.spark, "review")
    tables.overwrite_path(t.review, kept)
    review = tables.read_path(t.spark, kept)
    ingest(t.spark, {"business": write_json(full_business(t.business.where(key % 3 != 0)), "business-json"),
                     "review": write_json(review, "review-json"), "user": write_json(t.user, "user-json")}, prefix=prefix)
    older, newer = scratch_path(t.spark, "bundles"), scratch_path(t.spark, "bundles")
    raised = lambda df, column, by: df.withColumn(column, F.col(column) + by)
    first = write_bundles({"business": raised(full_business(t.business.where(key % 2 == 0)), "stars", 10), "review": review.where(who % 5 == 0),
                           "user": raised(t.user.where(who % 2 == 0), "fans", 10)}, 2, older)
    second = write_bundles({"business": raised(full_business(t.business.where(key % 4 == 0)), "stars", 20), "review": review.where(who % 7 == 0),
                            "user": raised(t.user.where(who % 3 == 0), "fans", 20)}, 2, newer)
    for name, bundles in (("newer", second), ("older", first), ("newer", second), ("older", first)):
        increments.update_tables(t.spark, bundles, target, f"{progress}/{name}", prefix, buckets=8)
    ingest(t.spark, {"user": write_json(raised(t.user.where(who % 11 == 0), "fans", 30), "user-json")}, mode="append", prefix=prefix)
    names = increments.update_tables(t.spark, first, target, f"{progress}/older", prefix)
    stored = {e: t.spark.table(n) for e, n in names.items()}
    return (stored["business"].select(F.col("business_id").alias("id"), F.lit(1).cast("long").alias("n"), F.col("stars").alias("value"))
            .unionByName(stored["user"].select(F.col("user_id").alias("id"), F.lit(1).cast("long").alias("n"), F.col("fans").cast("double").alias("value")))
            .unionByName(stored["review"].groupBy(F.concat(F.lit("r"), "user_id").alias("id"))
                         .agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("value"))))


@query
def stored_rejects(t: Tables) -> DataFrame:
    """What a bootstrap and a bundle job put aside, with the record or the raw text."""
    key = number("business_id")
    prefix, target = f"{scratch_database(t.spark)}.", scratch_path(t.spark, "updated")
    line = F.when(key % 5 == 0, F.concat(F.lit("broken "), "business_id")).when(key % 7 == 0, F.to_json(F.struct("name"))).otherwise(F.to_json(F.struct("business_id", "name")))
    path = scratch_path(t.spark, "mixed-lines")
    t.business.select(line.alias("value")).write.text(path)
    names = ingest(t.spark, {"business": path}, prefix=prefix)
    unnamed = full_business(t.business.where(key % 6 == 0)).withColumn("business_id", F.lit(None).cast("string"))
    bundles = write_bundles({"business": unnamed}, 2, scratch_path(t.spark, "bundles"))
    names = increments.update_tables(t.spark, bundles, target, scratch_path(t.spark, "progress"), prefix)
    return (t.spark.table(f"{names['business']}_rejected").groupBy(F.col("_bad_line").alias("bad_line"), "name").agg(F.count(F.lit(1)).alias("n")))


@query
def stored_extras(t: Tables) -> DataFrame:
    """Columns that are not declared: inferred from files, and as a map from bundles."""
    prefix, target = f"{scratch_database(t.spark)}.", scratch_path(t.spark, "updated")
    review = t.review.where(F.col("stars") >= 4).withColumn("text", F.concat("user_id", F.lit(" on "), "business_id"))
    files = ingest(t.spark, {"review": write_json(review, "review-json")}, prefix=f"{prefix}file_", infer=True)
    bundles = write_bundles({"review": review}, 2, scratch_path(t.spark, "bundles"))
    names = increments.update_tables(t.spark, bundles, target, scratch_path(t.spark, "progress"), f"{prefix}bundle_", extras=True)
    found = (t.spark.table(files["review"]).select("user_id", "text").unionByName(
        t.spark.table(names["review"]).select("user_id", F.col("_extra")["text"].alias("text"))))
    return found.groupBy("user_id", "text").agg(F.count(F.lit(1)).alias("n"))


@query
def latest_ratings(t: Tables) -> DataFrame:
    """Each user's last rating of a business, and the mean of all of them."""
    dated = t.raw("lineitem").join(t.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = dated.select(F.col("o_custkey").alias("userIndex"), F.col("l_partkey").alias("businessIndex"),
                        F.col("l_quantity").cast("double").alias("stars"), F.col("o_orderdate").cast("string").alias("date"))
    last, mean = recommend.rating_rows(rows, "last"), recommend.rating_rows(rows, "mean")
    return (last.join(mean.withColumnRenamed("stars", "mean"), ["userIndex", "businessIndex"])
            .select(F.col("userIndex").cast("long").alias("userIndex"), F.col("businessIndex").cast("long").alias("businessIndex"),
                    "stars", rounded("mean")))


@query
def incremental_files(t: Tables) -> DataFrame:
    source, target = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "taken")
    checkpoint = scratch_path(t.spark, "progress")

    def arrive(users: DataFrame) -> None:
        users.write.mode("append").json(source)
        for _ in range(2):  # the second call finds nothing new
            increments.ingest_new_files(t.spark, source, "user", target, checkpoint)

    arrive(t.user)
    arrive(t.user.where(number("user_id") % 3 == 0).withColumn("average_stars", F.col("average_stars") + 1))
    return increments.current_records(t.spark, target, "user_id")


@query
def incremental_bundles(t: Tables) -> DataFrame:
    source = scratch_path(t.spark, "bundles")
    entities = {"business": full_business(t.business), "review": t.review, "user": t.user}
    pattern = write_bundles(entities, 4, source)
    target, checkpoint = scratch_path(t.spark, "taken"), scratch_path(t.spark, "progress")
    for _ in range(2):
        increments.ingest_new_bundles(t.spark, pattern, target, checkpoint)
    return (increments.all_records(t.spark, f"{target}/review").groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("stars")))


@query
def table_with_increments(t: Tables) -> DataFrame:
    source, target = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "taken")
    newer = t.user.where(number("user_id") % 3 == 0).withColumn("fans", F.col("fans") + 1)
    newer.write.json(source)
    increments.ingest_new_files(t.spark, source, "user", target, scratch_path(t.spark, "progress"))
    return increments.with_increments(t.user, target, "user_id")


@query
def feature_build(t: Tables) -> DataFrame:
    hashed = tables.read_path(t.spark, _built(t).business_hashed)
    return hashed.select("business_id", "stars", "review_count", "latitude", "longitude",
                         "positive_review_count", "negative_review_count", "category",
                         F.col("categoryIndex").cast("long").alias("categoryIndex"))


@query
def business_details(t: Tables) -> DataFrame:
    wanted = recommend.flatten(_stand_in_lists(t)).select("business_id")
    return lookup.details(t.business, wanted)


# ---------------------------------------------------------------- shared inputs

def _joined_rows(t: Tables) -> DataFrame:
    return feature_plan.joined_features(t.business, ops.review_counts(t.review))


def _feature_rows(t: Tables) -> DataFrame:
    return feature_plan.business_features(t.business, ops.review_counts(t.review))


@shared
def _rating_rows(t: Tables) -> DataFrame:
    """Written once: fits and predictions go over the rows several times, each time with all reviews behind them."""
    rows, path = feature_plan.rating_features(t.business, ops.review_counts(t.review)), scratch_path(t.spark, "rating-rows")
    tables.overwrite_path(rows, path)
    return t.spark.read.schema(rows.schema).parquet(path)


@shared
def _built(t: Tables) -> feature_plan.FeatureTables:
    return feature_plan.build_features(t.business, t.review)


@shared
def _als(t: Tables) -> tuple[ALSModel, DataFrame]:
    rows = recommend.rating_rows(tables.read_path(t.spark, _built(t).review_transformed))
    train = is_train(*SPLIT)
    return recommend.fit_als(rows.where(train)), rows.where(~train)


@shared
def _als_lists(t: Tables) -> DataFrame:
    built = _built(t)
    lists = recommend.recommend_all(_als(t)[0], tables.read_path(t.spark, built.user_map),
                                    tables.read_path(t.spark, built.business_map))
    path = scratch_path(t.spark, "als-lists")
    tables.write_by_key(lists, path, "user_id")
    return tables.read_path(t.spark, path)


@shared
def _linear(t: Tables):
    rows = _rating_rows(t)
    return rating.fit_rating_model(rating.split_by_business(rows, _train_business())[0], kind="linear")


@shared
def _sets(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "category-sets")
    tables.overwrite_path(similar.category_sets(t.business), path)
    return tables.read_path(t.spark, path)


@shared
def _profiles(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "profiles")
    tables.overwrite_path(similar.profiles(_sets(t)), path)
    return tables.read_path(t.spark, path)


@shared
def _stand_in_lists(t: Tables) -> DataFrame:
    """Each user's own five best businesses in the nested form a model returns, ids resolved."""
    built = _built(t)
    user_map = tables.read_path(t.spark, built.user_map)
    business_map = tables.read_path(t.spark, built.business_map)
    ranked = recommend.top_rated(t.review).join(user_map, "user_id").join(business_map, "business_id")
    return recommend.resolve_ids(recommend.nest(ranked), user_map, business_map)


def _scored(t: Tables) -> DataFrame:
    """Reviews with the average stars of their business as a stand-in prediction."""
    means = t.review.groupBy("business_id").agg(F.avg("stars").alias("prediction"))
    return t.review.select("business_id", F.col("stars").alias("label")).join(means, "business_id")
