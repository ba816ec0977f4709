"""What is added to stored results without building them anew: sums, factors, numbers; and boosting that stops."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from placewise.operators import indexing
from placewise.operators.business import review_counts
from placewise.plans import features, foldin, rating, recommend, statistics
from placewise.sources.tables import read_path


@pytest.fixture(scope="module")
def rows(tables):
    return features.rating_features(tables.business, review_counts(tables.review)).cache()


def test_added_sums_equal_a_full_fit(spark, rows):
    old, new = rating.split_by_business(rows)
    added = statistics.solve(statistics.together(statistics.statistics(old), statistics.statistics(new)))
    full = statistics.solve(statistics.statistics(rows))
    assert added.rows == full.rows == rows.count()
    assert np.abs(np.array(added.coefficients) - full.coefficients).max() < 1e-9 and added.intercept == pytest.approx(full.intercept, abs=1e-9)


def test_sums_give_the_librarys_linear_model(rows):
    ours = statistics.solve(statistics.statistics(rows)).predict(rows)
    theirs = rating.predict(rating.fit_rating_model(rows, kind="linear"), rows)
    both = ours.select("business_id", F.col("prediction").alias("a")).join(theirs.select("business_id", F.col("prediction").alias("b")), "business_id")
    assert both.where("abs(a - b) > 1e-6").count() == 0 and both.count() == rows.count()


def test_sums_of_odd_rows(spark):
    some = [(1.0, Vectors.dense([1.0, 0.0, 5.0])), (2.0, Vectors.sparse(3, {0: 2.0, 2: 5.0})), (4.0, Vectors.sparse(3, {0: 3.0, 2: 5.0}))]
    df = spark.createDataFrame(some, ["label", "features"])
    model = statistics.solve(statistics.statistics(df), l2=0.0)
    assert model.coefficients[1:] == (0.0, 0.0) and model.coefficients[0] == pytest.approx(1.5) and model.rows == 3
    wider = spark.createDataFrame([(3.0, Vectors.sparse(5, {4: 1.0}))], ["label", "features"])
    both = statistics.solve(statistics.together(statistics.statistics(df), statistics.statistics(wider)))
    assert len(both.coefficients) == 5 and both.predict(df).where("isnan(prediction) or prediction is null").count() == 0
    with pytest.raises(ValueError):
        statistics.solve(statistics.statistics(df.limit(0)))


def test_least_squares_is_the_best_non_negative_answer():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 20):
        for _ in range(20):
            v = rng.standard_normal((30, n))
            a, b = v.T @ v + 0.1 * np.eye(n), v.T @ rng.standard_normal(30)
            x = foldin.least_squares(a, b)
            pull = b - a @ x
            assert (x >= 0).all() and (pull <= 1e-7).all() and np.abs(pull[x > 0]).max(initial=0) < 1e-7


def test_folding_in_a_trained_user_gives_its_factors(spark, tables):
    built = features.build_features(tables.business, tables.review)
    ratings = recommend.rating_rows(read_path(spark, built.review_transformed))
    model = recommend.fit_als(ratings, rank=6, maxIter=5)
    folded = {r.id: np.array(r.features) for r in foldin.fold_in(model.itemFactors, ratings, 6).collect()}
    trained = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    assert folded.keys() == trained.keys()
    assert max(np.abs(folded[u] - trained[u]).max() for u in trained) < 2e-3
    arrived = ratings.where("userIndex < 5").withColumn("userIndex", F.col("userIndex") + 1_000_000)
    lists = {r.userIndex: [e.businessIndex for e in r.recommendations] for r in foldin.recommend_arrived(model, arrived, 4).collect()}
    known = {r.userIndex: [e.rating for e in r.recommendations] for r in recommend.recommend_users(model, 4).where("userIndex < 5").collect()}
    assert sorted(lists) == [1_000_000 + u for u in range(5)] and all(len(x) == 4 for x in lists.values()) and len(known) == 5
    assert foldin.fold_in(model.itemFactors, ratings.limit(0), 6).count() == 0


def test_sums_before_and_after_the_shuffle_give_the_same_factors(spark):
    """Users above and below ``hot``, with ratings over several Arrow batches."""
    items = spark.range(40).select(F.col("id").cast("int"), F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: (
        F.pmod(F.xxhash64("id", k), F.lit(1000)) / 1000).cast("float")).alias("features"))
    ratings = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("userIndex"),
                                       F.pmod(F.xxhash64("id"), F.lit(45)).alias("businessIndex"), (F.col("id") % 5 + 1.0).alias("stars"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = [{r.id: np.array(r.features) for r in foldin.fold_in(items, ratings, 4, hot=hot).collect()} for hot in (0, 100, 10**9)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found[0].keys() == found[1].keys() == found[2].keys() == set(range(50))
    assert all(np.abs(found[0][u] - other[u]).max() < 1e-5 for other in found[1:] for u in other)
    v = {r.id: np.array(r.features, dtype=float) for r in items.collect()}
    own = [(v[r.businessIndex], r.stars) for r in ratings.where("userIndex = 7").collect() if r.businessIndex in v]
    a = sum(np.outer(x, x) for x, _ in own) + 0.3 * len(own) * np.eye(4)
    assert np.abs(foldin.least_squares(a, sum(x * stars for x, stars in own)) - found[2][7]).max() < 1e-5


def test_users_are_folded_in_by_rounds(spark, monkeypatch):
    """A round holds the factors of its own ratings only, and all rounds together every user."""
    items = spark.range(30).select(F.col("id").cast("int"), F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: (
        F.pmod(F.xxhash64("id", k), F.lit(1000)) / 1000).cast("float")).alias("features"))
    ratings = spark.range(1000).select((F.col("id") % 60).alias("userIndex"), F.pmod(F.xxhash64("id"), F.lit(33)).alias("businessIndex"), (F.col("id") % 5 + 1.0).alias("stars"))
    whole = {r.id: np.array(r.features) for r in foldin.fold_in(items, ratings, 3).collect()}
    sizes, folded = [], foldin._folded
    monkeypatch.setattr(foldin, "ROUND", 150)
    monkeypatch.setattr(foldin, "_folded", lambda rated, *rest: sizes.append(rated.count()) or folded(rated, *rest))
    found = foldin.fold_in(items, ratings, 3, hot=16).collect()
    assert len(sizes) == 7 and sum(sizes) == 1000 and max(sizes) < 400
    assert len(found) == len(whole) == 60 and all(np.abs(whole[r.id] - r.features).max() < 1e-5 for r in found)


def test_a_grown_index_changes_no_number(spark):
    first = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "k string, n long")
    known = indexing.index_counts(first, "k", "i")
    later = spark.createDataFrame([("c", 9), ("z", 7), ("x", 7), (None, 3), ("y", 8)], "k string, n long")
    grown = indexing.grown_index(known, later, "k", "i")
    assert {tuple(r) for r in grown.collect()} == {("a", 0), ("b", 1), ("c", 2), ("y", 3), ("x", 4), ("z", 5)}
    assert {tuple(r) for r in indexing.grown_index(known.limit(0), first, "k", "i").collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert indexing.grown_index(grown, later, "k", "i").count() == 6


def test_boosting_stops_by_held_back_businesses(spark, rows):
    model = rating.fit_rating_model(rows, kind="gbt", rounds=30, depth=3).stages[0]
    assert 1 <= model.getNumTrees < 30
    few = rows.limit(3)
    assert rating.fit_rating_model(few.withColumn("business_id", F.lit("b1")), rounds=2, depth=2).stages[0].getNumTrees == 2
