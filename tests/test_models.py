import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from placewise.operators.business import review_counts
from placewise.plans import features, rating, recommend
from placewise.sources import runs
from placewise.sources.tables import read_path


@pytest.fixture(scope="module")
def built(tables):
    return features.build_features(tables.business, tables.review)


@pytest.fixture(scope="module")
def ratings(spark, built):
    return recommend.rating_rows(read_path(spark, built.review_transformed))


@pytest.fixture(scope="module")
def als(ratings):
    return recommend.train_als(ratings, seed=42, rank=6, maxIter=6)


@pytest.fixture(scope="module")
def maps(spark, built):
    return read_path(spark, built.user_map), read_path(spark, built.business_map)


def test_als_beats_the_spread_with_nonnegative_factors(als, ratings):
    model, quality = als
    row = quality.first()
    assert row.n > 0 and row.rmse < ratings.agg(F.stddev("stars")).first()[0]
    assert model.userFactors.select(F.min(F.array_min("features"))).first()[0] >= 0


def test_als_blocks_do_not_follow_the_number_of_businesses(spark, monkeypatch):
    """A factor goes to every block that uses it, so blocks that grow with the businesses are bytes in the square."""
    found = {}

    class Fitted(Exception):
        pass

    def fit(self, _):
        found.update(users=self.getNumUserBlocks(), items=self.getNumItemBlocks())
        raise Fitted

    monkeypatch.setattr(recommend.ALS, "fit", fit)
    ratings = spark.range(100).select("id", (F.col("id") * 10_000_000).alias("businessIndex"), F.lit(1.0).alias("stars")).withColumnRenamed("id", "userIndex")
    with pytest.raises(Fitted):
        recommend.fit_als(ratings)
    assert found == {"users": 8, "items": 8}
    monkeypatch.setattr(recommend, "RATINGS_PER_BLOCK", 9)
    with pytest.raises(Fitted):
        recommend.fit_als(ratings)
    assert found == {"users": 12, "items": 12}


def test_als_drops_what_an_iteration_was_made_from(spark, ratings, monkeypatch):
    """Shuffled factors of ten iterations are many times the ratings; a model of RDDs keeps the shuffled ratings as well."""
    intervals, fit = [], recommend.ALS.fit
    monkeypatch.setattr(recommend.ALS, "fit", lambda self, rows: intervals.append(self.getCheckpointInterval()) or fit(self, rows))
    model = recommend.fit_als(ratings, rank=3, maxIter=3)
    assert intervals == [1]
    assert model.userFactors.inputFiles() and model.itemFactors.inputFiles()
    plain = recommend.ALS(userCol="userIndex", itemCol="businessIndex", ratingCol="stars", numUserBlocks=8, numItemBlocks=8,
                          **{**recommend.EXPLICIT, "rank": 3, "maxIter": 3})
    theirs = {r.id: r.features for r in fit(plain, recommend._int_keys(ratings)).userFactors.collect()}
    ours = {r.id: r.features for r in model.userFactors.collect()}
    assert ours.keys() == theirs.keys() and all(a == pytest.approx(theirs[u], abs=1e-4) for u, a in ours.items())


def test_full_lists_are_complete_ordered_and_known(als, maps):
    lists = recommend.recommend_all(als[0], *maps, k=20).collect()
    known = {r.business_id for r in maps[1].collect()}
    assert len(lists) == als[0].userFactors.count()
    for r in lists:
        scores = [e.rating for e in r.recommendations]
        ids = [e.business_id for e in r.recommendations]
        assert len(set(ids)) == 20 and set(ids) <= known and scores == sorted(scores, reverse=True)


def test_subset_lists_equal_full_lists(als, maps):
    every = {r.userIndex: [e.rating for e in r.recommendations] for r in recommend.recommend_users(als[0], 3).collect()}
    some = recommend.recommend_users(als[0], 3, maps[0], ["u1", "u2", "ghost"]).collect()
    assert 1 <= len(some) <= 2
    assert all([e.rating for e in r.recommendations] == every[r.userIndex] for r in some)
    with pytest.raises(ValueError):
        recommend.recommend_users(als[0], 3, None, ["u1"])


def test_unknown_users_are_not_scored(spark, als):
    strangers = spark.createDataFrame([(10**6, 0, 3.0), (0, 10**6, 3.0)], "userIndex long, businessIndex long, stars double")
    assert recommend.score(als[0], strangers).count() == 0


def test_repeated_ratings_can_be_averaged(spark):
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (2, 1, 5.0)], "userIndex long, businessIndex long, stars double")
    assert recommend.rating_rows(rows).count() == 3
    means = {(r.userIndex, r.businessIndex): r.stars for r in recommend.rating_rows(rows, "mean").collect()}
    assert means == {(1, 1): 3.0, (2, 1): 5.0}
    with pytest.raises(ValueError):
        recommend.rating_rows(rows, "first")


def test_last_of_repeated_ratings(spark):
    rows = spark.createDataFrame([(1, 1, 2.0, "2020-01-01"), (1, 1, 4.0, "2019-01-01"), (2, 1, 5.0, None)],
                                 "userIndex long, businessIndex long, stars double, date string")
    assert {tuple(r) for r in recommend.rating_rows(rows, "last").collect()} == {(1, 1, 2.0), (2, 1, 5.0)}


def test_implicit_model_uses_all_ratings(ratings):
    model = recommend.fit_implicit(ratings)
    assert model.userFactors.count() == ratings.select("userIndex").distinct().count()


def test_implicit_model_on_a_sample(ratings):
    model = recommend.fit_implicit(ratings, fraction=0.2)
    assert model.rank == 10 and model.recommendForAllUsers(2).count() > 0


@pytest.mark.parametrize("kind", ["linear", "gbt"])
def test_rating_models(tables, kind):
    rows = features.rating_features(tables.business, review_counts(tables.review))
    model, quality = rating.train_rating_model(rows, kind=kind, rounds=3)
    assert quality.first().n > 0 and quality.first().rmse > 0
    scored = rating.predict(model, rows)
    assert scored.columns == [*rows.columns, "prediction"]
    ranked = rating.rank_businesses(model, rows, ["b2", "b4", "b6", "ghost"]).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1)) and len(ranked) == 3
    assert [r.prediction for r in ranked] == sorted((r.prediction for r in ranked), reverse=True)
    assert rating.rank_businesses(model, rows, []).count() == 0
    with pytest.raises(ValueError):
        rating.fit_rating_model(rows, kind="forest")


def test_leaked_label_shows_as_near_zero_error(tables):
    """The assembled table contains the label; training on it must be recognisable."""
    leaky = (features.business_features(tables.business, review_counts(tables.review))
             .select("business_id", F.col("stars").alias("label"), "features"))
    _, leaked = rating.train_rating_model(leaky, kind="linear")
    _, clean = rating.train_rating_model(features.rating_features(tables.business, review_counts(tables.review)), kind="linear")
    assert leaked.first().rmse < 0.01 < 0.3 < clean.first().rmse


def test_split_keeps_a_business_on_one_side(tables):
    rows = features.business_features(tables.business, review_counts(tables.review))
    train, test = rating.split_by_business(rows)
    assert train.join(test, "business_id", "left_semi").count() == 0
    assert train.count() + test.count() == rows.count()


def test_models_survive_storage(spark, tmp_path, als, ratings, tables):
    path = str(tmp_path / "als")
    runs.save_model(als[0], path)
    again = runs.load_model(path, ALSModel)

    def scores(model):
        return sorted((r.userIndex, r.businessIndex, r.prediction) for r in recommend.score(model, ratings).collect())

    assert scores(again) == scores(als[0])


def test_rmse_equals_evaluator(als, ratings):
    scored = recommend.score(als[0], ratings)
    ours = recommend.rmse(scored, "stars", "prediction").first().rmse
    theirs = RegressionEvaluator(metricName="rmse", labelCol="stars", predictionCol="prediction").evaluate(scored)
    assert ours == pytest.approx(theirs)


def test_run_log_names_the_latest_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    value = spark.createDataFrame([(0.5,)], "rmse double")
    for run in ("r2", "r1"):
        runs.log_metric(value, path, "als", run, "rmse")
    assert runs.latest_runs(runs.read_runs(spark, path)).collect() == [("als", "r1")]


def test_feature_build_is_repeatable(spark, built, tables):
    again = features.build_features(tables.business, tables.review)
    for name in ("business_map", "user_map", "review_transformed"):
        a, b = read_path(spark, getattr(built, name)), read_path(spark, getattr(again, name))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_trees_must_beat_the_spread(spark, tables, monkeypatch):
    """An error above that of predicting the mean does not count as within it."""
    from placewise.suite import queries
    from tests.conftest import SF_DIR

    rows = queries._rating_rows(tables)
    _, unseen = rating.split_by_business(rows, queries._train_business())
    spread = unseen.agg(F.stddev_samp("label")).first()[0]
    made = spark.createDataFrame([(35, 1.04 * spread)], "n bigint, rmse double")
    monkeypatch.setattr(queries.rating, "train_rating_model", lambda *a, **b: (None, made))
    assert queries.rating_trees(spark, SF_DIR).first().within_spread is False
