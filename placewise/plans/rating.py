"""Rating regression: training, evaluation, and ranking of given businesses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.operators.lookup import rank_descending, with_ids
from placewise.operators.stats import rmse
from placewise.session import scratch_path, shared_dir

# Tree depth and most boosting rounds; L2 strength of the linear model.
TREE_DEPTH = 5
ROUNDS = 100
L2 = 1e-4

#: Tenths of the training businesses that tell when boosting stops, and the relative gain that still counts.
HELD_TENTHS = 2
LEAST_GAIN = 0.01


def split_by_business(rows: DataFrame, train: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, about 80 to 20; all rows of a business fall on one side.

    The default hashes business_id, so a business keeps its side in every run.
    """
    if train is None:
        train = F.pmod(F.xxhash64("business_id"), F.lit(10)) < 8
    return rows.where(train), rows.where(~train)


def held_back() -> Column:
    """Businesses that boosting does not train on but is stopped by; the same in every run."""
    return F.pmod(F.xxhash64("business_id", F.lit("held")), F.lit(10)) < HELD_TENTHS


def fit_rating_model(rows: DataFrame, kind: str = "gbt", rounds: int = ROUNDS, depth: int = TREE_DEPTH,
                     l2: float = L2, seed: int = 42) -> PipelineModel:
    """Fit on (business_id, label, features); ``kind`` is ``gbt`` or ``linear``.

    Boosting takes at most ``rounds`` rounds and keeps those up to the last that made the held-back businesses'
    error smaller, at every size of the data; if all or none are held back, it takes all rounds.
    """
    shared_dir(rows.sparkSession)
    if kind == "gbt":
        rows = rows.withColumn("held", held_back())
        n, held = rows.agg(F.count(F.lit(1)), F.count_if("held")).first()
        stop = {"validationIndicatorCol": "held", "validationTol": LEAST_GAIN} if 0 < held < n else {}
        trees = GBTRegressor(maxDepth=depth, maxIter=rounds, lossType="squared", seed=seed, **stop)
        return Pipeline(stages=[trees]).fit(rows.select("label", "features", "held"))
    if kind == "linear":
        stages = [StandardScaler(inputCol="features", outputCol="scaled"),
                  LinearRegression(featuresCol="scaled", regParam=l2)]
        return Pipeline(stages=stages).fit(rows.select("label", "features"))
    raise ValueError(f"unknown kind {kind!r}")


def refit(stored: DataFrame, arrived: DataFrame, **settings) -> PipelineModel:
    """Refresh a model when rows arrive: a full distributed fit over old and new rows."""
    return fit_rating_model(stored.unionByName(arrived), **settings)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows plus ``prediction``, without the model's own working columns."""
    return model.transform(rows).select(*rows.columns, "prediction")


def train_rating_model(rows: DataFrame, train: Column | None = None,
                       **settings) -> tuple[PipelineModel, DataFrame]:
    """Split by business, fit, evaluate; returns the model and a one-row held-out RMSE.

    The rows are written once, since fitting and evaluating go over them several times."""
    path = scratch_path(rows.sparkSession, "rating-rows")
    rows.write.parquet(path)
    seen, unseen = split_by_business(rows.sparkSession.read.schema(rows.schema).parquet(path), train)
    model = fit_rating_model(seen, **settings)
    return model, rmse(predict(model, unseen))


def rank_businesses(model: PipelineModel, features: DataFrame, ids: Iterable[str] | DataFrame) -> DataFrame:
    """(business_id, prediction, rank) of the given businesses, best predicted rating first."""
    scored = predict(model, with_ids(features, ids)).select("business_id", "prediction")
    return rank_descending(scored, "prediction", "business_id")
