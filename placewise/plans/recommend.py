"""Collaborative filtering: training, scoring, and lists of recommendations per user."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placewise.operators.business import latest_by_key
from placewise.operators.indexing import with_popular
from placewise.operators.lookup import with_ids
from placewise.operators.stats import rmse
from placewise.operators.topk import top_lists
from placewise.session import release, scratch_path, shared_dir

# Settings of the explicit and of the implicit model.
EXPLICIT = {"rank": 20, "maxIter": 20, "regParam": 0.3, "nonnegative": True,
            "coldStartStrategy": "drop", "seed": 42}
IMPLICIT = {"rank": 10, "maxIter": 5, "implicitPrefs": True, "nonnegative": True,
            "coldStartStrategy": "drop", "seed": 42}
LIST_LENGTH = 20

#: Ratings that one block holds at most on average, at 12 bytes each.
RATINGS_PER_BLOCK = 20_000_000


def rating_rows(indexed: DataFrame, repeats: str = "keep") -> DataFrame:
    """userIndex, businessIndex, stars. ``repeats='mean'`` folds a user's reviews of one
    business into their average, which also bounds a hot user by the number of businesses;
    ``repeats='last'`` keeps the latest by column ``date`` (ties: the higher stars)."""
    if repeats == "last":
        return latest_by_key(indexed.select("userIndex", "businessIndex", "stars", "date"), ["userIndex", "businessIndex"],
                             [F.col("date"), F.col("stars")]).drop("date")
    rows = indexed.select("userIndex", "businessIndex", "stars")
    if repeats == "keep":
        return rows
    if repeats == "mean":
        return rows.groupBy("userIndex", "businessIndex").agg(F.avg("stars").alias("stars"))
    raise ValueError(f"unknown repeats {repeats!r}")


def random_split(df: DataFrame, seed: int, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Random train and test rows; the seed is required."""
    left, right = df.randomSplit([train, 1.0 - train], seed=seed)
    return left, right


def fit_als(ratings: DataFrame, user_blocks: int | None = None, item_blocks: int | None = None,
            **settings) -> ALSModel:
    """Fit ALS on (userIndex, businessIndex, stars); defaults are those of the explicit model.

    Users and businesses are spread over ``user_blocks`` and ``item_blocks`` partitions. In each
    iteration a factor goes once to every block that uses it, so more blocks are more bytes: their number
    follows the session's parallelism, and the ratings only where a block would hold too many. A checkpoint folder is set first, and
    ALS cuts its lineage in each iteration: what the factors of an iteration were made from stays on disk until then, which is many
    times the ratings after Spark's usual ten. The model is stored and read again, since its factors would keep
    the shuffled ratings. Spark's ALS gathers the ratings of one id in one task, at 12
    bytes each; fold the repeats of hotter ids with ``rating_rows(..., repeats='mean')``.
    """
    spark = ratings.sparkSession
    shared_dir(spark)
    release(spark)
    if user_blocks is None or item_blocks is None:
        least = math.ceil(ratings.count() / RATINGS_PER_BLOCK)
        user_blocks = user_blocks or max(8, spark.sparkContext.defaultParallelism, least)
        item_blocks = item_blocks or max(min(user_blocks, 8), least)
    als = ALS(userCol="userIndex", itemCol="businessIndex", ratingCol="stars",
              numUserBlocks=user_blocks, numItemBlocks=item_blocks, **{"checkpointInterval": 1, **EXPLICIT, **settings})
    path = scratch_path(spark, "als-model")
    als.fit(_int_keys(ratings)).save(path)
    release(spark)
    return ALSModel.load(path)


def fit_implicit(ratings: DataFrame, fraction: float | None = None, seed: int = 42,
                 **settings) -> ALSModel:
    """Implicit-preference ALS on all ratings, or on a sample if a ``fraction`` is asked for."""
    rows = ratings if fraction is None else ratings.sample(False, fraction, seed)
    return fit_als(rows, **{**IMPLICIT, **settings})


def score(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """Ratings plus ``prediction``; users or businesses unknown to the model drop out."""
    return model.transform(_int_keys(ratings))


def train_als(ratings: DataFrame, seed: int = 42, **settings) -> tuple[ALSModel, DataFrame]:
    """Split, fit and evaluate; returns the model and a one-row RMSE on the held-out rows."""
    train, test = random_split(ratings, seed)
    model = fit_als(train, **{"seed": seed, **settings})
    return model, rmse(score(model, test), "stars", "prediction")


def recommend_users(model: ALSModel, n: int = 5, user_map: DataFrame | None = None,
                    users: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Top ``n`` for the given user ids, or for all users, as (userIndex, recommendations).

    Equal ratings are ordered by index; items that cannot be among the best are not scored."""
    factors = model.userFactors
    if users is not None:
        if user_map is None:
            raise ValueError("user_map is needed to resolve user ids")
        chosen = with_ids(user_map, users, "user_id").select(F.col("userIndex").cast("int").alias("id"))
        factors = factors.join(chosen, "id", "left_semi")
    return top_lists(factors, model.itemFactors, n).drop("scored")


def resolve_ids(recommended: DataFrame, user_map: DataFrame, business_map: DataFrame) -> DataFrame:
    """Replace indexes by ids: (userIndex, recommendations, user_id), lists in rank order.

    The rank travels with each entry, because a join and regrouping alone lose the order.
    """
    # ALS indexes are 32-bit; maps of the same type let the last join reuse the grouping's shuffle.
    user_map = user_map.withColumn("userIndex", F.col("userIndex").cast("int"))
    business_map = business_map.withColumn("businessIndex", F.col("businessIndex").cast("int"))
    flat = recommended.select("userIndex", F.posexplode("recommendations").alias("rank", "entry"))
    # A popular business stands in many lists; its index is small, as the most reviewed come first.
    named = (with_popular(flat.withColumn("businessIndex", F.col("entry.businessIndex")), business_map, "businessIndex",
                          F.col("businessIndex"))
             .select("userIndex", "rank", F.struct("businessIndex", "business_id",
                                                   F.col("entry.rating").alias("rating")).alias("entry")))
    lists = named.groupBy("userIndex").agg(
        F.array_sort(F.collect_list(F.struct("rank", "entry"))).alias("ranked"))
    return (lists.select("userIndex", F.col("ranked.entry").alias("recommendations"))
            .join(user_map, "userIndex")
            .select("userIndex", "recommendations", "user_id"))


def recommend_all(model: ALSModel, user_map: DataFrame, business_map: DataFrame,
                  k: int = LIST_LENGTH) -> DataFrame:
    """Top ``k`` for every user of the model, with original ids, ready to store by user_id."""
    spark, path = user_map.sparkSession, scratch_path(user_map.sparkSession, "lists")
    recommend_users(model, k).write.parquet(path)  # popular and other businesses are named apart, which would search twice
    release(spark)
    return resolve_ids(spark.read.parquet(path), user_map, business_map)


def flatten(recs: DataFrame) -> DataFrame:
    """(user_id, rank, business_id, rating), one row per recommendation."""
    return (recs.select("user_id", F.posexplode("recommendations").alias("pos", "entry"))
            .select("user_id", (F.col("pos") + 1).alias("rank"), "entry.business_id", "entry.rating"))


def nest(ranked: DataFrame, rank: str = "rk") -> DataFrame:
    """Rows (userIndex, businessIndex, rating, rank) as the nested lists a model returns."""
    entry = F.struct(F.col(rank).alias("rank"), F.col("businessIndex").cast("int").alias("businessIndex"),
                     F.col("rating").cast("float").alias("rating"))
    return (ranked.groupBy(F.col("userIndex").cast("int").alias("userIndex")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
            .select("userIndex", F.transform("e", lambda e: F.struct(
                e["businessIndex"].alias("businessIndex"), e["rating"].alias("rating"))).alias("recommendations")))


def top_rated(ratings: DataFrame, k: int = 5) -> DataFrame:
    """Each user's ``k`` best businesses by own average stars: (user_id, business_id, rating, rk)."""
    means = ratings.groupBy("user_id", "business_id").agg(F.avg("stars").alias("rating"))
    best = Window.partitionBy("user_id").orderBy(F.desc("rating"), F.asc("business_id"))
    return means.withColumn("rk", F.row_number().over(best)).where(F.col("rk") <= k)


def _int_keys(ratings: DataFrame) -> DataFrame:
    """ALS takes 32-bit keys; a larger index fails here instead of wrapping around."""
    return ratings.withColumns({"userIndex": F.col("userIndex").cast("int"),
                                "businessIndex": F.col("businessIndex").cast("int")})
