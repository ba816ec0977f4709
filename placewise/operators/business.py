"""Relational building blocks over business, review and user tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.functions.columns import CATEGORY_SEPARATOR, POSITIVE_FROM, split_categories


# The columns of these two projections.
def business_numerics(business: DataFrame) -> DataFrame:
    return business.select("business_id", "stars", "review_count", "latitude", "longitude")


def user_features(user: DataFrame) -> DataFrame:
    return user.select("user_id", "average_stars", "review_count", "fans", "elite")


def category_rows(business: DataFrame, pattern: str = CATEGORY_SEPARATOR) -> DataFrame:
    """One row per (business, category); a business without categories gives none."""
    return business.select("business_id",
                           F.explode(split_categories(F.col("categories"), pattern)).alias("category"))


def review_counts(review: DataFrame, positive_from: float = POSITIVE_FROM) -> DataFrame:
    """Positive and negative reviews per business; reviews without stars count as neither."""
    return review_totals(review, positive_from).drop("n")


def review_totals(review: DataFrame, positive_from: float = POSITIVE_FROM) -> DataFrame:
    """Review counts plus the number ``n`` of all reviews, from one pass over the reviews.

    Each task counts before the shuffle, so a business with a third of all reviews sends
    one row per task.
    """
    stars = F.col("stars")
    # The names of the counts.
    return review.groupBy("business_id").agg(
        F.count(F.when(stars >= positive_from, True)).alias("positive_review_count"),
        F.count(F.when(stars < positive_from, True)).alias("negative_review_count"),
        F.count(F.lit(1)).alias("n"))


def with_review_counts(business: DataFrame, review: DataFrame,
                       positive_from: float = POSITIVE_FROM) -> DataFrame:
    """Left join: a business nobody reviewed keeps null counts."""
    return business.join(review_counts(review, positive_from), "business_id", "left")


def with_categories(business: DataFrame, pattern: str = CATEGORY_SEPARATOR) -> DataFrame:
    """One row per (business, category), keeping businesses without categories.

    Equal to left-joining the category rows back on business_id, without the self
    join: the categories already sit in the row. Needs one row per business_id,
    which ingest ensures.
    """
    return (business.withColumn("category",
                                F.explode_outer(split_categories(F.col("categories"), pattern)))
            .drop("categories"))


def without_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose listed inputs are all present (neither null nor NaN)."""
    return df.dropna(how="any", subset=columns)


def latest_by_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last in ``order``; aggregates partially, so hot keys are cheap."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])
