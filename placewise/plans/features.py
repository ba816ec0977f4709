"""Business feature tables and numbered reviews."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.functions.columns import CATEGORY_SEPARATOR, POSITIVE_FROM, split_categories
from placewise.operators.business import (category_rows, review_totals, with_categories,
                                          without_missing)
from placewise.operators.indexing import frequency_index, index_counts, index_reviews
from placewise.operators.nearest import located
from placewise.operators.similar import signatures
from placewise.session import release, scratch_path, shuffle_partitions
from placewise.sources.tables import delete_path, overwrite_path, read_path, write_by_key

# Numeric inputs in slot order; the category slots follow.
NUMERIC_INPUTS = ["stars", "review_count", "latitude", "longitude",
                  "positive_review_count", "negative_review_count"]
LABEL = "stars"


def joined_features(business: DataFrame, counts: DataFrame, pattern: str = CATEGORY_SEPARATOR) -> DataFrame:
    """Numerics, review counts and one row per category; businesses without any stay.

    Categories multiply the rows and each row gets a vector, so the few bytes of a
    business stand for much work: they are spread by number of partitions.
    """
    numeric = (business.select("business_id", "stars", "review_count", "latitude", "longitude", "categories")
               .repartition(shuffle_partitions(business.sparkSession), "business_id"))
    return with_categories(numeric.join(counts, "business_id", "left"), pattern)


def category_index(business: DataFrame, pattern: str = CATEGORY_SEPARATOR) -> DataFrame:
    """(category, categoryIndex), the most frequent category first; nothing passes through the driver."""
    return frequency_index(category_rows(business, pattern), "category", "categoryIndex")


def encode_categories(joined: DataFrame, index: DataFrame) -> DataFrame:
    """categoryIndex and one-hot categoryVec; rows without a known category drop out.

    The encoder is fitted on the index range, which is all it needs to know.
    """
    known = index.count()
    if not known:
        raise ValueError("no categories to encode")
    index = index.withColumn("categoryIndex", F.col("categoryIndex").cast("double"))
    span = joined.sparkSession.range(known).select(F.col("id").cast("double").alias("categoryIndex"))
    encoder = OneHotEncoder(inputCol="categoryIndex", outputCol="categoryVec").fit(span)
    return encoder.transform(joined.join(index, "category").select(*joined.columns, "categoryIndex"))


def assemble(encoded: DataFrame, inputs: list[str], output: str = "features") -> DataFrame:
    """One vector per row; rows with a missing input drop out."""
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="skip").transform(encoded)


def business_features(business: DataFrame, counts: DataFrame, pattern: str = CATEGORY_SEPARATOR) -> DataFrame:
    """The feature table: one row per (business, category) with its assembled vector.

    ``counts`` are the review counts per business.
    """
    encoded = encode_categories(joined_features(business, counts, pattern), category_index(business, pattern))
    return assemble(encoded, [*NUMERIC_INPUTS, "categoryVec"])


def rating_features(business: DataFrame, counts: DataFrame, pattern: str = CATEGORY_SEPARATOR) -> DataFrame:
    """One row per business for rating models: categories multi-hot, the label left out."""
    index = category_index(business, pattern)
    numbered = (category_rows(business, pattern).join(index, "category").groupBy("business_id")
                .agg(F.collect_set(F.col("categoryIndex").cast("string")).alias("names")))
    counted = (business.select("business_id", "stars", "review_count", "latitude", "longitude")
               .join(counts, "business_id", "left").join(numbered, "business_id", "left"))
    complete = without_missing(counted, [*NUMERIC_INPUTS, "names"])
    # The vector needs the number of categories only; their numbers are its slots.
    slots = [str(i) for i in range(index.count())]
    multi_hot = CountVectorizerModel.from_vocabulary(slots, inputCol="names",
                                                     outputCol="categoryVec").setBinary(True)
    inputs = [c for c in NUMERIC_INPUTS if c != LABEL]
    return (assemble(multi_hot.transform(complete), [*inputs, "categoryVec"])
            .select("business_id", F.col(LABEL).cast("double").alias("label"), "features"))


@dataclass(frozen=True)
class FeatureTables:
    """Paths of everything one feature build wrote; maps, ratings and models share its run."""

    business: str
    review_counts: str
    business_hashed: str
    review_transformed: str
    user_map: str
    business_map: str
    locations: str


def build_features(business: DataFrame, review: DataFrame, base: str | None = None,
                   positive_from: float = POSITIVE_FROM, tables: int = 5, seed: int = 42) -> FeatureTables:
    """Write the business table, hashed features, locations, numbered reviews and both id maps under ``base``.

    Each table is computed once and written; later tables start from written ones.
    """
    spark = business.sparkSession
    base = base or scratch_path(spark, "features")
    names = ("business", "review_counts", "business_hashed", "review_transformed", "user_map", "business_map", "locations")
    out = FeatureTables(*[f"{base}/{name}" for name in names])
    write_by_key(business, out.business, "business_id")
    business = read_path(spark, out.business)
    # The reviews are used three times, with whatever join made them.
    overwrite_path(review, f"{base}/review")
    review = read_path(spark, f"{base}/review")
    # One pass over the reviews serves both the sentiment features and the business index.
    overwrite_path(review_totals(review, positive_from), out.review_counts)
    totals = read_path(spark, out.review_counts)
    hashed = signatures(business_features(business, totals.drop("n")), tables=tables, seed=seed)
    overwrite_path(hashed, out.business_hashed)
    # The hashed table repeats a business for each category; lookups by place need it once.
    overwrite_path(located(read_path(spark, out.business_hashed)), out.locations)

    overwrite_path(index_counts(totals, "business_id", "businessIndex"), out.business_map)
    # Users are counted on the reviews left once those without a business are gone.
    rated = review.where(F.col("business_id").isNotNull())
    overwrite_path(frequency_index(rated, "user_id", "userIndex"), out.user_map)
    indexed = index_reviews(review, read_path(spark, out.user_map), read_path(spark, out.business_map))
    overwrite_path(indexed, out.review_transformed)
    delete_path(spark, f"{base}/review")
    release(spark)
    return out
