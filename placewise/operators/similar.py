"""Similar businesses by Jaccard distance of their category sets.

Businesses with the same category set are one *profile*, so copies of a popular set
never pair with each other; profiles and their members together hold every pair of
businesses. Distances are strict: a pair counts when its distance is below the limit.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, MinHashLSH
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.functions.columns import CATEGORY_SEPARATOR, split_categories
from placewise.operators.indexing import frequency_index
from placewise.session import shuffle_partitions

PIECE_ROWS = 4096


def category_sets(business: DataFrame, pattern: str = CATEGORY_SEPARATOR) -> DataFrame:
    """(business_id, slots): distinct category numbers, rarest category first.

    The most frequent category is 0. Categories are numbered by a join, however many there are.
    """
    rows = business.select("business_id",
                           F.explode(split_categories(F.col("categories"), pattern)).alias("category"))
    numbered = rows.join(frequency_index(rows, "category", "slot"), "category")
    return numbered.groupBy("business_id").agg(
        F.sort_array(F.collect_set(F.col("slot").cast("int")), asc=False).alias("slots"))


def profiles(sets: DataFrame) -> DataFrame:
    """(profile, slots, members): one row per distinct set, named by its smallest business id."""
    return sets.groupBy("slots").agg(F.min("business_id").alias("profile"),
                                     F.count(F.lit(1)).alias("members"))


def profile_members(sets: DataFrame, known: DataFrame) -> DataFrame:
    """(business_id, profile) for every business that has categories."""
    return sets.join(known.select("slots", "profile"), "slots").select("business_id", "profile")


def similar_profiles(known: DataFrame, max_distance: float) -> DataFrame:
    """Exact pairs of profiles below ``max_distance``: (profile_a, profile_b, distance).

    A pair that similar must share a category among the first few of both rarest-first
    lists, so only that prefix is joined. Popular categories sit at the end of the lists
    and mostly stay out of the join. A pair is made only at its first shared category,
    which leaves nothing to deduplicate.
    """
    _check(max_distance)
    alike = 1.0 - max_distance
    n = F.size("slots")
    prefix = F.least(n, n - F.ceil(n * alike - 1e-9).cast("int") + 1)
    entries = (known.select("profile", "slots", n.alias("n"), F.slice("slots", F.lit(1), prefix).alias("prefix"))
               .select("*", F.posexplode("prefix").alias("at", "slot")))
    n_a, n_b = F.col("n_a"), F.col("n_b")
    close_sizes = (n_a >= n_b * alike - 1e-9) & (n_b >= n_a * alike - 1e-9)
    # If this is the first shared category, only it and the rest of the lists can be shared.
    may_share = F.least(n_a - F.col("at_a"), n_b - F.col("at_b"))
    must_share = (n_a + n_b) * (alike / (1.0 + alike)) - 1e-9
    first_shared = F.array_intersect("prefix_a", "prefix_b")[0] == F.col("slot")
    enough = F.size(F.array_intersect("slots_a", "slots_b")) >= must_share
    distance = _jaccard_distance("slots_a", "slots_b")
    # Cheap integer tests first; the exact distance is left for the few that pass them.
    keep = close_sizes & (may_share >= must_share) & first_shared & enough & (distance < max_distance)
    return (_meet(entries, ["slot"], ["slots", "n", "prefix", "at"], keep)
            .select("profile_a", "profile_b", distance.alias("distance")))


def _meet(entries: DataFrame, keys: list[str], carried: list[str], keep: Column) -> DataFrame:
    """Pairs of profiles that share a key and pass ``keep``, smaller id first.

    A popular key is cut into a square of pieces: its left rows go to one row of the square
    and its right rows to one column, so a pair meets in exactly one piece and no task gets
    the whole key. Pieces keep their size as the data grows, and the keys to cut are joined
    by key, so they may be many; Spark broadcasts them only where it finds them small.
    """
    counts = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    cut = (counts.where(F.col("n") > PIECE_ROWS)
           .select(*keys, F.ceil(F.col("n") / PIECE_ROWS).cast("int").alias("cuts")))
    spread = (entries.join(cut, keys, "left")
              .withColumn("cuts", F.coalesce("cuts", F.lit(1)))
              .withColumns({"own": F.pmod(F.xxhash64("profile"), F.col("cuts")).cast("int"),
                            "all": F.sequence(F.lit(0), F.col("cuts") - 1)}))
    pieces = [*keys, "across", "down"]

    def side(mark: str, fixed: str, repeated: str) -> DataFrame:
        return (spread.select(*keys, F.col("own").alias(fixed), F.explode("all").alias(repeated),
                              *[F.col(c).alias(f"{c}_{mark}") for c in ("profile", *carried)])
                .repartition(shuffle_partitions(entries.sparkSession), *pieces))

    return (side("a", "across", "down").join(side("b", "down", "across"), pieces)
            .where((F.col("profile_a") < F.col("profile_b")) & keep))


def signatures(features: DataFrame, column: str = "features", tables: int = 5, seed: int = 42) -> DataFrame:
    """MinHash signatures of the non-zero slots of a vector column, as ``hashes``."""
    return MinHashLSH(inputCol=column, outputCol="hashes", numHashTables=tables,
                      seed=seed).fit(features).transform(features)


def profile_signatures(known: DataFrame, width: int, tables: int = 5, seed: int = 42) -> DataFrame:
    """Profiles plus ``hashes``: MinHash over a multi-hot vector of ``width`` categories."""
    hot = CountVectorizerModel.from_vocabulary([str(i) for i in range(width)], inputCol="_names",
                                               outputCol="_hot").setBinary(True)
    named = known.where(F.size("slots") > 0).withColumn("_names", F.col("slots").cast("array<string>"))
    return signatures(hot.transform(named), "_hot", tables, seed).drop("_names", "_hot")


def approx_similar_profiles(signed: DataFrame, max_distance: float, tables: int = 5) -> DataFrame:
    """Pairs that agree in at least one MinHash table, with their true distance.

    Finds a subset of ``similar_profiles``. Each pair is made in the first table in
    which it agrees.
    """
    _check(max_distance)
    marks = F.array(*[vector_to_array(F.col("hashes")[i])[0].cast("long") for i in range(tables)])
    entries = (signed.select("profile", "slots", marks.alias("marks"))
               .select("*", F.posexplode("marks").alias("table", "mark")))
    agree = F.zip_with("marks_a", "marks_b", lambda x, y: x == y)
    first_agreed = F.array_position(agree, True) == F.col("table") + 1
    distance = _jaccard_distance("slots_a", "slots_b")
    return (_meet(entries, ["table", "mark"], ["slots", "marks"], first_agreed & (distance < max_distance))
            .select("profile_a", "profile_b", distance.alias("distance")))


def _check(max_distance: float) -> None:
    """Sets that share nothing have distance 1 and never meet, so no limit above 1 can be met."""
    if not 0 < max_distance <= 1:
        raise ValueError(f"max_distance must be above 0 and at most 1, not {max_distance}")


def _jaccard_distance(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.lit(1.0) - shared / (F.size(a) + F.size(b) - shared)
