"""Similar businesses over the whole feature vector: weighted Jaccard of numbers and categories.

The similarity of two non-negative vectors is the sum of their smaller values over the sum of their larger ones.
Consistent weighted sampling draws from a vector an input and a level such that two vectors draw the same with
a probability equal to their similarity. ``BANDS`` keys of ``DRAWS`` draws each find the candidates: a pair of
similarity s is missed with probability (1 - s**DRAWS)**BANDS, at 0.8 less than one in 10**9. Candidates are
then compared exactly, so no wrong pair is returned.

Vectors with the same names of categories (``NUMBER`` inputs apart) are a group. Copies of a business and businesses without
categories are alike in the square of their number and share most of their keys, so as candidates each pair would be many rows.
So groups are the candidates: a group and itself, and two groups with a key in common whose sketches allow the similarity. Their vectors are
compared as a whole, in tiles of two slices of ``SLICE`` vectors.

Draws are made in Arrow batches, for each input of a batch once (``draws`` says the same as a column); the rest is
DataFrame functions. A group meets the others that share a key, never all of them; equal vectors are one
row with their members apart, so a thousand copies of a business are no million pairs. Keys that very
many different groups share are left to the adaptive splitting of joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.functions.columns import CATEGORY_SEPARATOR, split_categories
from placewise.session import release, scratch_path, shuffle_partitions

DRAWS = 4
BANDS = 40
#: Weight of a number at the upper end of its scale; a category weighs 1. Numbers that all businesses have in common
#: in part would otherwise make any two somewhat alike, and most of them candidates.
NUMBER_WEIGHT = 1 / 3
DIGITS = 9
_VECTOR = "array<struct<input: string, weight: double>>"
_KEYED = f"profile string, vector {_VECTOR}, total double, bits bigint, heavy bigint, lightest double, named bigint, keys array<bigint>"
#: What the names of numbers begin with.
NUMBER = "#"
#: Vectors of a group that one side of a tile holds.
SLICE = 4096
#: Pairs of a tile that are compared at once: about 4 MB for each of a few arrays.
_PAIRS = 1 << 19
_TILE = ["a", "b", "at_a", "at_b"]
#: Vectors that draw at once: about 10 MB for 13 inputs each.
_BATCH = 256


def number_inputs() -> dict[str, Column]:
    """Each number of a business as a value from 0 to about 1, on scales that no data changes."""
    def share(column: str, low: float, high: float) -> Column:
        return (F.col(column).cast("double") - low) / (high - low)

    return {"stars": share("stars", 0, 5), "latitude": share("latitude", -90, 90), "longitude": share("longitude", -180, 180),
            **{c: F.log2(F.col(c).cast("double") + 1) / 16 for c in ("review_count", "positive_review_count", "negative_review_count")}}


def vectors(business: DataFrame, counts: DataFrame, pattern: str = CATEGORY_SEPARATOR, category_weight: float = 1.0) -> DataFrame:
    """(business_id, vector): the numbers and a fixed weight for each category; missing inputs weigh nothing."""
    joined = business.select("business_id", "categories", "stars", "latitude", "longitude", "review_count").join(counts, "business_id", "left")
    numbers = [F.struct(F.lit(f"{NUMBER}{n}").alias("input"), (c * NUMBER_WEIGHT).alias("weight")) for n, c in number_inputs().items()]
    names = F.array_distinct(F.coalesce(split_categories(F.col("categories"), pattern), F.array().cast("array<string>")))
    named = F.transform(names, lambda c: F.struct(c.alias("input"), F.lit(category_weight).alias("weight")))
    every = F.concat(F.array(*numbers), named)
    return joined.select("business_id", F.array_sort(F.filter(every, lambda x: x["weight"] > 0)).cast(_VECTOR).alias("vector"))


def distinct_vectors(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profile, vector) of each different vector, named by its smallest business, and (business_id, profile)."""
    path = scratch_path(known.sparkSession, "vectors")
    known.where(F.size("vector") > 0).write.parquet(path)
    stored = known.sparkSession.read.schema(known.schema).parquet(path)
    profiles = stored.groupBy("vector").agg(F.min("business_id").alias("profile")).select("profile", "vector")
    return profiles, stored.join(profiles, "vector").select("business_id", "profile")


def _uniform(name: Column, draw: Column, part: int) -> Column:
    """A number in (0, 1] fixed by an input, a draw and a part."""
    return (F.shiftrightunsigned(F.xxhash64(name, draw, F.lit(part)), 11) + 1).cast("double") / float(1 << 53)


def draws(vector: Column, n: int = DRAWS * BANDS) -> Column:
    """What a vector draws, ``n`` times: an input and a level."""
    def level(x: Column, draw: Column) -> Column:
        name, weight = x["input"], x["weight"]
        r = -F.log(_uniform(name, draw, 1) * _uniform(name, draw, 2))
        c = -F.log(_uniform(name, draw, 3) * _uniform(name, draw, 4))
        b = _uniform(name, draw, 5)
        t = F.floor(F.log(weight) / r + b)
        return F.struct((F.log(c) - r * (t - b) - r).alias("least"), name.alias("input"), t.cast("long").alias("level"))

    def one(draw: Column) -> Column:
        least = F.array_min(F.transform(vector, lambda x: level(x, draw)))
        return least.dropFields("least")

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), one)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits each, well mixed (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(names: np.ndarray, weights: np.ndarray, starts: np.ndarray, n: int = DRAWS * BANDS) -> np.ndarray:
    """``draws`` of several vectors at once, as one number for each input and level: (vector, draw).

    ``names`` are hashes of the inputs, ``starts`` the first input of each vector."""
    names, where = np.unique(names, return_inverse=True)
    seeds = _mixed(np.arange(1, 5 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(5, 1, n)
    u = ((_mixed(names[None, :, None] ^ seeds) >> np.uint64(11)) + np.uint64(1)).astype(np.float64) / float(1 << 53)
    r, c, b = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]
    level = np.floor(np.log(weights)[:, None] / r[where] + b[where])
    least = c[where] - r[where] * (level - b[where]) - r[where]
    which = _mixed(names[where][:, None] ^ _mixed(level.astype(np.int64).view(np.uint64)))
    best = np.repeat(np.minimum.reduceat(least, starts, axis=0), np.diff(np.append(starts, len(weights))), axis=0)
    return np.minimum.reduceat(np.where(least == best, which, np.uint64(2**64 - 1)), starts, axis=0)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``names`` and ``weights`` of each vector become its ``BANDS`` keys."""
    for whole in batches:
        for at in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(at, _BATCH)
            names, weights = batch.column("names"), batch.column("weights").flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(names.value_lengths().to_numpy(zero_copy_only=False))[:-1]]).astype(np.int64)
            found = drawn(names.flatten().to_numpy(zero_copy_only=False).view(np.uint64), weights, starts).reshape(-1, BANDS, DRAWS)
            keys = np.broadcast_to(_mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), found.shape[:2])
            for d in range(DRAWS):
                keys = _mixed(keys ^ found[:, :, d]) * np.uint64(0x9E3779B97F4A7C15)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64)))
            kept = [c for c in batch.schema.names if c not in ("names", "weights")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], names=[*kept, "keys"])


def _bits(vector: Column) -> Column:
    """A bit for each input, of 64."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(x["input"]), F.lit(64)).cast("int"))
    return F.aggregate(vector, F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(bit(x)))


def sketch(vector: Column) -> list[Column]:
    """What bounds a vector's similarity to others: bits of all inputs, bits of the heavy ones, the lightest of these."""
    most = F.aggregate(vector, F.lit(0.0), lambda s, x: F.greatest(s, x["weight"]))
    heavy = F.filter(vector, lambda x: x["weight"] >= most / 2)
    return [_bits(vector).alias("bits"), _bits(heavy).alias("heavy"), F.array_min(F.transform(heavy, lambda x: x["weight"])).alias("lightest")]


def lacking(own: str, other: str) -> Column:
    """No more than a vector has alone: a bit of a heavy input that the other one lacks is at least its lightest heavy input."""
    return F.bit_count(F.col(f"heavy_{own}").bitwiseAND(F.bitwise_not(f"bits_{other}"))) * F.col(f"lightest_{own}")


def most_shared(a: str, b: str) -> Column:
    """No less than two vectors share."""
    return F.least(F.col(f"total_{a}") - lacking(a, b), F.col(f"total_{b}") - lacking(b, a))


def _named(vector: Column) -> Column:
    """A number for the names of a vector's categories, whatever their weights. Different names may share a number."""
    return F.xxhash64(F.transform(F.filter(vector, lambda x: ~x["input"].startswith(NUMBER)), lambda x: x["input"]))


def _dense(inputs: np.ndarray, weights: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """(input, row): the weights of some vectors, 0 where a vector lacks an input."""
    out = np.zeros((int(inputs.max(initial=-1)) + 1, rows))
    out[inputs, owner] = weights
    return out


def alike(dense: np.ndarray, totals: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, similarity) of the pairs of rows ``a`` and ``b`` of at least about ``least``; sums run over the inputs in order."""
    found, step = [], max(1, _PAIRS // max(1, len(b)))
    for at in range(0, len(a), step):
        part = a[at:at + step]
        shared = np.zeros((len(part), len(b)))
        for column in dense:
            shared += np.minimum(column[part][:, None], column[b][None, :])
        similarity = shared / (totals[part][:, None] + totals[b][None, :] - shared)
        i, j = np.nonzero(similarity >= least)
        found.append((part[i], b[j], similarity[i, j]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _tiles(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs of rows sorted by tile; the last tile of a batch waits for the next batch."""
    held: pa.Table | None = None

    def edges(table: pa.Table) -> np.ndarray:
        """Where a row's tile is not that of the row before."""
        keys = [table.column(c).to_numpy() for c in _TILE]
        return np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cuts = edges(table)
        for start, end in zip([0, *cuts], [*cuts, table.num_rows]):
            own = table.slice(start, end - start).combine_chunks()
            right, (a, b, at_a, at_b) = own.column("right").to_numpy(), (own.column(c)[0].as_py() for c in _TILE)
            itself = a == b and at_a == at_b
            left, right = np.flatnonzero(~right), np.flatnonzero(right)
            if len(own) < 2 or not itself and not (len(left) and len(right)):
                continue
            vector, profiles = own.column("vector").combine_chunks(), own.column("profile").combine_chunks()
            owner = np.repeat(np.arange(len(own)), vector.value_lengths().to_numpy(zero_copy_only=False))
            inputs = vector.flatten()
            # Inputs in the order of their names, in which the sums run.
            _, where = np.unique(np.array(inputs.field("input").to_pylist(), dtype=object), return_inverse=True)
            dense = _dense(where.ravel(), inputs.field("weight").to_numpy(zero_copy_only=False), owner, len(own))
            i, j, similarity = alike(dense, own.column("total").to_numpy(), left, left if itself else right, least)
            if itself:
                i, j, similarity = (x[i < j] for x in (i, j, similarity))
            _, rank = np.unique(np.array(profiles.to_pylist(), dtype=object), return_inverse=True)
            swapped, different = rank[i] > rank[j], rank[i] != rank[j]
            i, j, similarity = np.where(swapped, j, i)[different], np.where(swapped, i, j)[different], similarity[different]
            for at in range(0, len(i), _PAIRS):
                part = slice(at, at + _PAIRS)
                yield pa.RecordBatch.from_arrays([profiles.take(pa.array(i[part])), profiles.take(pa.array(j[part])), pa.array(similarity[part])],
                                                 names=["profile_a", "profile_b", "similarity"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        cuts = edges(table)
        cut = int(cuts[-1]) if len(cuts) else 0
        held = table.slice(cut)
        if cut:
            yield from pairs(table.slice(0, cut))
    if held is not None:
        yield from pairs(held)


def near_groups(known: DataFrame, at_least: float) -> DataFrame:
    """(a, b) of different groups, a < b, that have vectors with a key in common whose sketches allow the similarity."""
    spark = known.sparkSession
    keys = known.select("named", "total", "bits", "heavy", "lightest", F.explode("keys").alias("key"))
    # Dealt by key once, for the groups and for the join. What all vectors of a group that have the key allow at most:
    dealt = keys.repartition(shuffle_partitions(spark), "key").groupBy("key", "named").agg(
        F.max("total").alias("total"), F.bit_or("bits").alias("bits"), F.bit_and("heavy").alias("heavy"), F.min("lightest").alias("lightest"))
    brief = ["named", "total", "bits", "heavy", "lightest"]
    shared, missing = most_shared("a", "b"), lacking("a", "b") + lacking("b", "a")
    # Two vectors are alike by shared / (shared + what each has alone), which rises with what they share.
    near = shared >= (shared + missing) * (at_least - 1e-6)
    sides = (dealt.withColumnsRenamed({c: f"{c}_{side}" for c in brief}) for side in "ab")
    return (next(sides).join(next(sides).hint("merge"), "key").where((F.col("named_a") < F.col("named_b")) & near)
            .select(F.col("named_a").alias("a"), F.col("named_b").alias("b")).distinct())


def alike_in_groups(known: DataFrame, pairs: DataFrame, at_least: float) -> DataFrame:
    """(profile_a, profile_b, similarity), before rounding, of the vectors of ``known`` (profile, vector, total, named)
    in the ``pairs`` (a, b) of different groups and within each group."""
    spark = known.sparkSession
    rows = known.where(F.col("profile").isNotNull()).select("profile", "vector", "total", "named")
    groups = rows.groupBy("named").agg(F.count(F.lit(1)).alias("n"))
    sliced = groups.select("named", F.ceil(F.col("n") / SLICE).alias("slices"), "n")
    own = sliced.where("n > 1").select(F.col("named").alias("a"), F.col("named").alias("b"), F.col("slices").alias("slices_a"), F.col("slices").alias("slices_b"))
    other = (pairs.join(sliced.select(F.col("named").alias("a"), F.col("slices").alias("slices_a")), "a")
             .join(sliced.select(F.col("named").alias("b"), F.col("slices").alias("slices_b")), "b").select("a", "b", "slices_a", "slices_b"))
    path = scratch_path(spark, "group-pairs")
    met = own.unionByName(other)
    met.write.parquet(path)  # both sides read it
    met = spark.read.schema(met.schema).parquet(path)

    def side(here: str, there: str) -> DataFrame:
        at = F.pmod(F.xxhash64("profile"), F.col(f"slices_{here}"))
        # Spark takes an explode to make no more rows, so it is not left to choose a broadcast.
        return (rows.join(met.hint("merge"), rows["named"] == met[here])
                .select("profile", "vector", "total", "a", "b", at.alias(f"at_{here}"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"slices_{there}") - 1)).alias(f"at_{there}"), F.lit(here == "b").alias("right")))

    # A slice of a group meets itself and each other one of the group once.
    left = side("a", "b").where("a <> b OR at_a <= at_b")
    right = side("b", "a").where("a <> b OR at_a < at_b")
    return (left.unionByName(right).repartition(shuffle_partitions(spark), *_TILE).sortWithinPartitions(*_TILE)
            .mapInArrow(partial(_tiles, least=at_least - 1e-6), "profile_a string, profile_b string, similarity double"))


def similar_vectors(profiles: DataFrame, at_least: float = 0.8) -> DataFrame:
    """(profile_a, profile_b, similarity) of all pairs of different vectors from ``at_least`` on, a < b."""
    spark = profiles.sparkSession
    path = scratch_path(spark, "drawn-vectors")
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x["weight"])
    # Few bytes but much work: spread by number, since sizes would leave it in one task.
    spread = profiles.where(F.size("vector") > 0).repartition(shuffle_partitions(spark), "profile")
    made = spread.select("profile", "vector", total.alias("total"), *sketch(F.col("vector")), _named(F.col("vector")).alias("named"), F.transform("vector", lambda x: F.xxhash64(x["input"])).alias("names"),
                         F.transform("vector", lambda x: x["weight"]).alias("weights")).mapInArrow(_keyed, _KEYED)
    made.write.parquet(path)  # drawn once, whatever uses it
    release(spark)
    known = spark.read.schema(made.schema).parquet(path)
    found = alike_in_groups(known, near_groups(known, at_least), at_least)
    return found.withColumn("similarity", F.round("similarity", DIGITS)).where(F.col("similarity") >= at_least)
