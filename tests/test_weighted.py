"""Weighted Jaccard of whole feature vectors against comparing every pair."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placewise.operators import weighted

VECTORS = "business_id string, vector array<struct<input: string, weight: double>>"


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


def table(spark, rows):
    return spark.createDataFrame([(i, sorted(v.items())) for i, v in rows.items()], VECTORS)


@pytest.mark.parametrize("at_least", [0.8, 0.9])
def test_pairs_equal_comparing_all(spark, at_least):
    rnd, rows = random.Random(3), {}
    for k in range(250):
        base = rows.get(f"b{rnd.randrange(k)}") if k and rnd.random() < 0.6 else {f"c{rnd.randrange(40)}": 1.0 for _ in range(6)} | {"#x": rnd.random()}
        new = dict(base)
        for key in list(new):
            if rnd.random() < 0.3:
                new[key] = new[key] * rnd.uniform(0.7, 1.3)
        rows[f"b{k}"] = new
    profiles, members = weighted.distinct_vectors(table(spark, rows))
    first = {tuple(sorted(v.items())): i for i, v in sorted(rows.items(), reverse=True)}
    expected = {(a, b) for a in first.values() for b in first.values() if a < b and round(jaccard(rows[a], rows[b]), 9) >= at_least}
    got = {(r.profile_a, r.profile_b): r.similarity for r in weighted.similar_vectors(profiles, at_least).collect()}
    assert got.keys() == expected and len(expected) > 20
    assert all(s == pytest.approx(jaccard(rows[a], rows[b]), abs=1e-8) for (a, b), s in got.items())
    assert {tuple(r) for r in members.collect()} == {(i, first[tuple(sorted(v.items()))]) for i, v in rows.items()}


def test_draws_agree_as_often_as_vectors_are_alike(spark):
    a, b = {"x": 1.0, "y": 0.5, "z": 2.0}, {"x": 0.5, "y": 0.5, "w": 1.0, "z": 1.5}
    rows = table(spark, {"a": a, "b": b}).select(weighted.draws(F.col("vector"), 400).alias("d")).collect()
    same = sum(x == y for x, y in zip(rows[0].d, rows[1].d)) / 400
    assert same == pytest.approx(jaccard(a, b), abs=0.08)


def test_draws_in_batches_agree_as_often_as_vectors_are_alike():
    names, weights = np.array([1, 2, 3, 1, 2, 4, 3], dtype=np.uint64), np.array([1.0, 0.5, 2.0, 0.5, 0.5, 1.0, 1.5])
    a, b = weighted.drawn(names, weights, np.array([0, 3]), 4000)
    assert (a == b).mean() == pytest.approx(2.5 / 4.5, abs=0.03)
    alone = weighted.drawn(names[3:], weights[3:], np.array([0]), 4000)[0]
    assert (alone == b).all()  # whatever else is in the batch


def test_the_bound_of_a_pair_is_above_what_it_shares(spark):
    """And far below it for most pairs, so that few candidates are compared."""
    rnd = random.Random(5)
    rows = {f"b{k}": {f"c{rnd.randrange(40)}": rnd.choice([1.0, 1.0, 0.3, 2.0]) for _ in range(7)} for k in range(60)}
    known = table(spark, rows).select("business_id", "vector", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x["weight"]).alias("total"),
                                      *weighted.sketch(F.col("vector"))).drop("vector")
    a, b = (known.withColumnsRenamed({c: f"{c}_{side}" for c in known.columns}) for side in "ab")
    found = a.crossJoin(b).where("business_id_a < business_id_b").select("business_id_a", "business_id_b", weighted.most_shared("a", "b")).collect()
    shared = [(bound, sum(min(w, rows[y].get(k, 0)) for k, w in rows[x].items()), sum(rows[x].values())) for x, y, bound in found]
    assert len(found) == 60 * 59 // 2 and all(bound >= real - 1e-9 for bound, real, _ in shared)
    assert sum(bound < 0.8 * total for bound, _, total in shared) > len(found) / 2


def test_odd_businesses(spark):
    schema = "business_id string, categories string, stars double, latitude double, longitude double, review_count long"
    business = spark.createDataFrame([("a", "X, Y", 4.0, 1.0, 2.0, 3), ("b", "X, Y", 4.0, 1.0, 2.0, 3), ("c", None, None, None, None, None),
                                      ("d", "X, X", None, -90.0, None, 0)], schema)
    counts = spark.createDataFrame([("a", 1, 2), ("b", 1, 2)], "business_id string, positive_review_count long, negative_review_count long")
    known = weighted.vectors(business, counts)
    sizes = {r.business_id: len(r.vector) for r in known.collect()}
    assert sizes == {"a": 8, "b": 8, "c": 0, "d": 1}
    profiles, members = weighted.distinct_vectors(known)
    assert {tuple(r) for r in members.collect()} == {("a", "a"), ("b", "a"), ("d", "d")}
    assert weighted.similar_vectors(profiles).count() == 0 and weighted.similar_vectors(profiles.limit(0)).count() == 0


def test_groups_of_equal_names_are_compared_in_tiles(spark, monkeypatch):
    """Many vectors with the same names: every pair once, with slices of a few rows, and none of them by keys."""
    rnd = random.Random(7)
    rows = {f"b{k}": {"c1": rnd.choice([1.0, 0.5]), "é2": 1.0, "#x": rnd.random(), **({"#y": rnd.random()} if k % 3 else {})} for k in range(90)}
    rows |= {f"n{k}": {"#x": 0.2 + rnd.random(), "#y": rnd.random()} for k in range(70)}
    rows |= {f"m{k}": {**rows[f"b{k}"], "c3": 0.1} for k in range(20)} | {"one": {"c9": 1.0}}
    monkeypatch.setattr(weighted, "SLICE", 16)
    monkeypatch.setattr(weighted, "_PAIRS", 40)
    profiles, _ = weighted.distinct_vectors(table(spark, rows))
    expected = {(a, b): jaccard(rows[a], rows[b]) for a in rows for b in rows if a < b and round(jaccard(rows[a], rows[b]), 9) >= 0.8}
    found = weighted.similar_vectors(profiles, 0.8)
    got = [(r.profile_a, r.profile_b, r.similarity) for r in found.collect()]
    assert len(got) == len({x[:2] for x in got}) and {x[:2] for x in got} == expected.keys()
    assert all(s == pytest.approx(expected[a, b], abs=1e-8) for a, b, s in got)
    within = sum(x[0][0] == y[0] for x, y in expected)
    assert within > 500 and len(expected) > within > len(expected) / 2
    # Without candidates by keys only the pairs of different groups are gone.
    monkeypatch.setattr(weighted, "_keyed", lambda batches: (b.drop_columns(["names", "weights"]).append_column(
        "keys", pa.array([[]] * b.num_rows, pa.list_(pa.int64()))) for b in batches))
    assert {x[:2] for x in weighted.similar_vectors(profiles, 0.8).collect()} == {k for k in expected if k[0][0] == k[1][0]}
