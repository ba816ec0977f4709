import math
import random

import pytest
from pyspark.ml.feature import MinHashLSH, StringIndexer
from pyspark.sql import functions as F

from placewise import session
from placewise.functions.columns import as_label, planar_distance, split_categories
from placewise.operators import business as ops
from placewise.operators import indexing, lookup, nearest, similar, stats
from placewise.plans import features, recommend

FEATURES = "business_id string, latitude double, longitude double"
POINTS = "point_id string, latitude double, longitude double"


def brute_nearest(sites, points, n):
    out = {}
    for pid, lat, lon in points:
        if lat is None or lon is None:
            continue
        dist = {(math.sqrt((a - lat) * (a - lat) + (b - lon) * (b - lon)), i) for i, a, b in sites
                if a is not None and b is not None and not math.isnan(a)}
        out[pid] = [i for _, i in sorted(dist)[:n]]
    return out


def searched(spark, sites, points, n, **settings):
    found = nearest.nearest(spark.createDataFrame(sites, FEATURES), spark.createDataFrame(points, POINTS), n, **settings)
    out = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.point_id, []).append(r.business_id)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    sites = [(f"s{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)]
    sites += [(f"d{i}", 40.0 + rnd.gauss(0, .01), -73.0 + rnd.gauss(0, .01)) for i in range(300)]  # one dense town
    sites += [(f"h{i}", 10.5, 20.5) for i in range(400)]  # a third at one coordinate
    sites += sites[:50]  # repeated rows, as in the table with one row per category
    sites += [("edge1", 90.0, 180.0), ("edge2", -90.0, -180.0), ("far", 95.0, 200.0)]
    points = [(f"p{i}", rnd.uniform(-95, 95), rnd.uniform(-190, 190)) for i in range(60)]
    points += [(f"t{i}", 40.0 + rnd.gauss(0, .02), -73.0) for i in range(20)]
    points += [(f"same{i}", 10.5, 20.5) for i in range(60)] + [("remote", 1000.0, -1000.0), ("edge", 90.0, 180.0)]
    for n in (1, 7):
        assert searched(spark, sites, points, n) == brute_nearest(sites, points, n)


def test_nearest_few_businesses_and_bad_coordinates(spark):
    sites = [("a", 1.0, 1.0), ("b", None, 1.0), ("c", float("nan"), 1.0), ("d", 1.0, 1.0)]
    points = [("p", 1.0, 2.0), ("q", None, 2.0)]
    assert searched(spark, sites, points, 5) == {"p": ["a", "d"]}
    assert searched(spark, sites, points, 1, levels=(2, 4)) == {"p": ["a"]}
    assert searched(spark, sites[1:3], points, 5) == {}
    one = nearest.nearest_to(spark.createDataFrame(sites, FEATURES), 1.0, 2.0, 5).collect()
    assert [(r.business_id, r.distance) for r in one] == [("a", 1.0), ("d", 1.0)]
    index = nearest.location_index(spark.createDataFrame(sites, FEATURES), 1)
    with pytest.raises(ValueError):
        nearest.search(index, spark.createDataFrame(points, POINTS), 2)


def test_frequency_index_equals_string_indexer(spark):
    rnd = random.Random(3)
    ids = ["hot"] * 500 + [f"k{rnd.randint(0, 200)}" for _ in range(1000)] + [None] * 20
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    ours = {r.id: r.n for r in indexing.frequency_index(df, "id", "n").collect()}
    labels = StringIndexer(inputCol="id", outputCol="n", handleInvalid="skip").fit(df).labels
    assert ours == {label: i for i, label in enumerate(labels)}


def random_businesses(spark, count, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(count):
        chosen = rnd.sample(range(12), rnd.randint(1, 5))
        rows.append((f"b{i:04}", ", ".join(f"c{c}" for c in chosen)))
    rows += [(f"copy{i}", "c0, c1, c2") for i in range(count // 2)]  # a third are copies
    rows += [("none", None), ("twice", "c3, c3, c4")]
    return rows, spark.createDataFrame(rows, "business_id string, categories string")


def brute_pairs(rows, below):
    sets = {}
    for i, text in rows:
        if text is not None:
            sets.setdefault(frozenset(text.split(", ")), []).append(i)
    named = sorted((min(ids), s) for s, ids in sets.items())
    out = {}
    for x, (i, a) in enumerate(named):
        for j, b in named[x + 1:]:
            distance = 1 - len(a & b) / len(a | b)
            if distance < below:
                out[i, j] = round(distance, 9)
    return out


@pytest.mark.parametrize("below", [0.26, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("piece", [4096, 7])
def test_similar_pairs_equal_brute_force(spark, monkeypatch, below, piece):
    monkeypatch.setattr(similar, "PIECE_ROWS", piece)  # 7 cuts the popular categories
    rows, df = random_businesses(spark, 200, 5)
    sets = similar.category_sets(df)
    known = similar.profiles(sets)
    got = {(r.profile_a, r.profile_b): round(r.distance, 9)
           for r in similar.similar_profiles(known, below).collect()}
    assert got == brute_pairs(rows, below)
    members = similar.profile_members(sets, known)
    assert members.count() == len([1 for _, text in rows if text])
    assert known.agg(F.sum("members")).first()[0] == members.count()


def test_minhash_pairs_equal_spark_join(spark):
    _, df = random_businesses(spark, 120, 9)
    known = similar.profiles(similar.category_sets(df))
    signed = similar.profile_signatures(known, 12)
    ours = {(r.profile_a, r.profile_b): round(r.distance, 9)
            for r in similar.approx_similar_profiles(signed, 0.5).collect()}
    dense = signed.select("profile", F.transform("slots", lambda x: x.cast("string")).alias("names"))
    from pyspark.ml.feature import CountVectorizerModel
    hot = CountVectorizerModel.from_vocabulary([str(i) for i in range(12)], inputCol="names",
                                               outputCol="v").setBinary(True).transform(dense)
    model = MinHashLSH(inputCol="v", outputCol="hashes", numHashTables=5, seed=42).fit(hot)
    theirs = {(r.a, r.b): round(r.d, 9) for r in model.approxSimilarityJoin(hot, hot, 0.5, "d").select(
        F.col("datasetA.profile").alias("a"), F.col("datasetB.profile").alias("b"), "d").where("a < b").collect()}
    assert ours == theirs and ours
    exact = {(r.profile_a, r.profile_b) for r in similar.similar_profiles(known, 0.5).collect()}
    assert set(ours) <= exact


def test_category_split_is_strict_by_default(spark):
    df = spark.createDataFrame([("A, B,C,  D",)], "categories string")
    strict, loose = df.select(split_categories(F.col("categories")),
                              split_categories(F.col("categories"), r"\s*,\s*")).first()
    assert strict == ["A", "B,C", " D"] and loose == ["A", "B", "C", "D"]


def test_review_counts_ignore_missing_stars(spark):
    df = spark.createDataFrame([("b", 2.5), ("b", 2.4), ("b", None), ("c", None)], "business_id string, stars double")
    got = {r.business_id: (r.positive_review_count, r.negative_review_count) for r in ops.review_counts(df).collect()}
    assert got == {"b": (1, 1), "c": (0, 0)}


def test_label_and_distance_expressions(spark):
    df = spark.createDataFrame([("4.5", None), ("x", 1.0), (None, 4.0)], "stars string, lat double")
    zero = F.lit(0.0)
    got = df.select(as_label("stars"), planar_distance(F.col("lat"), F.lit(3.0), zero, zero).alias("d")).collect()
    assert [tuple(r) for r in got] == [(4.5, None), (None, math.sqrt(10)), (None, 5.0)]


def test_lookups_with_no_or_unknown_ids(spark, tables):
    assert lookup.details(tables.business, []).count() == 0
    assert lookup.details(tables.business, ["nobody"]).count() == 0
    assert lookup.details(tables.business, tables.business.limit(0)).count() == 0
    assert lookup.details(tables.business, ["b1", "b1", "b2"]).count() == 2
    recs = spark.createDataFrame([("u1", [("b2", 5.0), ("b1", 4.0)])],
                                 "user_id string, recommendations array<struct<business_id: string, rating: double>>")
    asked = spark.createDataFrame([("u1",), ("ghost",)], "user_id string")
    got = {r.user_id: r.business_ids for r in lookup.recommendations_for(recs, asked).collect()}
    assert got == {"u1": ["b2", "b1"], "ghost": []}


def test_point_lookup_reaches_the_scan(spark, tables, capsys):
    lookup.point_lookup(tables.raw("orders"), "o_orderpriority", "5-LOW").select("o_orderkey").explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(o_orderpriority,5-LOW)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan


def test_rank_is_gap_free_and_distinct(spark):
    rows = [(f"b{i}", float(i % 5)) for i in range(100)] * 2
    df = spark.createDataFrame(rows, "business_id string, prediction double").repartition(6)
    got = lookup.rank_descending(df, "prediction", "business_id").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 101))
    expected = sorted(set(rows), key=lambda r: (-r[1], r[0]))
    assert [(r.business_id, r.prediction) for r in got] == expected


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 1, "y")], "k string, t int, v string")
    got = {r.k: (r.t, r.v) for r in ops.latest_by_key(df, "k", [F.col("t")]).collect()}
    assert got == {"a": (2, "x"), "b": (1, "y")}


def test_resolved_lists_keep_model_order(spark):
    users = spark.createDataFrame([("u0", 0), ("u1", 1)], "user_id string, userIndex long")
    places = spark.createDataFrame([(f"b{i}", i) for i in range(50)], "business_id string, businessIndex long")
    order = list(range(50))
    random.Random(4).shuffle(order)
    lists = spark.createDataFrame([(0, [(i, 1.0) for i in order]), (1, [(i, 2.0) for i in order[:3]])],
                                  "userIndex int, recommendations array<struct<businessIndex: int, rating: float>>")
    got = {r.user_id: [e.business_id for e in r.recommendations]
           for r in recommend.resolve_ids(lists, users, places.repartition(5)).collect()}
    assert got == {"u0": [f"b{i}" for i in order], "u1": [f"b{i}" for i in order[:3]]}


def test_summary_and_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, None)], "label double, prediction double")
    row = stats.rmse(df).first()
    assert (row.n, row.rmse) == (2, math.sqrt(0.5))
    described = {r["column"]: r for r in stats.describe(df, ["label", "prediction"]).collect()}
    assert described["label"]["mean"] == 3.0 and described["prediction"]["count"] == 2.0


def test_features_of_awkward_businesses(spark):
    business = spark.createDataFrame(
        [("full", "A, B", 4.0, 10, 1.0, 2.0), ("nocat", None, 4.0, 10, 1.0, 2.0), ("noplace", "A", 4.0, 10, None, 2.0),
         ("noreview", "A", 4.0, 10, 1.0, 2.0)],
        "business_id string, categories string, stars double, review_count long, latitude double, longitude double")
    review = spark.createDataFrame([("u", b, 5.0) for b in ("full", "nocat", "noplace")],
                                   "user_id string, business_id string, stars double")
    rows = features.business_features(business, ops.review_counts(review)).collect()
    assert sorted((r.business_id, r.category, r.categoryIndex) for r in rows) == [("full", "A", 0.0), ("full", "B", 1.0)]
    one = features.rating_features(business, ops.review_counts(review)).collect()
    assert [(r.business_id, r.label, len(r.features)) for r in one] == [("full", 4.0, 7)]
    with pytest.raises(ValueError):
        features.encode_categories(features.joined_features(business, ops.review_counts(review)), features.category_index(business.limit(0)))


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")

    class Remote:
        class sparkContext:
            master = "spark://somewhere"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.shared_dir(Remote)


@pytest.mark.parametrize("limit", [0, -0.1, 1.5])
def test_limits_that_cannot_be_met_are_refused(spark, limit):
    known = spark.createDataFrame([("b1", [1, 2])], "profile string, slots array<int>")
    with pytest.raises(ValueError, match="max_distance"):
        similar.similar_profiles(known, limit)


def test_scratch_of_a_run_can_be_cleared(spark):
    other = session.scratch_path(spark, "x").replace(spark.sparkContext.applicationId, "finished-run")
    spark.range(3).write.parquet(other)
    assert session.clear_scratch(spark, "finished-run") and not session.clear_scratch(spark, "finished-run")
    with pytest.raises(Exception):
        spark.read.parquet(other)
