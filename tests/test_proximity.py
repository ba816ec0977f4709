"""Nearest businesses on the sphere and in degrees, against comparing every pair."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placewise.functions.columns import EARTH_KM, haversine_distance
from placewise.operators import proximity

SITES = "business_id string, latitude double, longitude double"
POINTS = "point_id string, latitude double, longitude double"


def arc(a, b, c, d):
    up, across = math.sin(math.radians(c - a) / 2), math.sin(math.radians(d - b) / 2)
    part = up * up + math.cos(math.radians(a)) * math.cos(math.radians(c)) * across * across
    return 2 * EARTH_KM * math.asin(math.sqrt(min(1.0, part)))


def straight(a, b, c, d):
    return math.sqrt((a - c) * (a - c) + (b - d) * (b - d))


def brute(sites, points, n, metric):
    out = {}
    for pid, lat, lon in points:
        if lat is None or lon is None or math.isnan(lat):
            continue
        far = {((round(arc(a, b, lat, lon), 6) if metric == "haversine" else straight(a, b, lat, lon)), i, a, b)
               for i, a, b in sites if a is not None and b is not None and not math.isnan(a)}
        out[pid] = [i for _, i, _, _ in sorted(far)[:n]]
    return out


def searched(spark, sites, points, n, metric):
    found = proximity.nearest_places(spark.createDataFrame(sites, SITES), spark.createDataFrame(points, POINTS).repartition(3), n, metric)
    out = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.point_id, []).append(r.business_id)
    return out


@pytest.mark.parametrize("metric", ["haversine", "planar"])
@pytest.mark.parametrize("block,hot", [(16, 200), (200, 3)])
def test_equals_every_pair(spark, monkeypatch, metric, block, hot):
    monkeypatch.setattr(proximity, "BLOCK", block)
    monkeypatch.setattr(proximity, "HOT", hot)
    rnd = random.Random(block)
    sites = [(f"s{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(400)]
    sites += [(f"c{i}", 40 + rnd.gauss(0, 0.1), -74 + rnd.gauss(0, 0.1)) for i in range(200)]      # a city
    sites += [(f"d{i}", 1.25, 2.5) for i in range(30)] + [("n", None, 1.0), ("m", float("nan"), 1.0)]
    sites += [(f"e{i}", rnd.uniform(-80, 80), rnd.choice([-180.0, 180.0, 179.99, -179.99])) for i in range(40)]
    sites += [(f"p{i}", rnd.choice([90.0, -90.0, 89.9]), rnd.uniform(-180, 180)) for i in range(20)]
    points = [(f"q{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(60)]
    points += [(f"h{i}", 40.7, -74.0) for i in range(50)] + [("x", None, 0.0), ("y", float("nan"), 0.0)]
    points += [("w", 10.0, 180.0), ("v", 10.0, -180.0), ("top", 90.0, 12.0), ("low", -90.0, 0.0), ("z", 0.0, -0.0), ("z2", -0.0, 0.0)]
    assert searched(spark, sites, points, 7, metric) == brute(sites, points, 7, metric)


def test_distance_column(spark):
    rows = [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 5.0), (10.0, 179.5, 10.0, -179.5), (40.0, -74.0, 40.0, -74.0), (1.0, None, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_distance(*map(F.col, "abcd"))).collect()]
    assert got[0] == pytest.approx(math.pi * EARTH_KM) and got[1] == pytest.approx(math.pi * EARTH_KM)
    assert got[2] == pytest.approx(arc(*rows[2])) and got[2] < 110 and got[3] == 0 and got[4] is None


def test_few_businesses_and_empty_tables(spark):
    none, point = spark.createDataFrame([], SITES), spark.createDataFrame([("p", 1.0, 2.0)], POINTS)
    assert proximity.nearest_places(none, point, 3).count() == 0
    assert proximity.nearest_places(spark.createDataFrame([("s", 1.0, 2.0)], SITES), spark.createDataFrame([], POINTS), 3).count() == 0
    one = proximity.nearest_places(spark.createDataFrame([("s", 1.0, 2.0)], SITES), point, 3).collect()
    assert [tuple(r) for r in one] == [("p", "s", 0.0, 1)]
    index = proximity.place_index(none, 2)
    with pytest.raises(ValueError):
        proximity.search_places(index, point, 3)


def test_points_of_a_popular_place_are_not_shuffled(spark, monkeypatch):
    """A third of all points at one place: after the search no task has much more than its share."""
    monkeypatch.setattr(proximity, "HOT", 20)
    sites = spark.range(500).select(F.concat(F.lit("s"), "id").alias("business_id"), (F.col("id") % 170 - 85.0).alias("latitude"),
                                    (F.col("id") * 7 % 360 - 180.0).alias("longitude"))
    points = spark.range(30_000).select(F.concat(F.lit("p"), "id").alias("point_id"),
                                        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 1700 / 10.0 - 85).alias("latitude"),
                                        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 3599 / 10.0 - 180).alias("longitude"))
    found = proximity.nearest_places(sites, points.repartition(8), 2)
    rows = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == 60_000 and max(r["count"] for r in rows) < 60_000 / 3
    text = found._jdf.queryExecution().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text
