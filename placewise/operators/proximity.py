"""Exact nearest businesses for a table of points, planar or on the sphere, with few shuffles.

Businesses are written in blocks along a space-filling curve, each with the box around it. Points are dealt by the
same curve, so that a task's points lie together and visit the same few blocks. A point visits blocks by
rising distance of their boxes and stops at the first that is farther than its n-th business; blocks are
read one by one from the shared folder and remembered.

A metric maps a place to coordinates in which straight lines bound its distance: degrees themselves for the planar
one, and for the great-circle distance the place on the unit sphere, where the chord bounds the arc. So
the antimeridian and the poles need no care: boxes are in space and not in longitudes. The curve there runs over the
six faces of a cube around the sphere. It only decides what lies together, never the answer.

Skew: a place that many points share is searched once, and the answers of the few places that hold at least
one of ``HOT`` parts of all points are broadcast (at most ``HOT`` times n rows), so such points are not shuffled
to one task. A dense cell is many blocks. One row for each block (``BLOCK`` businesses) reaches the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.functions.columns import EARTH_KM, haversine_distance, planar_distance
from placewise.operators.nearest import candidates
from placewise.session import scratch_path, shuffle_partitions
from placewise.sources.files import read_block, remembered, write_blocks

BLOCK = 1024
HOT = 200
CURVE_BITS = 15
#: Distances between points and boxes that are held at once.
MOST_BOXES = 1 << 21
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


@dataclass(frozen=True)
class Metric:
    """How far two places are apart, and coordinates whose straight distance bounds it from below."""

    coordinates: Callable[[Column, Column], list[Column]]      # of a latitude and a longitude
    vectors: Callable[[np.ndarray, np.ndarray], np.ndarray]    # the same for arrays, a row for each place
    curve: Callable[[Column, Column], Column]
    distance: Callable[..., Column]                            # of two places
    between: Callable[..., np.ndarray]                         # the same for arrays
    straight: Callable[[np.ndarray], np.ndarray]               # the straight distance that a distance allows
    digits: int | None                                         # to which distances are compared; none: as they are


def _interleaved(a: Column, b: Column) -> Column:
    """Bits of two numbers of up to 16 bits in turn."""
    def spread(x: Column) -> Column:
        return reduce(lambda y, s: y.bitwiseOR(F.shiftleft(y, s[0])).bitwiseAND(F.lit(s[1])), _SPREAD, x.cast("long"))

    return F.shiftleft(spread(a), 1).bitwiseOR(spread(b))


def _step(x: Column, low: float, high: float) -> Column:
    last = (1 << CURVE_BITS) - 1
    return F.least(F.greatest(F.floor((x - low) / (high - low) * last), F.lit(0)), F.lit(last))


def _planar_curve(lat: Column, lon: Column) -> Column:
    return _interleaved(_step(lat, -90.0, 90.0), _step(lon, -180.0, 180.0))


def _sphere(lat: Column, lon: Column) -> list[Column]:
    a, o = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)]


def _sphere_curve(lat: Column, lon: Column) -> Column:
    """The face of a cube that a place lies under, then the place on the face."""
    xyz = _sphere(lat, lon)
    most = F.greatest(*map(F.abs, xyz))
    face = F.lit(0)
    on = [F.lit(0.0), F.lit(0.0)]
    for k, c in enumerate(xyz):
        others = [x for j, x in enumerate(xyz) if j != k]
        here = F.abs(c) == most
        face = F.when(here, F.when(c > 0, 2 * k).otherwise(2 * k + 1)).otherwise(face)
        on = [F.when(here, x / most).otherwise(y) for x, y in zip(others, on)]
    return F.shiftleft(face.cast("long"), 2 * CURVE_BITS).bitwiseOR(_interleaved(*[_step(x, -1.0, 1.0) for x in on]))


def _sphere_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, o = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)], axis=1)


def _planar_between(lat, lon, to_lat, to_lon) -> np.ndarray:
    dlat, dlon = lat - to_lat, lon - to_lon
    return np.sqrt(dlat * dlat + dlon * dlon)


def _arc_between(lat, lon, to_lat, to_lon) -> np.ndarray:
    up, across = np.sin(np.radians(to_lat - lat) / 2), np.sin(np.radians(to_lon - lon) / 2)
    part = up * up + np.cos(np.radians(lat)) * np.cos(np.radians(to_lat)) * across * across
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.clip(part, 0, 1)))


METRICS = {
    "planar": Metric(lambda lat, lon: [lat, lon], lambda lat, lon: np.stack([lat, lon], axis=1), _planar_curve,
                     planar_distance, _planar_between, lambda d: d, None),
    "haversine": Metric(_sphere, _sphere_vectors, _sphere_curve, haversine_distance, _arc_between,
                        lambda d: 2 * np.sin(np.minimum(d / (2 * EARTH_KM), np.pi / 2)), 6),
}


@dataclass(frozen=True)
class PlaceIndex:
    """Written blocks of businesses, good for any number of searches up to ``n``."""

    path: str
    n: int
    metric: str
    low: np.ndarray     # a row for each block: the box around it
    high: np.ndarray


def place_index(features: DataFrame, n: int, metric: str = "planar", path: str | None = None) -> PlaceIndex:
    """Write the businesses that can be among the ``n`` nearest of any point, and their boxes."""
    own = METRICS[metric]
    spark = features.sparkSession
    code = own.curve(F.col("latitude"), F.col("longitude")).alias("_code")
    sites = candidates(features, n).select("business_id", "latitude", "longitude", code)
    path = write_blocks(sites, [F.asc("_code"), F.asc("business_id"), F.asc("latitude"), F.asc("longitude")], BLOCK,
                        path or scratch_path(spark, "places"))
    stored = spark.read.schema("business_id string, latitude double, longitude double, block long").parquet(path)
    axes = own.coordinates(F.col("latitude"), F.col("longitude"))
    rows = stored.groupBy("block").agg(F.array(*map(F.min, axes)).alias("low"), F.array(*map(F.max, axes)).alias("high")).orderBy("block").collect()
    box = lambda side: np.array([r[side] for r in rows], dtype=np.float64).reshape(len(rows), len(axes))
    return PlaceIndex(path, n, metric, box("low"), box("high"))


def _load(path: str, number: int, metric: str) -> tuple:
    table = read_block(path, number, ["business_id", "latitude", "longitude"])
    ids = np.array(table.column("business_id").to_pylist(), dtype=object)
    lat, lon = (table.column(c).to_numpy() for c in ("latitude", "longitude"))
    return ids, lat, lon, METRICS[metric].vectors(lat, lon)


def _nearest_of(lat: float, lon: float, place: np.ndarray, gaps: np.ndarray, load, own: Metric, n: int) -> list[tuple]:
    """(distance, business_id, latitude, longitude) of one place, nearest first."""
    best: list[tuple] = []
    limit = np.inf     # straight distance beyond which nothing can be an answer
    for number in np.argsort(gaps, kind="stable"):
        if gaps[number] > limit:
            break
        ids, lats, lons, vectors = load(int(number))
        apart = vectors - place
        near = np.flatnonzero(np.einsum("ij,ij->i", apart, apart) <= limit * limit)
        if not len(near):
            continue
        distance = own.between(lats[near], lons[near], lat, lon)
        if own.digits is not None:
            distance = np.round(distance, own.digits)
        if len(near) > n:
            cut = np.partition(distance, n - 1)[n - 1]
            near, distance = near[distance <= cut], distance[distance <= cut]
        best = sorted([*best, *zip(distance.tolist(), ids[near], lats[near], lons[near])], key=lambda b: b[:2])[:n]
        if len(best) == n:
            # A little slack, so that rounding cannot drop a business at exactly the limit.
            reach = best[-1][0] + (10.0 ** -own.digits if own.digits is not None else 0)
            limit = float(own.straight(reach)) * (1 + 1e-9) + 1e-9
    return best


def _search(batches: Iterator[pa.RecordBatch], index: PlaceIndex, n: int) -> Iterator[pa.RecordBatch]:
    own = METRICS[index.metric]
    load = lambda number: remembered(index.path, number, partial(_load, metric=index.metric))
    many = max(1, MOST_BOXES // max(1, index.low.size))
    for whole in batches:
        for a in range(0, whole.num_rows, many):
            batch = whole.slice(a, many)
            lat, lon = (batch.column(c).to_numpy() for c in ("at_lat", "at_lon"))
            places = own.vectors(lat, lon)
            outside = np.maximum(np.maximum(index.low[None] - places[:, None], places[:, None] - index.high[None]), 0)
            gaps = np.sqrt((outside ** 2).sum(axis=2))
            found = [_nearest_of(lat[k], lon[k], places[k], gaps[k], load, own, n) for k in range(len(lat))]
            of = np.repeat(np.arange(len(lat)), [len(f) for f in found])
            flat = [b for f in found for b in f]
            rank = [r for f in found for r in range(1, len(f) + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lat[of]), pa.array(lon[of]), pa.array([b[1] for b in flat], pa.string()), pa.array([b[2] for b in flat], pa.float64()),
                 pa.array([b[3] for b in flat], pa.float64()), pa.array(rank, pa.int32()), batch.column("hot").take(pa.array(of))],
                names=["at_lat", "at_lon", "business_id", "latitude", "longitude", "rank", "hot"])


def search_places(index: PlaceIndex, points: DataFrame, n: int) -> DataFrame:
    """(point_id, business_id, distance, rank): the ``n`` nearest of each point, ties by business_id."""
    if not 1 <= n <= index.n:
        raise ValueError(f"the index answers 1 to {index.n} businesses, not {n}")
    own, spark = METRICS[index.metric], points.sparkSession
    usable = F.col("at_lat").isNotNull() & F.col("at_lon").isNotNull() & ~F.isnan("at_lat") & ~F.isnan("at_lon")
    # Zeros of both signs are one place, for the join as for the grouping.
    asked = (points.select("point_id", (F.col("latitude").cast("double") + 0.0).alias("at_lat"),
                           (F.col("longitude").cast("double") + 0.0).alias("at_lon")).where(usable))
    path = scratch_path(spark, "asked-places")
    asked.groupBy("at_lat", "at_lon").agg(F.count(F.lit(1)).alias("asked")).write.parquet(path)
    places = spark.read.schema("at_lat double, at_lon double, asked long").parquet(path)
    total = places.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]
    spread = (places.withColumn("hot", F.col("asked") * HOT >= F.lit(total))
              .repartitionByRange(shuffle_partitions(spark), own.curve(F.col("at_lat"), F.col("at_lon")), F.col("at_lat"), F.col("at_lon")))
    schema = "at_lat double, at_lon double, business_id string, latitude double, longitude double, rank int, hot boolean"
    path = scratch_path(spark, "place-answers")
    spread.select("at_lat", "at_lon", "hot").mapInArrow(partial(_search, index=index, n=n), schema).write.parquet(path)
    answers = spark.read.schema(schema).parquet(path)
    key, hot = ["at_lat", "at_lon"], answers.where("hot").drop("hot")   # at most HOT places
    popular = F.broadcast(places.where(F.col("asked") * HOT >= F.lit(total)).select(*key))
    rest = asked.join(popular, key, "left_anti").join(answers.where("not hot").drop("hot"), key)
    distance = own.distance(F.col("latitude"), F.col("longitude"), F.col("at_lat"), F.col("at_lon"))
    return (asked.join(F.broadcast(hot), key).unionByName(rest)
            .select("point_id", "business_id", distance.alias("distance"), "rank"))


def nearest_places(features: DataFrame, points: DataFrame, n: int = 5, metric: str = "haversine") -> DataFrame:
    """Exact ``n`` nearest businesses for every point of a table (point_id, latitude, longitude).

    ``metric`` is ``haversine`` (kilometres on the sphere; distances equal to the millimetre are ties) or
    ``planar`` (degrees). To answer several tables, build the index once and use ``search_places``.
    """
    return search_places(place_index(features, n, metric), points, n)
