"""Nearest businesses to one point or to a table of points, in planar degrees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewise.functions.columns import planar_distance
from placewise.session import scratch_path, shuffle_partitions

# Grid depths, coarse to fine: a cell at depth d is 360 / 2**d degrees wide, the finest 150 m.
LEVELS = (3, 5, 7, 9, 12, 15, 18)
# Down to this depth a grid has at most 2**9 * 2**8 = 131,072 cells, some 13 MB.
BROADCAST_DEPTH = 9

_PLACE = ["place", "at_lat", "at_lon"]
_SITES = "business_id STRING, latitude DOUBLE, longitude DOUBLE, cx BIGINT, cy BIGINT"
_CELLS = ("cx BIGINT, cy BIGINT, held BIGINT, south DOUBLE, north DOUBLE, west DOUBLE, east DOUBLE, "
          "depth INT")


def usable_locations(features: DataFrame) -> DataFrame:
    """(business_id, latitude, longitude) rows whose coordinates are present and numbers."""
    usable = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    real = ~F.isnan("latitude") & ~F.isnan("longitude")
    return features.select("business_id", "latitude", "longitude").where(usable & real)


def located(features: DataFrame) -> DataFrame:
    """One row per business and location; the feature table repeats them per category."""
    return usable_locations(features).distinct()


def nearest_to(features: DataFrame, latitude: float, longitude: float, n: int = 5, repeated: bool = True) -> DataFrame:
    """The ``n`` businesses closest to one point, nearest first, ties by id.

    Sort plus limit runs as a per-partition top-n followed by a merge of the tops. A table with one row for each
    business (``FeatureTables.locations``) is said not to be ``repeated``; then nothing else is shuffled.
    """
    distance = planar_distance(F.col("latitude"), F.col("longitude"),
                               F.lit(float(latitude)), F.lit(float(longitude)))
    rows = located(features) if repeated else usable_locations(features)
    return (rows.withColumn("distance", distance)
            .orderBy("distance", "business_id").limit(n)
            .select("business_id", "distance"))


@dataclass(frozen=True)
class LocationIndex:
    """A written grid over the businesses, good for any number of searches up to ``n``."""

    path: str
    n: int
    levels: tuple[int, ...]


def location_index(features: DataFrame, n: int, path: str | None = None,
                   levels: Sequence[int] = LEVELS) -> LocationIndex:
    """Write candidate businesses by finest cell and, per depth, the occupied cells.

    A cell holds its number of businesses and the box around them.
    """
    spark = features.sparkSession
    path = path or scratch_path(spark, "locations")
    finest = levels[-1]
    (candidates(features, n).withColumns(_cell(finest))
     .write.mode("overwrite").parquet(f"{path}/sites"))
    cells = spark.read.schema(_SITES).parquet(f"{path}/sites").groupBy("cx", "cy").agg(
        F.count(F.lit(1)).alias("held"),
        F.min("latitude").alias("south"), F.max("latitude").alias("north"),
        F.min("longitude").alias("west"), F.max("longitude").alias("east"))
    coarser = (cells.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in levels])))
               .withColumns({"cx": F.expr(f"shiftright(cx, {finest} - depth)"),
                             "cy": F.expr(f"shiftright(cy, {finest} - depth)")}))
    (coarser.groupBy("depth", "cx", "cy").agg(
        F.sum("held").alias("held"),
        F.min("south").alias("south"), F.max("north").alias("north"),
        F.min("west").alias("west"), F.max("east").alias("east"))
     .write.mode("overwrite").partitionBy("depth").parquet(f"{path}/cells"))
    return LocationIndex(path, n, tuple(levels))


def nearest(features: DataFrame, points: DataFrame, n: int = 5,
            levels: Sequence[int] = LEVELS) -> DataFrame:
    """Exact ``n`` nearest businesses for every point of a table.

    ``points`` has (point_id, latitude, longitude). Result: (point_id, business_id,
    distance, rank). To answer several tables, build the index once and use ``search``.
    """
    return search(location_index(features, n, levels=levels), points, n)


def search(index: LocationIndex, points: DataFrame, n: int) -> DataFrame:
    """Exact ``n`` nearest businesses per point, without a cross join.

    The search descends the grid. At each depth a point keeps the cells that may still
    hold one of its n nearest: those no farther than the distance within which other
    cells already guarantee n businesses. Only the surviving finest cells are joined
    with businesses, so the work follows the answers and not points x businesses.
    """
    if n > index.n:
        raise ValueError(f"the index answers up to {index.n} businesses, not {n}")
    spark = points.sparkSession
    cells = spark.read.schema(_CELLS).parquet(f"{index.path}/cells")
    sites = spark.read.schema(_SITES).parquet(f"{index.path}/sites")
    # A popular place may be asked for by a third of all points: search it once. The
    # search multiplies the rows of a place, so places are spread by number, not by bytes.
    places = (points.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
              .select(F.col("latitude").alias("at_lat"), F.col("longitude").alias("at_lon"))
              .distinct().withColumn("place", F.xxhash64("at_lat", "at_lon"))
              .repartition(shuffle_partitions(spark), "place"))

    def grid(depth: int) -> DataFrame:
        return cells.where(F.col("depth") == depth).drop("depth")

    found = _still_possible(_start(places, grid(index.levels[0])), n)
    for above, depth in zip(index.levels, index.levels[1:]):
        below = grid(depth).selectExpr("*", f"shiftright(cx, {depth - above}) AS px",
                                       f"shiftright(cy, {depth - above}) AS py")
        if depth <= BROADCAST_DEPTH:
            below = F.broadcast(below)
        parents = found.withColumnsRenamed({"cx": "px", "cy": "py"})
        found = _still_possible(parents.join(below, ["px", "py"]).drop("px", "py"), n)

    distance = planar_distance(F.col("latitude"), F.col("longitude"), F.col("at_lat"), F.col("at_lon"))
    # A rank with a limit: each task keeps at most n rows per place before the shuffle.
    best = Window.partitionBy(*_PLACE).orderBy("distance", "business_id")
    answers = (found.join(sites, ["cx", "cy"])
               .select(*_PLACE, "business_id", "reach", distance.alias("distance"))
               .where(F.col("distance") <= F.col("reach"))
               .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n))
    return (points.select("point_id", F.col("latitude").alias("at_lat"), F.col("longitude").alias("at_lon"))
            .join(answers, ["at_lat", "at_lon"])
            .select("point_id", "business_id", "distance", "rank"))


def candidates(features: DataFrame, n: int) -> DataFrame:
    """Businesses that can be among the n nearest of any point.

    Businesses at one coordinate tie for every point and ties go to the smallest ids,
    so past the n smallest ids of a coordinate none can be an answer. The ranking also
    drops most repeats of a business (one row per category) before the shuffle.
    """
    here = Window.partitionBy("latitude", "longitude").orderBy("business_id")
    return (usable_locations(features).withColumn("_place", F.dense_rank().over(here))
            .where(F.col("_place") <= n).drop("_place").distinct())


def _cell(depth: int) -> dict[str, Column]:
    """Cell numbers of a location; anything off the map counts to the border cells."""
    per_degree, last = float(1 << depth) / 360.0, float((1 << depth) - 1)

    def step(degrees: Column, limit: float) -> Column:
        return F.floor(F.least(F.greatest(degrees * per_degree, F.lit(0.0)), F.lit(limit)))

    return {"cx": step(F.col("longitude") + 180.0, last),
            "cy": step(F.col("latitude") + 90.0, (last + 1) / 2 - 1)}


def _start(places: DataFrame, grid: DataFrame) -> DataFrame:
    """Every place with every occupied cell of the coarsest grid, a list of a few dozen."""
    cells = grid.agg(F.collect_list(F.struct(*grid.columns)).alias("cells"))
    return (places.withColumn("_cell", F.explode(cells.scalar()))
            .select(*_PLACE, F.lit(float("inf")).alias("reach"), "_cell.*"))


def _still_possible(found: DataFrame, n: int) -> DataFrame:
    """Drop the cells beyond ``reach``, the distance at which n businesses are certain.

    The reach of the depth above applies first and spares most cells the ranking.
    """
    place = "PARTITION BY place, at_lat, at_lon"
    # A little slack, so that rounding cannot drop a business at exactly the limit.
    certain = f"min(CASE WHEN so_far >= {int(n)} THEN farthest END) OVER ({place})"
    reach = f"coalesce({certain}, double('inf')) * 1.000000001D + 0.000000001D"
    return (found
            .selectExpr("*", "greatest(south - at_lat, at_lat - north, 0D) AS gap_lat",
                        "greatest(west - at_lon, at_lon - east, 0D) AS gap_lon",
                        "greatest(abs(at_lat - south), abs(at_lat - north)) AS far_lat",
                        "greatest(abs(at_lon - west), abs(at_lon - east)) AS far_lon")
            .selectExpr(*_PLACE, "reach", "cx", "cy", "held",
                        "sqrt(gap_lat * gap_lat + gap_lon * gap_lon) AS closest",
                        "sqrt(far_lat * far_lat + far_lon * far_lon) AS farthest")
            .where("closest <= reach")
            .selectExpr("*", f"sum(held) OVER ({place} ORDER BY farthest, cx, cy ROWS UNBOUNDED PRECEDING) AS so_far")
            .selectExpr(*_PLACE, "cx", "cy", "closest", f"{reach} AS reach")
            .where("closest <= reach").drop("closest"))
