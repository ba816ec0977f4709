"""Column expressions; all of them stay inside JVM code generation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator between the categories of one business.
CATEGORY_SEPARATOR = ", "

# Fixed value: reviews with at least this many stars count as positive.
POSITIVE_FROM = 2.5

#: Mean radius of the earth in kilometres.
EARTH_KM = 6371.0088


def split_categories(categories: Column, pattern: str = CATEGORY_SEPARATOR) -> Column:
    """Category text as an array. ``pattern=r'\\s*,\\s*'`` also trims loose commas."""
    return F.split(categories, pattern)


def planar_distance(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Straight-line distance in degrees; null when any coordinate is null."""
    dlat, dlon = lat - to_lat, lon - to_lon
    return F.sqrt(dlat * dlat + dlon * dlon)


def haversine_distance(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Great-circle distance in kilometres; null when any coordinate is null."""
    up, across = F.sin(F.radians(to_lat - lat) / 2), F.sin(F.radians(to_lon - lon) / 2)
    part = up * up + F.cos(F.radians(lat)) * F.cos(F.radians(to_lat)) * across * across
    # Rounding may bring antipodes just above 1. (least() would skip nulls.)
    return F.asin(F.sqrt(F.when(part > 1, 1.0).otherwise(part))) * (2 * EARTH_KM)


def as_label(column: str) -> Column:
    """A column as a double training label; text that is no number becomes null."""
    return F.col(column).try_cast("double").alias("label")


def id_list(recommendations: str = "recommendations", field: str = "business_id") -> Column:
    """One field of every recommendation, in recommendation order."""
    return F.col(f"{recommendations}.{field}")


def densify(vector: Column) -> Column:
    """A sparse or dense ML vector as a plain array of doubles."""
    return vector_to_array(vector)


def is_train(*keys: tuple[str, int], parts: int = 10, train_parts: int = 8) -> Column:
    """Portable split: key arithmetic decides, so any engine and any run agree.

    ``keys`` are (integer column, odd multiplier) pairs.
    """
    mixed = sum((F.col(name) * F.lit(factor) for name, factor in keys[1:]),
                F.col(keys[0][0]) * F.lit(keys[0][1]))
    return F.pmod(mixed, F.lit(parts)) < train_parts
