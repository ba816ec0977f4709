"""Linear rating model from stored sums: new rows are added without reading an old one.

The sums of products of all pairs of inputs (a constant, the label, the features) are all that least squares
with an L2 penalty needs, and sums of two sets of rows add up. They are computed with DataFrame functions from the
non-zero inputs of each row, partly before the shuffle, and stored as rows (i, j, value) with i <= j: place 0 is
the constant, 1 the label, 2 and on the features. The features' number bounds them, whatever the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.functions.columns import densify
from placewise.plans.rating import L2

#: Most features whose sums are brought to the driver (about 16 million numbers).
MOST_FEATURES = 4096


def statistics(rows: DataFrame) -> DataFrame:
    """(i, j, value) of rows (label, features)."""
    cell = lambda i, v: F.struct(i.cast("int").alias("i"), v.cast("double").alias("v"))
    inputs = F.transform(densify(F.col("features")), lambda v, i: cell(i + 2, v))
    every = F.concat(F.array(cell(F.lit(0), F.lit(1.0)), cell(F.lit(1), F.col("label"))), inputs)
    real = rows.select(F.filter(every, lambda c: c["v"] != 0).alias("z"))
    left = real.select("z", F.explode("z").alias("a"))
    both = left.select("a", F.explode(F.filter("z", lambda c: c["i"] >= F.col("a.i"))).alias("b"))
    return (both.groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j"))
            .agg(F.sum(F.col("a.v") * F.col("b.v")).alias("value")))


def together(*parts: DataFrame) -> DataFrame:
    """Sums of several sets of rows as those of all of them."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("i", "j").agg(F.sum("value").alias("value"))


@dataclass(frozen=True)
class Ridge:
    """A linear model: ``intercept`` plus the product of ``coefficients`` with the features."""

    coefficients: tuple[float, ...]
    intercept: float
    rows: int

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` plus ``prediction``; a feature the model has not seen counts nothing."""
        weights = F.array(*map(F.lit, self.coefficients)) if self.coefficients else F.array().cast("array<double>")
        products = F.zip_with(densify(F.col("features")), weights, lambda x, c: F.coalesce(x * c, F.lit(0.0)))
        return rows.withColumn("prediction", F.aggregate(products, F.lit(float(self.intercept)), lambda s, x: s + x))


def solve(sums: DataFrame, l2: float = L2) -> Ridge:
    """The model of least squares with an L2 penalty on standardised inputs, as the library's linear model has it."""
    last = sums.agg(F.max("j")).first()[0]
    if last is None:
        raise ValueError("no rows")
    if last - 1 > MOST_FEATURES:
        raise ValueError(f"{last - 1} features are more than {MOST_FEATURES}")
    table = sums.toPandas()
    total = np.zeros((max(last, 1) + 1,) * 2)
    total[table["i"], table["j"]] = table["value"]
    total = total + np.triu(total, 1).T
    n = total[0, 0]
    mean = total[0] / n
    spread = total / n - np.outer(mean, mean)       # covariances of all inputs
    scale = np.sqrt(np.maximum(np.diag(spread), 0))
    label, used = scale[1], np.flatnonzero(scale[2:] > 1e-12 * (1 + np.abs(mean[2:]))) + 2
    coefficients = np.zeros(len(mean) - 2)
    if label > 0 and len(used):
        like = spread[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        like[np.diag_indices(len(used))] += l2 / label
        weights = np.linalg.solve(like, spread[used, 1] / (scale[used] * label))
        coefficients[used - 2] = weights * label / scale[used]
    return Ridge(tuple(coefficients.tolist()), float(mean[1] - coefficients @ mean[2:]), int(round(n)))
