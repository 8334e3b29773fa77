"""Features that are one array column: bounds, scaling and assembly, place by place, in plans that don't grow with the number of features.

Moments come from one vector summary, a single partial aggregate whose buffer holds a few numbers for each place. With missing=True values may be null or NaN; then
places are counted as rows of (place, value), and what is missing is left out of the fit and stays as it is. Fitted parameters are two
arrays of numbers, each one literal.

Defined results. Rows whose array is null are left out of a fit and stay null. Arrays of different length, or missing values without missing=True, are an error.
A fit on no rows leaves values as they are.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.scale import quartiles_of


def _places(df: DataFrame, features: str) -> DataFrame:
    """i, v: a row for each value that isn't missing."""
    each = df.select(F.posexplode(F.transform(features, lambda x: x.cast("double"))).alias("i", "v"))
    return each.filter(F.col("v").isNotNull() & ~F.isnan("v"))


def moments(df: DataFrame, features: str, missing: bool = False) -> DataFrame:
    """i, n, mean, deviation (of the population), least, most: a row for each place."""
    if missing:
        v = F.col("v")
        return _places(df, features).groupBy("i").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("deviation"), F.min(v).alias("least"), F.max(v).alias("most"))
    there = df.filter(F.col(features).isNotNull()).select(array_to_vector(F.transform(features, lambda x: x.cast("double"))).alias("v"))
    # one group: a summary of no rows would be an error, no group is none
    found = there.groupBy(F.lit("all")).agg(Summarizer.metrics("count", "mean", "variance", "min", "max").summary(F.col("v")).alias("s"))
    array = lambda name: vector_to_array(F.col(f"s.{name}"))
    n = F.col("s.count")
    spread = F.transform(array("variance"), lambda x: F.sqrt(x * (n - 1) / n))
    zipped = F.arrays_zip(array("mean").alias("mean"), spread.alias("deviation"), array("min").alias("least"), array("max").alias("most"))
    return found.select(n.alias("n"), F.posexplode(zipped).alias("i", "m")).select("i", "n", "m.*")


def bounds(df: DataFrame, features: str, missing: bool = False) -> DataFrame:
    """feature (its place), least, most."""
    return moments(df, features, missing).select(F.col("i").alias("feature"), "least", "most")


def mean_bounds(found: DataFrame) -> DataFrame:
    """least, most: the means of the features' bounds, as one row. found: of bounds, or of aggregate.feature_bounds."""
    return found.agg(F.avg("least").alias("least"), F.avg("most").alias("most"))


def fit(train: DataFrame, features: str, method: str, missing: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(shift, divisor) of each place; the driver sees two numbers a place."""
    if method == "robust":
        cells = _places(train, features)
        wide = train.agg(F.max(F.size(features))).first()[0] or 0
        q = quartiles_of(cells, max(wide, 0))
        rows = [(0.0, 1.0) if x is None else (x[1], x[2] - x[0]) for x in q]
    else:
        own = {"standard": ("mean", F.col("deviation")), "minmax": ("least", F.col("most") - F.col("least"))}
        if method not in own:
            raise ValueError(f"unknown scaler: {method}")
        shift, width = own[method]
        found = moments(train, features, missing).select("i", F.col(shift).alias("a"), width.alias("b")).collect()
        at = {r["i"]: (r["a"], r["b"]) for r in found}
        rows = [at.get(i, (0.0, 1.0)) for i in range(max(at, default=-1) + 1)]
        if any(np.isnan(x) for r in rows for x in r):
            raise ValueError("missing values among the features; pass missing=True")
    shifts, widths = (np.array([r[k] for r in rows], dtype=float) for k in (0, 1))
    return shifts, np.where(widths == 0, 1.0, widths)


def scaled(features: str, shifts: np.ndarray, widths: np.ndarray) -> Column:
    """(x - shift) / width of each place; each of the two arrays is one literal."""
    if not len(shifts):
        return F.transform(features, lambda x: x.cast("double"))
    moved = F.zip_with(F.col(features), F.lit(shifts), lambda x, a: x.cast("double") - a)
    return F.zip_with(moved, F.lit(widths), lambda x, b: x / b)


def scale_features(df: DataFrame, features: str, method: str, train: Column | None = None, missing: bool = False) -> DataFrame:
    """`df` with the array scaled by `standard`, `minmax` or `robust`, fitted on the rows of `train`; a zero width divides by 1."""
    return df.withColumn(features, scaled(features, *fit(df.filter(train) if train is not None else df, features, method, missing)))


def assembled(df: DataFrame, names: list[str], keep: list[str], features: str = "features") -> DataFrame:
    """The columns to keep, and the named columns as one array, in their order: the matrix of encode.build_matrix as an array."""
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in names]).alias(features))


def feature_kinds(numerical: list[str], kinds: dict[str, str], names: list[str]) -> dict[str, int]:
    """How many features there are of each kind. kinds, names: as build_matrix takes and gives them."""
    return {"total_features": len(names), "numerical_features": len(numerical), "categorical_features": len(kinds), "encoded_features": len(names) - len(numerical)}
