"""Scaling, fitted on the training rows and applied to all."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.rank import running_sums
from tributary.plans.lineage import saved


QUARTILES = (0.25, 0.5, 0.75)


#: Accuracy of the quantile sketch, and rows of counts that the driver adds up; more are summed up by range.
ACCURACY, COLLECTED = 10_000, 100_000
#: Fewer values than this are counted one by one.
WHOLE = 10_000


def quartiles(df: DataFrame, columns: list[str]) -> list[list[float] | None]:
    """The exact quartiles of each column, between neighbours by linear interpolation; None for a column without values."""
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])))
    return quartiles_of(stacked.filter("v IS NOT NULL"), len(columns))


def quartiles_of(cells: DataFrame, places: int) -> list[list[float] | None]:
    """The exact quartiles of v for each i below `places`.

    A sketch brackets each quartile between two values, whose ranks are certain to lie on either side of it. In a second pass what lies in a bracket is counted by value, and what
    lies between brackets by bracket only, so few of the values are exchanged, however many there are.
    """
    margin = 10 / ACCURACY  # from WHOLE values on, ten ranks and more, of which the sketch may miss one
    asked = [x for q in QUARTILES for x in (max(0.0, q - margin), min(1.0, q + margin))]
    sketched = {r["i"]: (r["n"], r["p"]) for r in cells.groupBy("i").agg(F.count("*").alias("n"), F.percentile_approx("v", asked, ACCURACY).alias("p")).collect()}
    if not sketched:
        return [None] * places
    every = [float("-inf"), float("inf")] * len(QUARTILES)
    brackets = cells.sparkSession.createDataFrame([(i, p if n >= WHOLE else every) for i, (n, p) in sketched.items()], "i int, p array<double>")
    v, p = F.col("v"), F.col("p")
    inside = F.exists(F.sequence(F.lit(0), F.lit(len(asked) - 2), F.lit(2)), lambda k: (v >= F.get(p, k)) & (v <= F.get(p, k + 1)))
    dealt = cells.join(F.broadcast(brackets), "i").select("i", "v", F.when(inside, v).alias("exact"), F.when(~inside, F.size(F.filter(p, lambda x: x < v))).alias("gap"))
    counts = dealt.groupBy("i", "exact", "gap").agg(F.min("v").alias("v"), F.count("*").alias("n")).select("i", "v", "n")
    base = 0  # places count from 0 over all columns
    want: dict[tuple[int, int], int] = {}
    for i in sorted(sketched):
        n = sketched[i][0]
        for q in QUARTILES:
            low = int((n - 1) * q)
            want |= {(i, low): base + low, (i, min(low + 1, n - 1)): base + min(low + 1, n - 1)}
        base += n
    found = counts.limit(COLLECTED + 1).collect()
    at: dict[int, float] = {}
    if len(found) <= COLLECTED:
        rows, upto, sought = sorted((r["i"], r["v"], r["n"]) for r in found), 0, sorted(set(want.values()))
        k = 0
        for _, value, n in rows:
            upto += n
            while k < len(sought) and sought[k] < upto:
                at[sought[k]] = value
                k += 1
    else:
        summed = running_sums(saved(counts), [F.col("i"), F.col("v")], {"upto": "n"})
        sought = F.lit(np.array(sorted(set(want.values())), dtype=np.int64))
        own = F.filter(sought, lambda x: (x >= F.col("upto") - F.col("n")) & (x < F.col("upto")))
        at = {r["p"]: r["v"] for r in summed.select("v", F.explode(own).alias("p")).collect()}
    out: list[list[float] | None] = [None] * places
    for i, (n, _) in sketched.items():
        found_ = []
        for q in QUARTILES:
            low, share = divmod((n - 1) * q, 1)
            a, b = at[want[i, int(low)]], at[want[i, min(int(low) + 1, n - 1)]]
            found_.append(a + (b - a) * share)
        out[i] = found_
    return out


def _fit(train: DataFrame, columns: list[str], method: str, approximate: bool) -> list[tuple[float, float]]:
    """(shift, divisor) of each column."""
    if method == "robust" and not approximate:
        row = [q and (q[1], q[2] - q[0]) for q in quartiles(train, columns)]
    else:
        aggregate = {
            "standard": lambda c: F.struct(F.avg(c), F.stddev_pop(c)),
            "minmax": lambda c: F.struct(F.min(c).cast("double"), (F.max(c) - F.min(c)).cast("double")),
            "robust": lambda c: F.percentile_approx(c, list(QUARTILES), 10_000),
        }[method]
        row = train.agg(*[aggregate(F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
        row = [(r[1], r[2] - r[0]) if method == "robust" and r else r for r in row]
    return [(r[0], r[1] or 1.0) if r and r[0] is not None else (0.0, 1.0) for r in row]


def scale(df: DataFrame, columns: list[str], method: str, train: Column | None = None, approximate: bool = False) -> DataFrame:
    """Columns scaled by `standard` (population deviation), `minmax`, or `robust` (median and quartile range); a zero width divides by 1.

    train: condition of the rows to fit on. The fit is two numbers a column, put into the plan as literals, so there is no join.
    """
    fitted = _fit(df.filter(train) if train is not None else df, columns, method, approximate)
    scaled = {c: ((F.col(c) - F.lit(float(shift))) / F.lit(float(width))) for c, (shift, width) in zip(columns, fitted, strict=True)}
    return df.withColumns(scaled)


def scale_rowl2(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row divided by its Euclidean norm; a zero row stays."""
    square = F.lit(0.0)
    for c in columns:
        square = square + F.col(c).cast("double") * F.col(c)
    norm = F.when(square == 0, 1.0).otherwise(F.sqrt(square))
    return df.withColumn("__norm", norm).withColumns({c: F.col(c) / F.col("__norm") for c in columns}).drop("__norm")


def scale_vector(vector: Column) -> Column:
    """An array divided by its Euclidean norm."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return F.transform(vector, lambda x: x / F.when(norm == 0, 1.0).otherwise(norm))
