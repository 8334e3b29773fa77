"""Missing values: NULL and NaN alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.rank import carry


def missing_drop(df: DataFrame) -> DataFrame:
    """Rows without any missing value."""
    return df.na.drop("any")


def missing_fill(df: DataFrame, value: float | int | str = 0) -> DataFrame:
    """Every missing value replaced by one value: as text in string columns, as a number in the others."""
    filled = df.na.fill(str(value))
    return filled.na.fill(value) if isinstance(value, (int, float)) else filled


def _without_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns if c in floats})


def missing_ffill(df: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """The last value above in the given total order; leading missing values stay."""
    return carry(_without_nan(df, columns), order, columns, forward=True)


def missing_bfill(df: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """The next value below; trailing missing values stay."""
    return carry(_without_nan(df, columns), order, columns, forward=False)
