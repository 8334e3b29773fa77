"""From a table to a feature matrix: numeric columns, then one-hot columns, then ordinal codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.aggregate import NUMERIC, category_cardinality
from tributary.operators.rank import global_rank
from tributary.plans.lineage import saved

MISSING = "nan"


def split_features_target(df: DataFrame, target: str, features: list[str] | None = None) -> DataFrame:
    """Feature columns first (all others if none are named), the target last."""
    return df.select(*(features or [c for c in df.columns if c != target]), target)


def classify_columns(df: DataFrame, skip: list[str] = ()) -> dict[str, list[str]]:
    """categorical (text), numerical, and excluded columns (booleans, dates, nested ones)."""
    kinds: dict[str, list[str]] = {"categorical": [], "numerical": [], "excluded": []}
    for c, t in df.dtypes:
        if c not in skip:
            kinds["categorical" if t == "string" else "numerical" if t in NUMERIC or t.startswith("decimal") else "excluded"].append(c)
    return kinds


def encoding_threshold(rows: int) -> int:
    """Up to so many distinct values a column is one-hot encoded."""
    return max(2, int(0.01 * rows))


def encoding_plan(df: DataFrame, columns: list[str], max_wide: int = 1000) -> DataFrame:
    """column, n, kind: `one_hot` up to the threshold of the table's rows, else `ordinal`.

    The threshold grows with the table. Where it lets more than max_wide values through, the kind is `one_hot_sparse`: the same encoding, with the place of
    the one in each row in place of a column for each value.
    """
    kind = F.when(F.col("n") > encoding_threshold(df.count()), "ordinal").when(F.col("n") > max_wide, "one_hot_sparse").otherwise("one_hot")
    return category_cardinality(df, columns).withColumn("kind", kind)


def fitted_encoding(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """column, kind, category, code of each value of the columns, to encode other tables with. Codes are 0-based ranks in code point order; NULL is no category
    of one-hot columns, and `nan` of ordinal ones."""
    out = None
    for column, kind in kinds.items():
        values = df if kind == "ordinal" else df.filter(F.col(column).isNotNull() & (F.col(column).cast("string") != MISSING))
        one = dictionary(values, column).select(F.lit(column).alias("column"), F.lit(kind).alias("kind"), F.col("value").alias("category"), "code")
        out = one if out is None else out.unionByName(one)
    return saved(out)


def categories(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The sorted values of a column known to have few; more than `most` is an error."""
    found = [r[0] for r in df.select(F.col(column).cast("string").alias("v")).filter("v IS NOT NULL").distinct().orderBy("v").limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; use ordinal codes or one_hot_pairs")
    return found


def one_hot(df: DataFrame, column: str, values: list[str] | None = None) -> DataFrame:
    """0/1 columns <column>_<value> in value order, and <column>_nan for NULL, in place of the column."""
    values = categories(df, column) if values is None else values
    text = F.col(column).cast("string")
    flags = [F.coalesce(text == v, F.lit(False)).cast("int").alias(f"{column}_{v}") for v in values if v != MISSING]
    return df.select(*[c for c in df.columns if c != column], *flags, (text.isNull() | F.coalesce(text == MISSING, F.lit(False))).cast("int").alias(f"{column}_{MISSING}"))


def one_hot_sparse(df: DataFrame, column: str, fitted: DataFrame | None = None) -> DataFrame:
    """<column>_hot in place of the column: the place of the one among the sorted values, -1 for NULL and for values that the dictionary doesn't hold."""
    values = dictionary(df.filter(F.col(column).isNotNull() & (F.col(column).cast("string") != MISSING)), column) if fitted is None else fitted
    coded = ordinal(df, column, values)
    return coded.withColumn(f"{column}_ord", F.col(f"{column}_ord").cast("long")).withColumnRenamed(f"{column}_ord", f"{column}_hot")


def one_hot_pairs(df: DataFrame, key: str, column: str) -> DataFrame:
    """The sparse form for wide columns: (key, code) of the value that is set."""
    return ordinal(df.select(key, column), column).select(key, F.col(f"{column}_ord").cast("long").alias("code"))


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """value, code: the 0-based rank of each text value, in code point order, ranked in parallel."""
    values = saved(df.select(F.coalesce(F.col(column).cast("string"), F.lit(MISSING)).alias("value")).distinct())
    return global_rank(values, [F.col("value")], "code").select("value", (F.col("code") - 1).cast("double").alias("code"))


def ordinal(df: DataFrame, column: str, fitted: DataFrame | None = None) -> DataFrame:
    """<column>_ord in place of the column; values that the dictionary doesn't hold get -1."""
    codes = dictionary(df, column) if fitted is None else fitted
    value = F.coalesce(F.col(column).cast("string"), F.lit(MISSING))
    joined = df.withColumn("__value", value).join(codes.withColumnRenamed("value", "__value"), "__value", "left")
    return joined.select(*[c for c in df.columns if c != column], F.coalesce("code", F.lit(-1.0)).alias(f"{column}_ord"))


def build_matrix(df: DataFrame, kinds: dict[str, str], numerical: list[str], keep: list[str], fitted: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Numeric columns, one-hot groups, sparse ones, ordinal codes, after the columns to keep; and the names of the features in order.

    fitted: a table of fitted_encoding, so that a test table gets the columns and codes of the training table. Without it they come from `df` itself.
    """
    of = (lambda c: fitted.filter(F.col("column") == c).select(F.col("category").alias("value"), "code")) if fitted is not None else lambda c: None
    out, features = df.select(*keep, *numerical, *kinds), list(numerical)
    for column in [c for c, k in kinds.items() if k == "one_hot"]:
        values = categories(of(column), "value") if fitted is not None else None
        before = set(out.columns)
        out = one_hot(out, column, values)
        features += [c for c in out.columns if c not in before]
    for column in [c for c, k in kinds.items() if k == "one_hot_sparse"]:
        out = one_hot_sparse(out, column, of(column))
        features.append(f"{column}_hot")
    for column in [c for c, k in kinds.items() if k == "ordinal"]:
        out = ordinal(out, column, of(column))
        features.append(f"{column}_ord")
    if not features:
        raise ValueError("no feature column")
    return out.select(*keep, *features), features
