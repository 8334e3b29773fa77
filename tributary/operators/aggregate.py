"""Roll-ups to one row per entity, with the NULL rules of data frames: NULL keys are dropped, a sum of NULLs only is 0."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.columns import credit_to_income, income_per_person, late_flag, payment_diff, status_past_due

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def _aggregate(name: str, fn: str):
    if fn == "sum":
        return F.coalesce(F.sum(name), F.lit(0)).alias(f"{name}_sum")
    return {"count": F.count, "mean": F.avg, "max": F.max, "min": F.min}[fn](name).alias(f"{name}_{fn}")


def multi_agg(df: DataFrame, key: str, spec: dict[str, list[str]]) -> DataFrame:
    """{column: [count, mean, sum, max, min]} by key, named <column>_<fn>; columns that don't exist are left out."""
    aggregates = [_aggregate(c, fn) for c, fns in spec.items() if c in df.columns for fn in fns]
    if not aggregates:
        raise ValueError("none of the columns exists")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggregates)


def app_learn(
    df: DataFrame, key: str = "SK_ID_CURR", target: str = "TARGET", income: str = "AMT_INCOME_TOTAL", children: str = "CNT_CHILDREN", credit: str = "AMT_CREDIT",
) -> DataFrame:
    """Key, target, two ratios and the text columns, of the rows without any missing value."""
    texts = [c for c, t in df.dtypes if t == "string" and c not in (key, target)]
    ratios = [
        income_per_person(F.col(income), F.col(children)).alias("INCOME_PER_PERSON"),
        credit_to_income(F.col(credit), F.col(income)).alias("CREDIT_TO_INCOME"),
    ]
    return df.na.drop("any").select(key, target, *ratios, *texts)


def prev_app_agg(df: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    return multi_agg(df, key, {"AMT_APPLICATION": ["count", "mean", "sum"], "AMT_CREDIT": ["mean", "max"], "AMT_DOWN_PAYMENT": ["mean"], "CNT_PAYMENT": ["mean"]})


def installment_agg(df: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    flagged = df.withColumns({"PAYMENT_DIFF": payment_diff(F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT")), "LATE_PAYMENT": late_flag(F.col("DAYS_ENTRY_PAYMENT"))})
    return multi_agg(flagged, key, {"AMT_PAYMENT": ["sum", "mean"], "AMT_INSTALMENT": ["sum", "mean"], "PAYMENT_DIFF": ["mean"], "LATE_PAYMENT": ["sum", "mean"]})


def with_fallback(df: DataFrame, key: str, spec: dict[str, list[str]]) -> DataFrame:
    """multi_agg; if no expected column exists, mean and max of the first five numeric ones."""
    return multi_agg(df, key, spec) if set(spec) & set(df.columns) else fallback_numeric_agg(df, key)


def fallback_numeric_agg(df: DataFrame, key: str) -> DataFrame:
    return multi_agg(df, key, {c: ["mean", "max"] for c in [c for c in numeric_columns(df) if c != key][:5]})


def card_balance_agg(df: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    amounts = {c: ["mean", "max"] for c in ("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT")}
    return with_fallback(df, key, amounts | {c: ["max", "mean"] for c in ("SK_DPD", "SK_DPD_DEF")})


def pos_cash_agg(df: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    return with_fallback(df, key, {"SK_DPD": ["max", "mean"], "SK_DPD_DEF": ["max", "mean"], "MONTHS_BALANCE": ["count"]})


def bureau_month_agg(df: DataFrame, key: str = "SK_ID_BUREAU", status: str = "STATUS") -> DataFrame:
    """MONTHS_COUNT and the share of months with a status past due; a missing status is not past due."""
    rate = F.avg(F.when(status_past_due(F.col(status)), 1.0).otherwise(0.0))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("MONTHS_COUNT"), rate.alias("STATUS_PAST_DUE_RATE"))


def left_attach_agg(bureau: DataFrame, months: DataFrame, key: str = "SK_ID_BUREAU") -> DataFrame:
    return bureau.join(months, key, "left")


def bureau_agg(bureau: DataFrame, balance: DataFrame, key: str = "SK_ID_CURR", bureau_key: str = "SK_ID_BUREAU", past_due: bool = False) -> DataFrame:
    """Two levels: months to bureau records to clients. past_due adds the mean of STATUS_PAST_DUE_RATE."""
    attached = left_attach_agg(bureau, bureau_month_agg(balance, bureau_key), bureau_key).withColumn("BUREAU_COUNT", F.lit(1))
    spec = {c: ["mean", "max"] for c in ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT", "DAYS_ENDDATE_FACT") if c in bureau.columns}
    if not spec:
        raise ValueError("none of the expected columns exists")
    return multi_agg(attached, key, spec | {"BUREAU_COUNT": ["sum"]} | ({"STATUS_PAST_DUE_RATE": ["mean"]} if past_due else {}))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("n"))


def scale_pos_weight(df: DataFrame, target: str) -> DataFrame:
    """n(0) / n(1) as one row, NULL unless the classes are exactly 0 and 1."""
    counts = df.agg(F.count_if(F.col(target) == 0).alias("zeros"), F.count_if(F.col(target) == 1).alias("ones"), F.count("*").alias("n"))
    exact = (F.col("zeros") > 0) & (F.col("ones") > 0) & (F.col("zeros") + F.col("ones") == F.col("n"))
    return counts.select(F.when(exact, F.col("zeros") / F.nullif("ones", F.lit(0))).alias("scale_pos_weight"))


def feature_bounds(df: DataFrame, features: list[str]) -> DataFrame:
    """feature, least, most: all columns in one pass."""
    one = df.agg(*[f(c).cast("double").alias(f"{k}{i}") for i, c in enumerate(features) for k, f in (("a", F.min), ("b", F.max))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("least"), F.col(f"b{i}").alias("most")) for i, c in enumerate(features)])))


def category_cardinality(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """column, n: distinct values of each column, NULL counting as one.

    Values are stacked as (column, value) and made distinct once, so that rows are not multiplied again by an expand per column.
    """
    if approximate:
        one = df.agg(*[(F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
        return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("n")) for c in columns])))
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    return stacked.distinct().groupBy("column").agg(F.count("*").alias("n"))
