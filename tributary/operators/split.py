"""Reproducible train, validation and test splits of exact sizes.

A row's place is the rank of the hash of its unique key under a seed, so a split doesn't depend on how rows are partitioned. Ranks
come from buckets of leading hash digits, as many digits as the number of rows asks for: rows are counted by bucket, the table of counts gives
offsets, and a window orders each bucket by itself.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.rank import global_rank
from tributary.plans.lineage import saved

#: Rows of a bucket, about, and the most digits: a million buckets.
BUCKET_ROWS, MOST_DIGITS = 200_000, 5
#: Offsets and quotas of up to so many rows are broadcast; larger tables are joined by a shuffle.
BROADCAST_ROWS = 500_000


def digits_for(rows: int) -> int:
    """Leading hexadecimal digits that cut so many rows into buckets of about BUCKET_ROWS."""
    digits = 1
    while digits < MOST_DIGITS and rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def split_sizes(n: int, train: float, val: float, test: float) -> dict[str, int]:
    """Held-out parts are rounded up: first test of all, then val of the rest."""
    total = train + val + test
    train, val, test = train / total, val / total, test / total
    n_test = ceil(test * n)
    n_val = ceil(val / (val + train) * (n - n_test)) if val + train else 0
    return {"train": n - n_test - n_val, "val": n_val, "test": n_test}


def hash_key(key: list[str], seed: int) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]), 256)


def bucketed_rank(df: DataFrame, digest: str, group: list[str] = (), name: str = "rank", rows: int | None = None, groups: int = 1) -> DataFrame:
    """`df` with the rank from 1 of a hexadecimal digest, within each group. rows, groups: how many there are (rows are counted if not given)."""
    digits = digits_for(df.count() if rows is None else rows)
    keyed = df.withColumn("__bucket", F.substring(digest, 1, digits))
    by = [*group, "__bucket"]
    counts = keyed.groupBy(*by).agg(F.count("*").alias("__n"))  # at most 16 ** digits rows a group
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    for c in group:
        offsets = offsets.withColumnRenamed(c, f"__g_{c}")
    if groups * 16**digits <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = keyed.withColumn("__at", F.row_number().over(Window.partitionBy(*by).orderBy(digest)))
    joined = placed.join(offsets, (placed["__bucket"] == offsets["__bucket"]) & _same(placed, offsets, group)).drop(offsets["__bucket"])
    return joined.withColumn(name, F.col("__at") + F.col("__before")).drop("__bucket", "__at", "__before", *[f"__g_{c}" for c in group])


def _same(left: DataFrame, right: DataFrame, group: list[str]) -> Column:
    out = F.lit(True)
    for c in group:
        out = out & left[c].eqNullSafe(right[f"__g_{c}"])
    return out


def _named(rank: Column, test: Column, val: Column) -> Column:
    return F.when(rank <= test, "test").when(rank <= test + val, "val").otherwise("train")


def split_exact(df: DataFrame, key: list[str], ratios: tuple[float, float, float], seed: int = 42) -> DataFrame:
    """`df` with split, of exact sizes. key: columns that together are unique."""
    n = df.count()
    sizes = split_sizes(n, *ratios)
    ranked = bucketed_rank(df.withColumn("__h", hash_key(key, seed)), "__h", name="__rank", rows=n)
    return ranked.withColumn("split", _named(F.col("__rank"), F.lit(sizes["test"]), F.lit(sizes["val"]))).drop("__h", "__rank")


def quotas(counts: dict, total: int) -> dict:
    """total shared in proportion to counts: whole parts, then one each by largest remainder, then by smaller class, NULL last."""
    n = sum(counts.values())
    parts = {c: divmod(k * total, n) for c, k in counts.items()}
    left = total - sum(q for q, _ in parts.values())
    extra = sorted(parts, key=lambda c: (-parts[c][1], c is None, 0 if c is None else c))[:left]
    return {c: q + (c in extra) for c, (q, _) in parts.items()}


def _quota_column(classes: DataFrame, count: str, total: int, name: str) -> DataFrame:
    """quotas over a saved table (__class, count) of any size, as a new column."""
    n, wide = classes.agg(F.sum(count)).first()[0], "decimal(38,0)"
    whole = F.col(count).cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)")
    parts = classes.withColumns({name: F.floor(whole / n).cast("long"), "__rest": (whole % n).cast(wide)})
    left = total - parts.agg(F.sum(name)).first()[0]
    ranked = global_rank(parts, [-F.col("__rest"), F.col("__class").isNull(), F.col("__class")], "__place")
    return saved(ranked.withColumn(name, F.col(name) + (F.col("__place") <= left).cast("long")).drop("__rest", "__place"))


def class_quotas(df: DataFrame, target: str, ratios: tuple[float, float, float], max_collected: int = 10_000) -> tuple[DataFrame, int, int]:
    """__class, __test, __val; the number of classes and of rows. Up to max_collected classes are shared out on the driver, more in a table; the result is the same."""
    classes = saved(df.groupBy(F.col(target).alias("__class")).agg(F.count("*").alias("__n")))
    n_classes, n = classes.agg(F.count("*"), F.coalesce(F.sum("__n"), F.lit(0))).first()
    sizes = split_sizes(n, *ratios)
    if n_classes > max_collected:
        tested = _quota_column(classes, "__n", sizes["test"], "__test").withColumn("__left", F.col("__n") - F.col("__test"))
        return _quota_column(saved(tested), "__left", sizes["val"], "__val").select("__class", "__test", "__val"), n_classes, n
    counts = dict(classes.collect())
    test = quotas(counts, sizes["test"]) if counts else {}
    val = quotas({c: k - test[c] for c, k in counts.items()}, sizes["val"]) if counts else {}
    schema = classes.select("__class").schema.add("__test", "long").add("__val", "long")
    return df.sparkSession.createDataFrame([(c, test[c], val[c]) for c in counts], schema), n_classes, n


def split_stratified(df: DataFrame, key: list[str], target: str, ratios: tuple[float, float, float], seed: int = 42, max_collected: int = 10_000) -> DataFrame:
    """split_exact with class shares kept at both cuts."""
    table, n_classes, n = class_quotas(df, target, ratios, max_collected)
    ranked = bucketed_rank(df.withColumn("__h", hash_key(key, seed)), "__h", [target], "__rank", n, n_classes)
    joined = ranked.join(F.broadcast(table) if n_classes <= BROADCAST_ROWS else table, ranked[target].eqNullSafe(table["__class"]))
    return joined.withColumn("split", _named(F.col("__rank"), F.col("__test"), F.col("__val"))).drop("__h", "__rank", "__class", "__test", "__val")


def split_unsupervised(df: DataFrame, key: list[str], ratios: tuple[float, float, float], seed: int = 42) -> DataFrame:
    """split_exact of rows without a target, such as files or tensors, by their path or number."""
    return split_exact(df, key, ratios, seed)


def split_none(df: DataFrame) -> DataFrame:
    return df.withColumn("split", F.lit("train"))


def random_sample_split(df: DataFrame, key: list[str], ratios: tuple[float, float, float], seed: int = 42) -> DataFrame:
    """Sizes near the ratios, by hash alone: no rank and no exchange."""
    total = sum(ratios)
    at = F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("double") / float(16**8)
    return df.withColumn("split", F.when(at < ratios[2] / total, "test").when(at < (ratios[1] + ratios[2]) / total, "val").otherwise("train"))


def split_summary(df: DataFrame, kinds: dict[str, int] | None = None) -> DataFrame:
    """split, n_rows, n_features (columns but split), and a column for each kind of feature of vectors.feature_kinds."""
    counted = df.groupBy("split").agg(F.count("*").alias("n_rows")).withColumn("n_features", F.lit(len(df.columns) - 1))
    return counted.withColumns({k: F.lit(n) for k, n in kinds.items()}) if kinds else counted
