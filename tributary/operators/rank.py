"""Global ranks, running sums and carried values without a window over all rows in one task.

Rows are dealt out by range. The borders are drawn once, from a sample of the order columns, and put into the plan as
literals: a row's part follows from its own order columns, so a plan that runs again deals the same way, and nothing has to be saved. A part's own
sums, one row for each part, are added up into offsets; rows get their offset by a broadcast join of that table.

`order` holds columns that sort ascending, NULL first; negate a number to sort it downwards. Together they are a total order where a
result depends on it. The input is computed several times: save it first if it is dear.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

PART = "__part"
#: Sampled rows for each part.
SAMPLED = 20
#: From so many borders on, they are searched in two steps.
ONE_STEP = 32
#: Parts at most, as their borders are literals: the driver sees SAMPLED rows for each, and the plan holds one border for each. Past that, parts grow with the rows, and a part's sort spills.
MOST_PARTS = 4000


def _borders(df: DataFrame, order: list[Column], parts: int) -> tuple[list, str]:
    """At most parts - 1 rows of the order columns that cut the rows into even parts, and their type."""
    keys = df.select(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("k"))
    by_hash = F.xxhash64("k", F.monotonically_increasing_id())  # rows, not keys, are equally likely
    drawn = keys.select("k", by_hash.alias("h")).orderBy("h").limit(SAMPLED * parts).select("k").orderBy("k").collect()
    found = [r["k"] for r in drawn]
    cuts = [found[len(found) * i // parts] for i in range(1, parts)] if found else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]], keys.schema["k"].dataType.simpleString()


def _literal(value) -> Column:
    """A value, or a row of values, as a literal."""
    return F.struct(*[_literal(v).alias(f"o{i}") for i, v in enumerate(value)]) if isinstance(value, tuple) else F.lit(value)


def by_range(df: DataFrame, order: list[Column]) -> DataFrame:
    """`df` with the number of its range; rows equal in `order` share one."""
    parts = min(MOST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts, kind = _borders(df, order, parts)
    if not cuts:
        return df.withColumn(PART, F.lit(0))
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    literal = lambda some: F.array(*[_literal(c) for c in some]).cast(f"array<{kind}>")
    below = lambda some, k: F.size(F.filter(some, lambda c: c < k))
    keyed = df.withColumn("__key", key)
    if len(cuts) <= ONE_STEP:
        return keyed.withColumn(PART, below(literal(cuts), F.col("__key"))).drop("__key")
    wide = isqrt(len(cuts))
    groups = [cuts[i : i + wide] for i in range(0, len(cuts), wide)]
    first = below(literal([g[-1] for g in groups]), F.col("__key"))  # groups of borders that lie below altogether
    inside = F.get(F.array(*[literal(g) for g in groups], F.array().cast(f"array<{kind}>")), first)
    return keyed.withColumn("__group", first).withColumn(PART, F.col("__group") * wide + below(inside, F.col("__key"))).drop("__key", "__group")


def with_offsets(dealt: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """`dealt` joined with, for each name, the sum of its aggregate over all earlier parts.

    The driver sees one row of sums for each part, and nothing else.
    """
    per_part = dealt.groupBy(PART).agg(*[F.coalesce(v, F.lit(0)).alias(k) for k, v in sums.items()])
    before, offsets = [0] * len(sums), []
    for row in sorted(per_part.collect()):
        offsets.append((row[0], *(type(v)(x) for x, v in zip(before, row[1:], strict=True))))
        before = [x + v for x, v in zip(before, row[1:], strict=True)]
    return dealt.join(F.broadcast(dealt.sparkSession.createDataFrame(offsets, per_part.schema)), PART)


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """`df` with a rank from 1 over all rows in the given total order."""
    dealt = with_offsets(by_range(df, order), {"__before": F.count("*")})
    local = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    return dealt.withColumn(name, (F.col("__before") + local).cast("long")).drop(PART, "__before")


def running_sums(df: DataFrame, order: list[Column], columns: dict[str, str]) -> DataFrame:
    """`df` with, for each new name, the running sum of a column over all rows in the given total order, own row included."""
    dealt = with_offsets(by_range(df, order), {f"__{k}": F.sum(v) for k, v in columns.items()})
    upto = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumns({k: F.col(f"__{k}") + F.sum(v).over(upto) for k, v in columns.items()}).drop(PART, *[f"__{k}" for k in columns])


def carry(df: DataFrame, order: list[Column], columns: list[str], forward: bool = True) -> DataFrame:
    """Nulls of `columns` replaced by the last value above (forward) or the next below, in a total order over all rows."""
    dealt = by_range(df, order)
    # backward, too, the frame grows from row to row: one that ends at the last row would be read anew for every row
    frame = Window.partitionBy(PART).orderBy(*[o if forward else o.desc() for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({f"__{c}": F.last(c, ignorenulls=True).over(frame) for c in columns})
    # of each part the value that leaves it, found among its own rows by their order
    best = F.max_by if forward else F.min_by
    key = F.struct(*[o for o in order])
    leaving = dealt.groupBy(PART).agg(*[best(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), key)).alias(c) for c in columns])
    last, entering_rows = [None] * len(columns), []
    for row in sorted(leaving.collect(), key=lambda r: r[0], reverse=not forward):  # one row for each part
        entering_rows.append((row[0], *last))
        last = [old if new is None else new["v"] for old, new in zip(last, row[1:], strict=True)]
    types = {f.name: f.dataType for f in df.schema.fields}
    schema = StructType([StructField(PART, IntegerType()), *[StructField(f"__in_{c}", types[c]) for c in columns]])
    entering = df.sparkSession.createDataFrame(entering_rows, schema)
    out = local.join(F.broadcast(entering), PART)
    return out.select(*[F.coalesce(F.col(f"__{c}"), F.col(f"__in_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])
