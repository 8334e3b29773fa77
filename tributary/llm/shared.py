"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
from collections.abc import Callable
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.plans.lineage import new_folder, saved, shared_folder

__all__ = [
    "HOT_SHARE", "SPACES", "SPACE_CLASS", "WORD", "documents", "few", "forget", "join_many", "kept", "let", "one_of_each", "saved", "shared_folder", "shared_value", "small_batches", "stripped", "trimmed", "written",
]

#: A word is a run of anything but these white-space characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: A key that holds more than one row in HOT_SHARE counts as hot; there are fewer than HOT_SHARE of them.
HOT_SHARE = 1000
#: Up to so many row numbers (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Up to so many rows of a few numbers are broadcast by join_many.
BROADCAST_NARROW = 250_000
#: What join_many broadcasts of hot keys with wide rows; and parts that a hot key with a wider row is cut into.
BROADCAST_BYTES, SALTS = 64 << 20, 64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_value(spark: SparkSession, value):
    """A function that gives `value`, of bounded size, in tasks. It is broadcast with the code of its classes."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(packed.value)


def kept(name: str, make: Callable):
    """What a Python worker keeps from task to task, of bounded size: the first task that asks for `name` makes it. A worker keeps one such thing at a time."""
    store = _store()
    if name not in store:
        forget()
        store[name] = make()
    return store[name]


def _store() -> dict:
    module = sys.modules.setdefault("_kept_from_task_to_task", ModuleType("_kept_from_task_to_task"))
    return module.__dict__.setdefault("values", {})


def forget() -> None:
    """Give back what an earlier operator's tasks have kept in this Python worker; asked for at the beginning of tasks that need memory of their own."""
    if _store():
        _store().clear()
        gc.collect()
        trimmed()


def trimmed() -> None:
    """Give memory that is free back to the machine; not every C library has this."""
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def _bytes(text: str) -> int:
    """Bytes that a setting such as 32m names."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def small_batches(spark: SparkSession, rows: int = 500, size: str = "32m") -> None:
    """Bound the rows and bytes that go to Python at once, as some texts are very long.

    These are required settings of the session for the Python operators (see the README). Plans are executed later than they are made, so they cannot be set back
    here; a session that has set fewer rows keeps them.
    """
    for name, value, of in (("maxRecordsPerBatch", str(rows), int), ("maxBytesPerBatch", size, _bytes)):
        held = of(spark.conf.get(f"spark.sql.execution.arrow.{name}"))
        if not 0 < held <= of(value):
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)


def stripped(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def let(value: Column, body) -> Column:
    """body(value), with value computed once for each row and bound to a lambda variable.

    The optimiser may copy a column's expression into a lambda that names it, where it would be computed anew for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def join_many(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int, narrow: bool = False, size: Column | None = None) -> DataFrame:
    """Inner join of a narrow `left` with `right`, one row per key, where a key can hold a third of all rows of `left`.

    `weight` of `right` is the key's number of rows in `left`, `total` their sum. Keys over total / HOT_SHARE rows
    are fewer than HOT_SHARE, so that part of `right` is broadcast; the others are joined by a shuffle. narrow: `right` is saved and holds a few
    numbers a row, so it is counted, and broadcast as a whole up to BROADCAST_NARROW rows. size: the bytes of a row of `right`, where rows can be wide. Then a hot row of more
    than BROADCAST_BYTES / HOT_SHARE isn't broadcast, but sent to each of the SALTS parts that its key is cut into.
    """
    if narrow and right.count() <= BROADCAST_NARROW:
        return left.join(F.broadcast(right), keys)
    is_hot = F.col(weight) * HOT_SHARE > total
    hot, cold = right.filter(is_hot), right.filter(~is_hot)
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    joined = rest.join(cold, keys)
    if size is not None:
        small = size * HOT_SHARE <= BROADCAST_BYTES
        wide = hot.filter(~small)
        salted = wide.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = left.join(F.broadcast(wide.select(*keys)), keys, "left_semi").withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
        joined = joined.unionByName(own.join(salted, [*keys, "__salt"]).drop("__salt"))
        hot = hot.filter(small)
    return left.join(F.broadcast(hot), keys).unionByName(joined)


def written(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again. A checkpoint keeps the size estimated for its plan, a product that gains digits with each join of a round."""
    path = new_folder(df.sparkSession, "written")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def few(ids: DataFrame) -> DataFrame:
    """Row numbers, written, and broadcast if there are few."""
    ids = written(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def one_of_each(docs: DataFrame, components: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`docs` with one row of each component: the smallest doc_id, null ones last, then by the SHA-256 of its text. Columns of any name stay.

    components: from saved rows (row, doc_id, text) to (row, root) of the rows that are in a component with others.
    """
    numbered = saved(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))
    rows = numbered.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    reached = written(components(rows))
    members = rows.join(few(reached.select("row")), "row", "left_semi").select("row", "doc_id", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("sha"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha", "row")
    stays = members.join(reached, "row").groupBy("root").agg(F.min(order).alias("s")).select("s.row")
    dropped = reached.select("row").join(stays, "row", "left_anti")
    return numbered.join(few(dropped), "row", "left_anti").select("doc.*")
