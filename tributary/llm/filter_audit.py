"""Filter interaction audit: what each of several filters removes, under every order in which they can be applied.

Method. The filters that a document fails are the bits of a mask. For every mask (and the document's two label flags) there is one big integer, whose fields of
FIELD_BITS bits say, for each order and each step, whether the document is kept after the step, removed by it, or fails it but was removed earlier, and whether a
good or a toxic document is removed by it: 3,000 fields for five filters, 600 of each kind. Integers are summed per part: in each task, then by part and a salt, then
by part. A field counts rows, so it can't overflow below 2^63 of them, and no field carries into the next. The sums are unpacked at the end. A document counts once as
removed in each order, so a filter's Shapley value is its removed counts over all orders.

Identical texts are found by one aggregate per SHA-256 of the text (the smallest doc_id) and a join on digest and doc_id together, so that a large group of copies is
spread by its ids. Only narrow rows are exchanged.

Defined results. A null text counts as empty, a null part as the empty string. A row without a doc_id has no smaller doc_id and none of its copies is larger, so it
never fails by identity; rows that repeat a doc_id and its text don't fail because of each other. A document is good or toxic if any of its rows in labels says so.
No documents give no rows. Columns other than doc_id, text, the part, quality and toxic are not read, whatever their names. A text of any length is one mask.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import SPACE_CLASS, let, saved

FIELD_BITS = 64
OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
#: Sums of a part meet in so many groups before they meet in one.
SALTS = 32
#: Sums that a task holds; it hands them on when there are more parts than that (24 kB each for five filters).
MAX_PARTS_HELD = 1000
SUMS = "part string, salt int, packed binary"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def _by_words(of: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    return lambda text: let(words_of(text), lambda w: of(F.size(w), F.size(F.array_distinct(w))))


#: Failure conditions by letter; each takes the text and gives a boolean. The letter after the last stands for identity with a smaller doc_id's text.
CONDITIONS: dict[str, Callable[[Column], Column]] = {
    "A": _by_words(lambda n, distinct: n < 100),
    "B": _by_words(lambda n, distinct: 100 * distinct < 80 * n),
    "C": lambda text: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
    "D": lambda text: text.rlike(r"[#$%&*|]"),
}
IDENTICAL = "E"


def failures(text: Column) -> Column:
    """The mask of CONDITIONS; words are taken once for the two conditions on them."""
    by_words = let(words_of(text), lambda w: (F.size(w) < 100).cast("int") + F.when(100 * F.size(F.array_distinct(w)) < 80 * F.size(w), 2).otherwise(0))
    return by_words + F.when(CONDITIONS["C"](text), 4).otherwise(0) + F.when(CONDITIONS["D"](text), 8).otherwise(0)


def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def packed_outcomes(letters: str) -> list[int]:
    """For each mask + good * 2^n + toxic * 2^(n + 1): one integer, field (outcome, order, step) of which is 1 if so."""
    n, all_orders = len(letters), orders(letters)
    made = []
    for code in range(1 << (n + 2)):
        good, toxic = code >> n & 1, code >> (n + 1) & 1
        fields = np.zeros((len(OUTCOMES), len(all_orders), n), dtype="<u8")
        for k, order in enumerate(all_orders):
            gone = False
            for step, letter in enumerate(order):
                fails = bool(code >> letters.index(letter) & 1)
                here = fails and not gone
                redundant, gone = fails and gone, gone or fails
                fields[:, k, step] = (not gone, here, redundant, here and good, here and toxic)
        made.append(int.from_bytes(fields.tobytes(), "little"))
    return made


def unpacked(total: bytes, letters: str) -> np.ndarray:
    """Counts by (outcome, order, step) of a sum."""
    return np.frombuffer(total, dtype="<u8").reshape(len(OUTCOMES), -1, len(letters)).astype(np.int64)


def _width(letters: str) -> int:
    return len(OUTCOMES) * len(orders(letters)) * len(letters) * FIELD_BITS // 8


def _handed_on(sums: dict[str, int], width: int) -> pd.DataFrame:
    salt = TaskContext.get().partitionId() % SALTS
    return pd.DataFrame({"part": list(sums), "salt": [salt] * len(sums), "packed": [v.to_bytes(width, "little") for v in sums.values()]})


def _summed(batches: Iterator[pd.DataFrame], width: int, values: Callable[[pd.DataFrame], Iterator[tuple[str, int]]]) -> Iterator[pd.DataFrame]:
    sums: dict[str, int] = {}
    for batch in batches:
        for part, value in values(batch):
            sums[part] = sums.get(part, 0) + value
            if len(sums) > MAX_PARTS_HELD:
                yield _handed_on(sums, width)
                sums = {}
    if sums:
        yield _handed_on(sums, width)


def packed_sums(masked: DataFrame, letters: str) -> DataFrame:
    """One row per part: part, packed. masked: part, code."""
    width = _width(letters)

    def from_codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = packed_outcomes(letters)
        yield from _summed(batches, width, lambda b: ((part, n * numbers[code]) for (part, code), n in b.groupby(["part", "code"]).size().items()))

    def from_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _summed(batches, width, lambda b: ((p, int.from_bytes(v, "little")) for p, v in zip(b["part"], b["packed"], strict=True)))

    first = masked.select("part", "code").mapInPandas(from_codes, SUMS)
    salted = first.repartition("part", "salt").mapInPandas(from_sums, SUMS)
    # a task that holds too many parts hands a part's sum on in pieces, so they are met once more, by part alone
    return salted.repartition("part").sortWithinPartitions("part").mapInPandas(_whole(width), "part string, packed binary")


def _whole(width: int):
    """Sums of parts that lie together, one part held at a time."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, total = None, 0
        for batch in batches:
            done: list[tuple[str, bytes]] = []
            for name, value in zip(batch["part"], batch["packed"], strict=True):
                if part is not None and name != part:
                    done.append((part, total.to_bytes(width, "little")))
                    total = 0
                part, total = name, total + int.from_bytes(value, "little")
            if done:
                yield pd.DataFrame(done, columns=["part", "packed"])
        if part is not None:
            yield pd.DataFrame([(part, total.to_bytes(width, "little"))], columns=["part", "packed"])

    return whole


def report(sums: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step. sums: part, packed."""
    counted = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_orders = orders(letters)
        at = np.array([[letters.index(x) for x in o] for o in all_orders])  # the filter of each order and step
        for batch in batches:
            for part, total in zip(batch["part"], batch["packed"], strict=True):
                c = dict(zip(OUTCOMES, unpacked(total, letters), strict=True))
                shapley = np.bincount(at.ravel(), c["removed"].ravel(), len(letters)) if c["removed"].max(initial=0) < 1 << 40 else np.array([sum(int(v) for v in c["removed"][at == f]) for f in range(len(letters))])
                unique = np.array([c["removed"][np.flatnonzero(at[:, -1] == f)[0], -1] for f in range(len(letters))])  # what the last filter still finds
                values = {**c, "unique_fails": unique[at], "shapley": shapley.astype(np.int64)[at]}
                yield pd.DataFrame({"part": part, "filter_order": np.repeat(all_orders, len(letters)), "step": np.tile(np.arange(1, len(letters) + 1), len(all_orders)), **{k: values[k].ravel() for k in counted}})

    return sums.mapInPandas(rows, "part string, filter_order string, step int, " + ", ".join(f"{k} long" for k in counted))


def masked(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per document: doc_id, part, mask (failed filters, the first in the lowest bit), good, toxic, code."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = saved(docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failures(text).alias("own"), F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
    ))
    named, nameless = rows.filter(F.col("doc_id").isNotNull()), rows.filter(F.col("doc_id").isNull())
    owners = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("owns", F.lit(True))
    of_doc = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    judged = named.join(owners, ["digest", "doc_id"], "left").withColumn("copy", F.col("owns").isNull().cast("int")).drop("owns", "digest").join(of_doc, "doc_id", "left")
    none = {"copy": F.lit(0), "good": F.lit(0), "toxic": F.lit(0)}
    every = judged.unionByName(nameless.drop("digest").withColumns(none))
    n = len(CONDITIONS)
    mask, good, toxic = F.col("own") + F.shiftleft("copy", n), F.coalesce("good", F.lit(0)), F.coalesce("toxic", F.lit(0))
    return every.select("doc_id", "part", mask.alias("mask"), good.alias("good"), toxic.alias("toxic"), (mask + F.shiftleft(good, n + 1) + F.shiftleft(toxic, n + 2)).alias("code"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    letters = "".join(CONDITIONS) + IDENTICAL
    return report(packed_sums(masked(docs, labels, part), letters), letters)
