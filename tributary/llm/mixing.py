"""Mixing sources to target weights by fitting subset sums.

Method. A source's target is its weighted share of a budget, capped at a number of times its size; what the caps cut off is
shared again by weight until no source is above its cap. Documents are counted by exact length; lengths take part in
proportion first, and the remaining budget is fitted by a bounded-knapsack dynamic program over the copies still left. Of
each length, every document is taken as often as that goes evenly, and those with the smallest seeded hashes once more. A source's dynamic program sees only its length counts, which grow with the longest text and not with the rows.

Defined results. A word is a run of characters other than space and U+0009 to U+000D; null texts have size 0. Null is a source
of its own, last in the order of weights. Texts of size 0 are taken as often as their source is whole and weigh nothing. A source
takes at most its target rounded down, and falls short by the least that the fitted lengths allow. Rows that repeat a doc_id are drawn one by one; those with its text, too, if they are many, by a number that each is given.
A very long text is one document of its length.
Reruns draw the same. No rows give no rows. Only doc_id, text and source are read; mixed keeps all columns.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.shared import HOT_SHARE, WORD, saved
from tributary.operators.rank import global_rank, running_sums

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
SEED = 17
#: Words that the dynamic program fits; what lies above is drawn in proportion.
KNAPSACK_WORDS = 1 << 15
#: Parts of a length that are drawn from in turn, so that a length with very many documents is ordered in parts.
PARTS = 256


def knapsack(lengths: list[int], left: list[int], budget: int) -> tuple[dict[int, int], int]:
    """How often to take each length, at most `left` times, for the largest sum within `budget`; and that sum.

    Reached sums are the bits of one number; each step adds a power of two of one length and notes the sums it reached first.
    """
    reached, full, steps = 1, (1 << (budget + 1)) - 1, []
    for length, n in zip(lengths, left, strict=True):
        n, times = min(n, budget // length if length else 0), 1
        while n > 0 and not reached >> budget & 1:
            times = min(times, n)
            new = (reached << (length * times)) & full & ~reached
            if new:
                steps.append((new, length, times))
                reached |= new
            n -= times
            times *= 2
    total = at = reached.bit_length() - 1
    taken: dict[int, int] = {}
    for new, length, times in reversed(steps):
        if at > 0 and new >> at & 1:
            taken[length] = taken.get(length, 0) + times
            at -= length * times
    return taken, total


def fit(lengths: list[int], counts: list[int], budget: int, most: int = MOST, knapsack_words: int = KNAPSACK_WORDS) -> dict[int, int]:
    """How many copies of documents of each length to take, at most `most` of each document, so that their words come to `budget` or nearly, and never above."""
    room = {length: most * n for length, n in zip(lengths, counts, strict=True)}
    total = sum(length * n for length, n in room.items())
    if budget >= total:
        return room
    above, upto, words, taken = max(0, budget - knapsack_words), 0, 0, {}
    for length, n in sorted(room.items()):  # in proportion; what rounding leaves is carried on to the next length
        upto += length * n
        taken[length] = min(n, max(0, above * upto // total - words) // length) if length else 0
        words += taken[length] * length
    for length, n in sorted(room.items(), reverse=True):  # only if more is left than the program's reach
        more = min(n - taken[length], max(0, budget - words - 2 * knapsack_words) // length if length else 0)
        taken[length] += more
        words += more * length
    small_first = sorted(room)
    for length, n in knapsack(small_first, [room[x] - taken[x] for x in small_first], budget - words)[0].items():
        taken[length] += n
    return taken


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sources (skey, source, source_size) with target.

    Sources are put in the order of cap over weight. If all before one are at their caps, what is left of the budget over the weights that are left is the level
    that it would get for each unit of weight; those at or below that level are capped, and the level of the first that isn't holds for all the others.
    """
    place = (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")
    weighed = saved(
        global_rank(sources, [F.col("source").isNull(), F.col("source")])
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
    )
    total, all_weight = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    ratio = F.col("cap") / F.col("weight")
    summed = running_sums(weighed, [ratio, F.col("rank")], {"caps": "cap", "weights": "weight"})
    level = (share * total - (F.col("caps") - F.col("cap"))) / (all_weight - (F.col("weights") - F.col("weight")))
    at = summed.select(level.alias("level"), ratio.alias("ratio")).filter("level < ratio").agg(F.max("level")).first()[0]
    free = F.col("cap") if at is None else F.least("cap", F.lit(max(at, 0.0)) * F.col("weight"))
    return weighed.withColumn("target", free).drop("rank", "weight", "cap")


def _planned(by_length: pd.DataFrame, most: int, knapsack_words: int) -> pd.DataFrame:
    size, target = int(by_length["source_size"].iloc[0]), float(by_length["target"].iloc[0])
    lengths, counts = by_length["size"].tolist(), by_length["n"].tolist()
    whole = int((target + 1e-6) // size) if size else 0
    taken = fit(lengths, counts, int(target + 1e-6), most, knapsack_words)
    copies = [whole * n if not length else taken[length] for length, n in zip(lengths, counts, strict=True)]
    return by_length.assign(whole=[c // n for c, n in zip(copies, counts, strict=True)], extra=[c % n for c, n in zip(copies, counts, strict=True)])


def _told_apart(rows: DataFrame) -> DataFrame:
    """Saved `rows` with `copy`: 0, 1, 2 ... for rows of equal doc_id and text, where these are more than one in HOT_SHARE of all rows, else 0.

    Rows are numbered within the stretch of row numbers that one task wrote, on from what earlier stretches hold, so no task orders such a group as a whole.
    """
    same, total = ["doc_id", "digest", "size"], rows.count()
    hot = saved(rows.groupBy(*same).agg(F.count("*").alias("n")).filter(F.col("n") * HOT_SHARE > max(total, HOT_SHARE)))
    if hot.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    match = lambda a, b: reduce(and_, [a[c].eqNullSafe(b[c]) for c in same])
    names = F.broadcast(hot.select(*same, F.monotonically_increasing_id().alias("group")))  # fewer than HOT_SHARE
    marked = rows.join(names, match(rows, names), "left").select(*[rows[c] for c in rows.columns], "group", F.shiftright(rows["row"], 33).alias("stretch"))
    held = marked.filter("group IS NOT NULL").groupBy("group", "stretch").agg(F.count("*").alias("n"))
    before = held.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("group").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = marked.filter("group IS NOT NULL").withColumn("at", F.row_number().over(Window.partitionBy("group", "stretch").orderBy("row")) - 1)
    numbered = inside.join(before, ["group", "stretch"]).withColumn("copy", F.col("before") + F.col("at"))
    return marked.filter("group IS NULL").withColumn("copy", F.lit(0).cast("long")).select(*rows.columns, "copy").unionByName(numbered.select(*rows.columns, "copy"))


def drawn(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED, knapsack_words: int = KNAPSACK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, digest (a hash of its text), source_size, target, copies."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = saved(
        docs.select(
            F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string"))).alias("skey"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    rows = _told_apart(rows).withColumn("h", F.xxhash64("doc_id", "digest", "copy", F.lit(seed))).withColumn("part", F.pmod(F.col("h"), F.lit(PARTS)).cast("int"))
    parts = saved(rows.groupBy("skey", "source", "size", "part").agg(F.count("*").alias("n")))
    by_length = parts.groupBy("skey", "source", "size").agg(F.sum("n").alias("n"))
    sources = saved(by_length.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    aimed = by_length.join(targets(sources, weights, share, most).drop("source"), "skey").drop("source")
    schema = "skey string, size long, n long, source_size long, target double, whole int, extra long"
    plan = aimed.select("skey", "size", "n", "source_size", "target").groupBy("skey").applyInPandas(lambda f: _planned(f, most, knapsack_words), schema)
    earlier = Window.partitionBy("skey", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    quota = parts.drop("source").join(plan.drop("n"), ["skey", "size"]).withColumn("quota", F.greatest(F.lit(0), F.least("n", F.col("extra") - before))).drop("n", "extra")
    order = Window.partitionBy("skey", "size", "part").orderBy("h", "doc_id", "digest")
    placed = rows.drop("source").withColumn("at", F.row_number().over(order)).join(quota, ["skey", "size", "part"])
    return placed.select("doc_id", "size", "digest", "source_size", "target", (F.col("whole") + (F.col("at") <= F.col("quota")).cast("int")).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    return drawn(docs, **options).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """`docs` with each row as often as the mix takes it; the columns stay, whatever their names. Rows of equal doc_id and text share their copies out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = {"missing": F.col("doc_id").isNull(), "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "size": F.regexp_count(text, F.lit(WORD)).cast("long"), "digest": F.xxhash64(text)}
    at = list(key)
    own = drawn(docs, **options).select(key["missing"].alias("missing"), key["id"].alias("id"), "size", "digest", "copies")
    copies = own.groupBy(*at).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    joined = docs.select(F.struct("*").alias("doc"), *[v.alias(k) for k, v in key.items()]).join(copies, at)
    single = joined.filter("rows = 1").select("doc", "copies")
    number = F.row_number().over(Window.partitionBy(*at).orderBy("doc.text")) - 1
    several = joined.filter("rows > 1").select("doc", (F.floor(F.col("copies") / F.col("rows")) + (number < F.col("copies") % F.col("rows")).cast("int")).alias("copies"))
    taken = single.unionByName(several).filter("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
