"""Near copies of texts: SimHash links first, MinHash buckets for what fingerprints cannot reach, each pair checked exactly.

Method. Two texts are near copies if the sets of their SHINGLE-word shingles have a Jaccard similarity of LEAST or more. At 0.8
some ten of 64 fingerprint bits differ, with a wide spread, so no radius that can be dealt out finds all of them. Rows of equal
sets are made one first. SimHash links (tributary.llm.simhash, by its pigeonring search) propose pairs, and so do BANDS bands of BAND_ROWS
MinHash values: a pair of similarity 0.8 shares no bucket with a probability of (1 - 0.8^4)^30, about 1 in 7 million. Buckets with the same members count once.

Dense groups are joined early: each row is checked against one row, the first of those that come first in its buckets. Only buckets that then still hold
several components are searched, in tasks: rows come with their shingle sets, and a member is compared with those that its component
hasn't reached yet, by MinHash agreement first (pairs at 0.8 fall short of it once in some 3 million), then exactly. Only links leave a task, never
all pairs; a bucket over BUCKET rows is cut into blocks, and each pair of blocks is searched by itself.

Defined results. Words are as in op4: ASCII is lower-cased, white space divides. Fewer than SHINGLE words make one shingle,
and all texts without words, null ones included, are equal. Components are transitive. Of each component exactly one row stays: the one with
the smallest doc_id, null ones last, then by the SHA-256 of its text. Only doc_id and text are read; the columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest, xxh128_digest

from tributary.llm import simhash
from tributary.llm.shared import few, forget, join_many, one_of_each, saved, small_batches, written

SHINGLE = 5
#: The least Jaccard similarity, as a fraction.
LEAST = (4, 5)
BANDS, BAND_ROWS, SEED = 30, 4, 7
#: MinHash values of BANDS * BAND_ROWS that must agree before two sets are compared: five deviations below 0.8.
AGREE = 74
#: Rows that are searched as one bucket.
BUCKET = 2000
_DRAWN = np.random.default_rng(SEED).integers(0, 2**63, size=(2, BANDS * BAND_ROWS, 1), dtype=np.uint64)
_FACTORS, _OFFSETS = _DRAWN[0] * np.uint64(2) + np.uint64(1), _DRAWN[1]


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes of a text's shingles; one, of nothing, if it has no words."""
    found = np.unique(hashes.astype(np.uint64))
    return found if len(found) else np.array([xxh64_intdigest(b"", SEED)], dtype=np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The MinHash values of a shingle set."""
    least = np.full(len(_FACTORS), 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(hashes), 2048):
        least = np.minimum(least, (_FACTORS * hashes[i : i + 2048] + _OFFSETS).min(axis=1))
    return least


def bands(hashes: np.ndarray) -> list[int]:
    """The bucket of a shingle set in each band, as a signed number."""
    least = sketch(hashes)
    values = np.array([xxh64_intdigest(least[k * BAND_ROWS : (k + 1) * BAND_ROWS].tobytes(), k) for k in range(BANDS)], dtype=np.uint64)
    return values.view(np.int64).tolist()


def _strings(batch: pd.Series) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in batch]


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the saved, distinct pairs a, b whose sets are similar enough. b may repeat in very many pairs."""
    often = pairs.groupBy("b").agg(F.count("*").alias("n"))
    of_b = saved(often.join(sets.select(F.col("row").alias("b"), F.col("hashes").alias("hashes_b")), "b"))
    both = join_many(pairs, of_b, ["b"], "n", pairs.count(), size=8 * F.size("hashes_b")).join(sets.select(F.col("row").alias("a"), F.col("hashes").alias("hashes_a")), "a")
    common = F.size(F.array_intersect("hashes_a", "hashes_b"))
    return written(both.filter(common * LEAST[1] >= (F.size("hashes_a") + F.size("hashes_b") - common) * LEAST[0]).select("a", "b"))


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted sets have the least similarity."""
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    if len(small) * LEAST[1] < len(large) * LEAST[0]:
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int(np.count_nonzero(large[place] == small))
    return common * LEAST[1] >= (len(one) + len(other) - common) * LEAST[0]


def forest(rows: list[int], roots: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what near copies connect among rows, beyond what their roots connect already."""
    label = np.unique(np.array(roots), return_inverse=True)[1]
    sketches, size = np.array([sketch(s) for s in sets]), np.array([len(s) for s in sets])
    reached, out = np.zeros(len(rows), dtype=bool), []
    for i in range(len(rows)):
        if reached[i]:
            continue
        frontier = np.flatnonzero(label == label[i]).tolist()
        reached[frontier] = True
        while frontier:
            j = frontier.pop()
            rest = np.flatnonzero(~reached)
            rest = rest[(size[rest] * LEAST[1] >= size[j] * LEAST[0]) & (size[j] * LEAST[1] >= size[rest] * LEAST[0])]
            rest = rest[(sketches[rest] == sketches[j]).sum(axis=1) >= AGREE]
            for k in rest.tolist():
                if not reached[k] and alike(sets[j], sets[k]):
                    out.append((rows[j], rows[k]))
                    others = np.flatnonzero(label == label[k]).tolist()
                    reached[others] = True
                    frontier += others
    return out


def _searched(live: DataFrame, sets: DataFrame) -> DataFrame:
    """Links a, b of live buckets (value, n, row, root), searched in tasks."""
    blocks = F.ceil(F.col("n") / BUCKET).cast("long")
    own = F.pmod(F.xxhash64("row"), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.least(F.col("own"), j) * F.col("blocks") + F.greatest(F.col("own"), j))
    cut = live.withColumn("blocks", blocks).withColumn("own", own).select("value", F.explode(pairs).alias("block"), "row", "root")
    at = ["value", "block"]
    dealt = cut.join(sets, "row").repartition(*at).sortWithinPartitions(*at, "row")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, ([], [], [])
        for batch in batches:
            out = []
            for value, block, row, root, hashes in zip(*(batch[c].tolist() for c in (*at, "row", "root", "hashes")), strict=True):
                if key != (value, block):
                    out += forest(*held) if key else []
                    key, held = (value, block), ([], [], [])
                for kept, v in zip(held, (row, root, np.sort(np.asarray(hashes, dtype=np.int64).view(np.uint64))), strict=True):
                    kept.append(v)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(forest(*held) if key else [], columns=["a", "b"], dtype="int64")

    return dealt.mapInPandas(found, "a long, b long")


def _simhash_pairs(unique: DataFrame) -> DataFrame:
    """Pairs of rows that SimHash links: each row with the first of its fingerprint, and the first ones of linked fingerprints."""
    first = saved(unique.groupBy("fp").agg(F.min("row").alias("first"), F.count("*").alias("n")))
    same = join_many(unique.select("row", "fp"), first.filter("n > 1"), ["fp"], "n", unique.count(), narrow=True).select(F.col("row").alias("a"), F.col("first").alias("b")).filter("a <> b")
    near = simhash.links(first.select("fp"))
    for end in ("a", "b"):
        near = near.join(first.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_row")), end)
    return same.unionByName(near.select(F.col("a_row").alias("a"), F.col("b_row").alias("b")))


def _drawn(kept: DataFrame, n: int) -> DataFrame:
    """Pairs a, b of each row with the first row of its buckets (value, row), in an order drawn by hash that all buckets share."""
    first = saved(kept.groupBy("value").agg(F.min(F.struct(F.xxhash64("row").alias("h"), F.col("row").alias("b"))).alias("p"), F.count("*").alias("m")))
    met = join_many(kept.select("value", "row"), first, ["value"], "m", n, narrow=True).groupBy("row").agg(F.min("p").alias("p"))
    return met.select(F.col("row").alias("a"), F.col("p.b").alias("b")).filter("a <> b")


def _mixed(state: DataFrame) -> DataFrame:
    """value, n of the buckets that hold several roots; of buckets with the same rows one is kept."""
    members = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"who{k}") for k in (0, 1)]
    mixed = state.groupBy("value").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"), *members).filter("least < most")
    return saved(mixed.groupBy("n", "who0", "who1").agg(F.min("value").alias("value")).select("value", "n"))


def near_copy_components(rows: DataFrame) -> DataFrame:
    """For saved `rows` (row, doc_id, text): row and root of each row that has a near copy."""
    spark = rows.sparkSession
    small_batches(spark)

    @F.pandas_udf("fp long, digest binary, buckets array<long>")
    def marks(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            found = [simhash.shingle_hashes(t, SHINGLE) for t in _strings(batch)]
            fps = np.fromiter(map(simhash.folded, found), dtype=np.uint64, count=len(batch))
            sets = [shingle_set(h) for h in found]
            yield pd.DataFrame({"fp": fps.view(np.int64), "digest": [xxh128_digest(x.tobytes()) for x in sets], "buckets": [bands(x) for x in sets]})

    @F.pandas_udf("array<long>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(simhash.shingle_hashes(t, SHINGLE)).view(np.int64) for t in _strings(batch)])

    marked = written(rows.select("row", marks("text").alias("m")).select("row", "m.*"))
    groups = saved(marked.groupBy("digest").agg(F.min("row").alias("root"), F.count("*").alias("n")).filter("n > 1"))
    copies = written(join_many(marked.select("row", "digest"), groups, ["digest"], "n", marked.count()).select("row", "root"))
    unique = marked.join(few(copies.filter("row <> root").select("row")), "row", "left_anti").drop("digest")
    entries = unique.select("row", F.explode("buckets").alias("value"))  # a band's number is part of the value's hash
    shared = saved(entries.groupBy("value").agg(F.count("*").alias("n")).filter("n > 1"))
    kept = saved(join_many(entries, shared, ["value"], "n", unique.count() * BANDS, narrow=True).select("value", "row"))
    n_kept = kept.count()
    pairs = saved(_drawn(kept, n_kept).unionByName(_simhash_pairs(saved(unique.select("row", "fp")))).distinct())
    asked = kept.select("row").union(pairs.select("a")).union(pairs.select("b")).distinct()
    sets = written(rows.join(few(asked), "row", "left_semi").select("row", hashes("text").alias("hashes")))
    edges = _alike(pairs, sets)
    reached = written(simhash.components(edges).select(F.col("node").alias("row"), "root"))
    state = saved(kept.join(reached, "row", "left").withColumn("root", F.coalesce("root", "row")))
    live = saved(join_many(state, _mixed(state), ["value"], "n", n_kept, narrow=True))
    if not live.isEmpty():
        more = written(_searched(live, sets))
        reached = written(simhash.components(edges.unionByName(more)).select(F.col("node").alias("row"), "root"))
    # rows of equal sets follow the one that stood for them
    of_copies = copies.withColumnRenamed("root", "stood").join(reached.withColumnRenamed("row", "stood"), "stood", "left").select("row", F.coalesce("root", "stood").alias("root"))
    alone = reached.join(copies.select("row"), "row", "left_anti")
    return of_copies.unionByName(alone)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each component of near copies."""
    return one_of_each(docs, near_copy_components)
