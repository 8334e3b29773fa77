"""SimHash near-duplicates with pigeonring filtering.

Method. The 64 fingerprint bits form a ring of SEGMENTS segments. If two fingerprints differ in at most `most` bits, then
some segment starts a chain in which, for every length l, the first l segments together differ in at most
l * most / SEGMENTS bits (rounded down). Fingerprints are first reduced to distinct ones, then dealt out by
(segment, its value), as a chain's first segment must agree when most < SEGMENTS. Within such a bucket the chain
condition is checked for each longer chain before the full Hamming distance. Buckets are counted first. Where one holds more than
BUCKET fingerprints, its keys take in the second segment of the chain as well: each of its fingerprints is then also sent to the keys
whose second segment differs in one bit, and nothing is lost. Where that doesn't do, keys take in the third segment, too: the second and third may then differ in two bits together,
so each fingerprint is sent to the keys that differ from its own in one bit of the two, and any two within two bits meet. A bucket that is large even so is cut into blocks, and
each pair of blocks is a bucket of its own, so no task holds or searches more than 2 * BUCKET fingerprints at once.

A bucket gives a spanning forest of its links, at most one row for each member, found by a search that compares a member
only with those not reached yet; copies and dense clusters are thus never expanded into pairs. The forests' links are
joined to components by rounds of hooking and contraction, each saved with a checkpoint.

Defined results. Texts without words, null ones included, have the fingerprint zero and are linked like any other.
Fewer than `shingle` words make one shingle. A document without near copies is its own component. Rows that repeat a
doc_id each get a row, by their own text. A component is named by its smallest doc_id that is not null, and is null if it
has none. No documents give no rows. A very long text is folded in parts of 65,536 shingles. Only doc_id and text are read.
drop_near_duplicates keeps one row of each component: the one with the smallest doc_id, null ones last, then by the SHA-256 of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tributary.llm.shared import join_many, one_of_each, saved, small_batches

SEGMENTS = 5
#: First bit and width of each segment of the ring.
RING = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
MOST = 4
SHINGLE = 4
#: Fingerprints that a bucket may hold before its keys get longer or it is cut into blocks.
BUCKET = 8192
#: Up to so many keys of large buckets are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 500_000
SEED = 42


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """A hash of each shingle of one whole text, in order; none without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # on bytes both touch ASCII only
    if not words:
        return np.zeros(0, dtype=">u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=">u8", count=n)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one whole text, as an unsigned number."""
    return folded(shingle_hashes(text, shingle))


def folded(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    n, ones = len(hashes), np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65536):
        part = hashes[i : i + 65536]
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = np.fromiter((fingerprint(t if isinstance(t, str) else None, shingle) for t in batch), dtype=np.uint64, count=len(batch))
            yield pd.Series(values.view(np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of("text").alias("fp"))


def _segment(fp: Column, i: int) -> Column:
    first, width = RING[i % SEGMENTS]
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _first_keys(fps: DataFrame) -> DataFrame:
    """fp, start, key: the bucket of each segment in which a chain may start."""
    keys = [F.struct(F.lit(i).alias("start"), _segment(F.col("fp"), i).alias("key")) for i in range(SEGMENTS)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*")


def _second_keys(rows: DataFrame) -> DataFrame:
    """fp, start, key: keys with the second segment of the chain, and with each of its bits turned."""
    by_start = F.lit(None)
    for i in range(SEGMENTS):
        second, width = _segment(F.col("fp"), i + 1), RING[(i + 1) % SEGMENTS][1]
        longer = (F.shiftleft("key", 13) + (1 << 30)).cast("long")  # apart from keys of one segment
        flips = F.array(*[longer + second.bitwiseXOR(F.lit(flip)) for flip in [0, *(1 << b for b in range(width))]])
        by_start = F.when(F.col("start") == i, flips).otherwise(by_start)
    return rows.select("fp", "start", F.explode(by_start).alias("key"))


def _third_keys(rows: DataFrame) -> DataFrame:
    """fp, start, key: keys with the second and third segments of the chain, and with each of their bits turned."""
    by_start = F.lit(None)
    for i in range(SEGMENTS):
        (first, second, third), widths = (_segment(F.col("fp"), i + k) for k in range(3)), [RING[(i + k) % SEGMENTS][1] for k in range(3)]
        own = (F.shiftleft(first, 26) + F.shiftleft(second, 13) + third + F.lit(1 << 45)).cast("long")  # apart from shorter keys
        flips = [0, *(1 << b for b in range(widths[2])), *(1 << (13 + b) for b in range(widths[1]))]
        by_start = F.when(F.col("start") == i, F.array(*[own.bitwiseXOR(F.lit(flip).cast("long")) for flip in flips])).otherwise(by_start)
    return rows.select("fp", "start", F.explode(by_start).alias("key"))


def _large(rows: DataFrame, bucket: int) -> tuple[DataFrame, bool]:
    """start, key, n of buckets with more than `bucket` rows, and whether there are any."""
    found = saved(rows.groupBy("start", "key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket))
    n = found.count()
    return (F.broadcast(found) if n <= BROADCAST_KEYS else found), n > 0


def keyed(fps: DataFrame, two_segments: bool | None = None, bucket: int = BUCKET) -> DataFrame:
    """fp, start, key, block: the buckets of a fingerprint. two_segments: for all buckets, for none, or (None) for large ones."""
    rows, at = _first_keys(fps), ["start", "key"]
    if two_segments:
        rows = _second_keys(rows)
    elif two_segments is None:
        large, any_large = _large(rows, bucket)
        if any_large:
            longer = _second_keys(rows.join(large.drop("n"), at, "left_semi"))
            rows = rows.join(large.drop("n"), at, "left_anti").select("fp", *at).unionByName(longer)
        else:
            return rows.withColumn("block", F.lit(0).cast("long"))
    large, any_large = _large(rows, bucket)
    if any_large and two_segments is None:
        longest = _third_keys(rows.join(large.drop("n"), at, "left_semi").select("fp", "start").distinct())
        rows = rows.join(large.drop("n"), at, "left_anti").select("fp", *at).unionByName(longest)
        large, any_large = _large(rows, bucket)
    if not any_large:
        return rows.withColumn("block", F.lit(0).cast("long"))
    blocks = F.ceil(F.col("n") / bucket).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cut = rows.join(large, at).withColumn("blocks", blocks).withColumn("own", own)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1), lambda j: F.least(F.col("own"), j) * F.col("blocks") + F.greatest(F.col("own"), j))
    cut = cut.select("fp", *at, F.explode(pairs).alias("block"))
    return rows.join(large.drop("n"), at, "left_anti").select("fp", *at, F.lit(0).cast("long").alias("block")).unionByName(cut)


def _near(one: np.uint64, others: np.ndarray, start: int, most: int) -> np.ndarray:
    """Which others have a chain from `start` within its budgets and so, at full length, a distance of at most `most`."""
    alive, total = np.arange(len(others)), np.zeros(len(others), dtype=np.int64)
    for length in range(1, SEGMENTS + 1):
        first, width = RING[(start + length - 1) % SEGMENTS]
        mask = np.uint64(((1 << width) - 1) << first)
        total = total + np.bitwise_count((others[alive] ^ one) & mask)
        within = total <= length * most // SEGMENTS
        alive, total = alive[within], total[within]
        if not len(alive):
            break
    return alive


def forest(values: np.ndarray, start: int, most: int = MOST) -> list[tuple[int, int]]:
    """Links (member, smallest reached) that connect what near links from `start` connect. values: distinct fingerprints."""
    rest, links = values, []
    while len(rest) > 1:
        root, frontier, rest = rest[0], [rest[0]], rest[1:]
        while frontier and len(rest):
            found = _near(frontier.pop(), rest, start, most)
            if len(found):
                links += [(int(v), int(root)) for v in rest[found]]
                frontier += list(rest[found])
                rest = np.delete(rest, found)
    return links


def links(fps: DataFrame, most: int = MOST, two_segments: bool | None = None, bucket: int = BUCKET) -> DataFrame:
    """Links a, b (signed fingerprints) that connect every pair of `fps` (column fp, distinct) with at most `most` differing bits."""
    if not 0 <= most < SEGMENTS:
        raise ValueError(f"most must lie between 0 and {SEGMENTS - 1}")
    at = ["start", "key", "block"]
    dealt = keyed(fps, two_segments, bucket).repartition(*at).sortWithinPartitions(*at, "fp")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted; a bucket ends where the next begins, across batches."""
        key, held = None, []
        for batch in batches:
            place, fp = np.column_stack([batch[c].to_numpy() for c in at]), batch["fp"].to_numpy()
            cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if key != tuple(place[a]):
                    out += _bucket(key, held, most)
                    key, held = tuple(place[a]), []
                held.append(fp[a:b])
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(_bucket(key, held, most), columns=["a", "b"], dtype="int64")

    return dealt.mapInPandas(found, "a long, b long")


def _bucket(key: tuple | None, held: list[np.ndarray], most: int) -> list[tuple[int, int]]:
    if key is None or sum(map(len, held)) < 2:
        return []
    values = np.unique(np.concatenate(held)).view(np.uint64)
    pairs = forest(values, int(key[0]), most)
    return [tuple(np.array(p, dtype=np.uint64).view(np.int64).tolist()) for p in pairs]


def components(edges: DataFrame) -> DataFrame:
    """node and root for every node of the edges (a, b); nodes share a root exactly when they are connected.

    In each round a node hooks onto the neighbour that comes first in an order drawn anew for the round, if that comes before
    itself; edges are carried over to what their ends hooked onto, and those within one node go. A round removes a constant share of the
    nodes that are left on average, whatever the shape, so rounds grow with the logarithm of the largest component and
    their edges shrink. The rounds' hooks, put together, lead each node to its root.
    """
    edges = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = both(edges).select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    hooks = []
    while not edges.isEmpty():
        order = lambda c, k=len(hooks): F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("to"))
        first = both(edges).groupBy("a").agg(F.min(order("b")).alias("m"))
        hook = saved(first.filter(F.col("m") < order("a")).select(F.col("a").alias("from"), F.col("m.to").alias("to")))
        moved = edges
        for end in ("a", "b"):
            moved = moved.join(hook.withColumnRenamed("from", end), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        edges = saved(moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        hooks.append(hook)
    for hook in hooks:
        nodes = nodes.join(hook.withColumnRenamed("from", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return nodes


def near_duplicates(docs: DataFrame, most: int = MOST, shingle: int = SHINGLE, two_segments: bool | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    marked = saved(fingerprints(docs, shingle))
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    reached = components(links(distinct.select("fp"), most, two_segments))
    rooted = saved(distinct.join(reached, distinct["fp"] == reached["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    named = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members")))
    by_fp = saved(join_many(rooted, named, ["root"], "members", rooted.count()).select("fp", "n", "component_id"))
    out = join_many(marked, by_fp, ["fp"], "n", marked.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, most: int = MOST, shingle: int = SHINGLE) -> DataFrame:
    """`docs` with one row of each component; the columns stay."""

    def reached(rows: DataFrame) -> DataFrame:
        marked = saved(fingerprints(rows.select(F.col("row").alias("doc_id"), "text"), shingle).withColumnRenamed("doc_id", "row"))
        distinct = saved(marked.groupBy("fp").agg(F.count("*").alias("n")))
        found = components(links(distinct.select("fp"), most))
        rooted = saved(distinct.join(found, distinct["fp"] == found["node"], "left").filter("n > 1 OR node IS NOT NULL").select("fp", "n", F.coalesce("root", "fp").alias("root")))
        return join_many(marked, rooted, ["fp"], "n", marked.count()).select("row", "root")

    return one_of_each(docs, reached)
