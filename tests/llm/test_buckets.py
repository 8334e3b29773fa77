"""SimHash buckets: one segment value that very many fingerprints share, blocks, and one row of a component however ids clash."""

import random

import pytest
from pyspark.sql import functions as F

from tributary.llm import simhash


def signed(v):
    return v - 2**64 if v >> 63 else v


def hot_fingerprints(n, seed=3):
    """Distinct fingerprints with one value in their first segment, some of them a few bits from another."""
    rng = random.Random(seed)
    out = [(rng.getrandbits(51) << 13) | 77 for _ in range(n - n // 20)]
    near = []
    for v in out[: n // 20]:
        for b in rng.sample(range(13, 64), rng.randint(1, 4)):
            v ^= 1 << b
        near.append(v)
    return out, near


@pytest.mark.parametrize("two_segments, bucket", [(None, 40), (False, 40), (True, 25)])
def test_links_are_whole_whatever_the_keys(spark, two_segments, bucket):
    some, near = hot_fingerprints(500)
    values = set(some) | set(near)
    pairs = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = {r.node % 2**64: r.root for r in simhash.components(simhash.links(fps, two_segments=two_segments, bucket=bucket)).collect()}
    assert pairs and all(found[a] == found[b] for a, b in pairs)
    assert set(found) == {v for p in pairs for v in p}


def test_one_segment_value_of_100_000_fingerprints(spark):
    some, near = hot_fingerprints(100_000)
    fps = spark.createDataFrame([(signed(v),) for v in {*some, *near}], "fp long").repartition(4)
    sizes = simhash.keyed(fps).groupBy("start", "key", "block").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * simhash.BUCKET
    found = {r.node % 2**64: r.root for r in simhash.components(simhash.links(fps)).collect()}
    assert all(found[a] == found[b] for a, b in zip(some, near, strict=False))


def test_one_row_of_a_component_stays_by_row(spark):
    base = " ".join(f"w{k}" for k in range(80))
    rows = [(5, base), (6, base + " "), (6, "quite another text of its own kind"), (None, base), (None, "none at all here"), (None, "none at all here"), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int, root string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or -1), r.text or "") for r in kept.collect())
    assert got == [(-1, "none at all here"), (5, base), (6, "quite another text of its own kind"), (7, "")]
