"""Rows that share text and doc_id, hot keys with wide rows, buckets large by three segments, and an empty shared folder."""

import random
import subprocess
import sys

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm.test_buckets import signed
from tests.llm.test_pipeline import table, written
from tributary.llm import mixing, shared, sharding, simhash
from tributary.plans import lineage

ROWS = 300_000


@pytest.fixture(scope="module")
def twins(spark):
    """Very many rows of one text and no id, and others."""
    same = spark.range(ROWS).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text for all").alias("text"), F.lit("s").alias("source"))
    return same.unionByName(spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"), F.lit("s").alias("source")))


def test_sharding_spreads_rows_of_one_text_without_an_id(twins):
    out = sharding.shard_by_bytes(twins)
    shards = {r.shard: (r.n, r.size, r.low, r.high) for r in out.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()}
    sizes = [v[1] for v in shards.values()]
    assert len(shards) == 16 and max(sizes) <= 1.01 * min(sizes) and all(low == 0 and high == n - 1 for n, _, low, high in shards.values())
    assert out.select("shard", "slot").distinct().count() == ROWS + 1000


def test_cells_of_one_text_without_an_id_are_small(twins):
    rows = twins.select(F.monotonically_increasing_id().alias("row"), "text")
    keyed = rows.select((F.shiftleft(F.lit(5).cast("long"), 42) + F.shiftrightunsigned(F.xxhash64("row"), 44)).alias("key"), F.lit(10).cast("long").alias("size"))
    assert max(n for _, _, n, _ in sharding.cells(keyed, 16)) <= 2 * (ROWS + 1000) // sharding.CELLS_FOR_ROWS


def test_mixing_spreads_rows_of_one_text_without_an_id(spark, twins):
    rows = lineage.saved(twins.select("doc_id", F.lit("=s").alias("skey"), F.lit(4).cast("long").alias("size"), F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row")))
    apart = mixing._told_apart(rows).filter("doc_id IS NULL")
    assert apart.count() == ROWS and apart.agg(F.countDistinct("copy"), F.max("copy")).first()[:] == (ROWS, ROWS - 1)
    parts = [r["count"] for r in apart.groupBy(F.pmod(F.xxhash64("doc_id", "digest", "copy", F.lit(17)), F.lit(mixing.PARTS))).count().collect()]
    assert len(parts) == mixing.PARTS and max(parts) < 2 * ROWS / mixing.PARTS
    one, two = (sorted(((r.doc_id or -1), r.taken, r.n) for r in mixing.mix(d).groupBy("doc_id", "taken").agg(F.count("*").alias("n")).collect()) for d in (twins, twins.repartition(3)))
    assert one == two and sum(t * n for _, t, n in one) == pytest.approx(1.5 * (4 * ROWS + 2000), abs=2)


@pytest.mark.parametrize("most_bytes", [1 << 40, 0])
def test_hot_keys_with_wide_rows(spark, monkeypatch, most_bytes):
    monkeypatch.setattr(shared, "BROADCAST_BYTES", most_bytes)
    left = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = lineage.saved(left.groupBy("k").agg(F.count("*").alias("n")).withColumn("wide", F.transform(F.sequence(F.lit(1), F.lit(50)), lambda x: x * F.col("k"))))
    got = shared.join_many(left, right, ["k"], "n", 5000, size=8 * F.size("wide"))
    assert sorted((r.v, r.k, len(r.wide)) for r in got.collect()) == sorted((i, 0 if i % 3 == 0 else i, 50) for i in range(5000))


def test_buckets_that_two_segments_leave_large(spark):
    """Fingerprints that share two segments are searched by three; every link within them is found."""
    rng = random.Random(8)
    base = [(rng.getrandbits(38) << 26) | (5 << 13) | 77 for _ in range(600)]
    near = []
    for v in base[:120]:
        for b in rng.sample(range(13, 64), rng.randint(1, 4)):
            v ^= 1 << b
        near.append(v)
    values = {*base, *near}
    pairs = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    keys = simhash.keyed(fps, bucket=40)
    assert keys.filter(F.col("key") >= 1 << 45).count() > 0 and keys.filter("block > 0").count() == 0
    found = {r.node % 2**64: r.root for r in simhash.components(simhash.links(fps, bucket=40)).collect()}
    assert all(found[a] == found[b] for a, b in pairs) and set(found) == {v for p in pairs for v in p}


def left_over(spark):
    place, store = lineage._place(spark, lineage.shared_folder(spark))
    return {f.getPath().getName() for f in store.listStatus(place)}


def test_pipeline_leaves_its_result_only(spark, tmp_path):
    written(spark, tmp_path, table(60))
    lineage.saved(spark.range(1))
    before = left_over(spark)
    kept = corpus_pipeline.run(spark, str(tmp_path))
    new = left_over(spark) - before
    assert kept.count() > 0 and sorted(x.split("-")[0] for x in new if "-" in x and x.startswith("pipeline")) == ["pipeline"] and not [x for x in new if x.startswith(("work", "written"))]


def test_pipeline_leaves_nothing_after_an_error(spark, tmp_path, monkeypatch):
    written(spark, tmp_path, table(60))

    def broken(spark, docs, sf_dir):
        lineage.saved(docs)
        shared.written(docs)
        raise RuntimeError("stop")

    lineage.saved(spark.range(1))
    before = {x for x in left_over(spark)}
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[1], ("broken", broken)])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, str(tmp_path))
    assert not [x for x in left_over(spark) - before if x.startswith(("pipeline", "work", "written"))]


def test_an_application_leaves_nothing(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from tributary.llm.shared import saved, written
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
assert saved(spark.range(3)).count() == written(spark.range(3)).count() == 3
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd="/tmp", capture_output=True)
    assert list((tmp_path / "shared").rglob("*.parquet")) == [] and list((tmp_path / "shared").iterdir()) == []


def test_a_worker_keeps_one_thing_at_a_time():
    made = []
    make = lambda name: lambda: made.append(name) or name
    assert [shared.kept(n, make(n)) for n in ("a", "a", "b", "a")] == ["a", "a", "b", "a"] and made == ["a", "b", "a"]
    shared.forget()
    assert shared.kept("a", make("a")) == "a" and made[-1] == "a" and len(made) == 4
    shared.forget()


def test_byte_bounds_hold_for_sessions_with_few_rows_a_batch(spark):
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(n) for n in names]
    try:
        for given, want in ((("100", "64m"), ("100", "32m")), (("10000", "1m"), ("500", "1m")), (("0", "64m"), ("500", "32m"))):
            for n, v in zip(names, given, strict=True):
                spark.conf.set(n, v)
            shared.small_batches(spark)
            assert tuple(spark.conf.get(n) for n in names) == want
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
