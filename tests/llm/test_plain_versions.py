"""Operators against plain Python versions of the same rules, held-out quality, and very long texts."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from tributary.llm import language_id, mixing, quality_classifier, quality_rules, secret_scan, sharding, simhash
from tributary.llm import queries as llm_queries

SMALL = "/root/testdata/sf0.001"


def test_quality_scores_equal_a_plain_loop(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    model = quality_classifier.fitted(docs, labels)
    packer = lambda d: zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False, write_checksum=False)
    good, bad = packer(model.good), packer(model.bad)
    texts = {r.doc_id: r.text for r in docs.collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    right = held = 0
    ranks = []
    for r in quality_classifier.classify(docs, labels).collect():
        body = (texts[r.doc_id] or "").encode()
        if body:
            blocks = [body[i : i + 256] for i in range(0, len(body), 256)]
            raw = sum(len(bad.compress(b)) - len(good.compress(b)) for b in blocks) / len(body)
            assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(model.slope * raw + model.offset, -30, 30))), abs=1e-9)
        else:
            assert r.score == pytest.approx(model.prior)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3)
        if r.held_out and r.doc_id in truth:
            held, right = held + 1, right + (r.predicted == truth[r.doc_id])
            ranks.append((r.score, truth[r.doc_id]))
    pos, neg = [s for s, y in ranks if y == 1], [s for s, y in ranks if y == 0]
    assert held > 30 and right >= 0.9 * held
    assert not neg or sum((p > n) + (p == n) / 2 for p in pos for n in neg) >= 0.95 * len(pos) * len(neg)


def test_shards_are_cut_from_a_plain_sort(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice(["one text", "x" * rng.randint(0, 50), f"t{i}", None])) for i in range(3000)]
    own = ((1 << sharding.TEXT_BITS) - 1) << (sharding.KEY_BITS - sharding.TEXT_BITS)

    def key(doc_id, text):
        body = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)  # Spark passes the seed on for a null
        place = xxhash.xxh64_intdigest(b"place", xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42))
        return ((body >> (64 - sharding.KEY_BITS)) & own) | (place >> (64 - sharding.KEY_BITS + sharding.TEXT_BITS))

    want = sorted(rows, key=lambda r: (key(*r), r[0]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sharding.shard_by_bytes(docs, 7).collect()}
    assert [got[d].shard for d, _ in want] == sorted(r.shard for r in got.values())  # shards are stretches of the order
    slots = defaultdict(int)
    for d, _ in want:
        assert got[d].slot == slots[got[d].shard]
        slots[got[d].shard] += 1
    sizes = Counter()
    for d, t in rows:
        assert got[d].size == len((t or "").encode()) + 1 and got[d].text_crc32 == (None if t is None else zlib.crc32(t.encode()))
        sizes[got[d].shard] += got[d].size
    assert len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 2 * 51 + 0.002 * sum(sizes.values())


def test_predictions_equal_a_plain_nearest_centroid(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fitted(docs)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}

    def grams(text):
        cleaned = "".join(c if c.isalpha() else " " for c in text.lower())
        cleaned = f"   {' '.join(cleaned.split())} "
        p, out = [ord(c) for c in cleaned], Counter()
        for i in range(2, len(p)):
            for value in (p[i] * 2654435761, p[i - 1] * 2654435761 * 31 + p[i] * 1000003, (p[i - 2] * 2654435761 * 31 + p[i - 1] * 1000003) * 131 + p[i] * 97561):
                out[(value % 2**32) >> 19] += 1
        return out

    for r in language_id.identify(docs).collect():
        text = texts[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        v = np.zeros(language_id.DIMENSIONS)
        for k, n in grams(text).items():
            v[k] = np.log1p(n) * model.idf[k]
        cosines = model.centroids @ (v / np.linalg.norm(v))
        assert r.score == pytest.approx(cosines.max(), abs=1e-4) and r.lang_pred == model.languages[model.owner[int(cosines.argmax())]]


def test_very_long_texts(spark):
    """Megabytes in one word, and in one text: each operator gives one row for it."""
    word, text = "q" * 3_000_000, "the stone of the river " * 60_000
    docs = spark.createDataFrame([(1, word, "en", "a"), (2, text, "en", "b"), (3, "a short text of the river", "en", "a")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    rules = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert (rules[1].n_words, rules[1].word_chars) == (1, 3_000_000) and rules[2].n_words == rules[2].n_repeat_words == 300_000
    assert {r.doc_id: r.size for r in mixing.mix(docs).collect()} == {1: 1, 2: 300_000, 3: 6}
    assert {r.doc_id: r.size for r in sharding.shard_by_bytes(docs, 2).collect()} == {1: 3_000_001, 2: len(text) + 1, 3: 26}
    assert {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}[1] == f"{xxhash.xxh64_intdigest(word.encode(), 42):016x}"
    assert language_id.identify(docs).count() == quality_classifier.classify(docs, labels).count() == 3
    assert secret_scan.scan(docs).count() == 0


def test_plans_of_native_operators_hold_no_python(spark, monkeypatch):
    """The plans below a checkpoint, too: each one that a native operator saves is looked at."""
    seen = []
    plain = type(spark.range(1)).checkpoint

    def looked_at(df, *a, **k):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *a, **k)

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", looked_at)
    for name in ("op3_quality_rules", "op6_secret_scan", "op7_sharding"):
        seen.append(llm_queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString())
    assert len(seen) >= 5 and not [p for p in seen if any(x in p for x in ("Python", "Pandas", "Arrow"))]


def test_columns_of_clashing_names_stay(spark):
    from tributary.llm import exact_dedup, near_copies, sentencepiece_codec

    names = ["doc_id", "text", "source", "row", "root", "doc", "n", "others", "made", "repeats", "missing", "__size", "__own", "label"]
    docs = spark.createDataFrame([(i, f"text {i // 2} of the river", "s", *([7] * 11)) for i in range(6)], "doc_id long, text string, source string, " + ", ".join(f"{c} int" for c in names[3:]))
    for keep in (exact_dedup.drop_duplicates, near_copies.drop_near_copies, simhash.drop_near_duplicates, mixing.mixed):
        out = keep(docs)
        assert out.columns == names and out.filter(F.col("row") + F.col("__size") + F.col("n") != 21).count() == 0
    out = sentencepiece_codec.encode_documents(docs)
    assert out.columns == [*names, "ids", "n_pieces", "decoded"]
