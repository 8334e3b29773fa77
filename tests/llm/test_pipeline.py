"""The pipeline's stages against what each operator's own rows say, and run()'s rows against a plain version of all stages after the classifier."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.test_near_copies import shingles
from tributary.llm import exact_dedup, mixing, quality_classifier
from tributary.llm.pieces import MODEL_PATH

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(n=240):
    rng = random.Random(6)
    good, bad = ["river", "stone", "garden", "window", "letter", "the", "of", "and"], ["###", "$$$", "BUY!!", "click|", "%%%"]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(good if i % 4 else bad) for _ in range(rng.randint(20, 90)))
        if i % 10 == 3 and i > 20:
            text = out[i - 14][1] + " "  # an exact copy but for white space
        if i % 10 == 7 and i > 20:
            text = out[i - 14][1] + " more"
        out.append((i, text, "en", f"s{i % 3}", len(text)))
    return out + [(n, None, None, None, None), (n + 1, "", "en", "s0", 0)]


def written(spark, tmp_path, rows):
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 4 > 0), 0) for r in rows[:-2]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")


def test_stages_take_effect(spark, tmp_path):
    written(spark, tmp_path, table())
    docs, sf = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = corpus_pipeline.keep_good(spark, docs, sf)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality_classifier.classify(docs, labels).filter("predicted = 1").collect()}
    once = corpus_pipeline.drop_exact_copies(spark, good, sf)
    assert {r.doc_id for r in once.collect()} == {r.doc_id for r in exact_dedup.exact_duplicates(good).filter("kept").collect()}
    apart = corpus_pipeline.drop_near_copies(spark, once, sf)
    assert {r.doc_id for r in apart.collect()} == {d for d, _ in without_near_copies([(r.doc_id, r.text) for r in once.collect()])}
    mixed = corpus_pipeline.mix_sources(spark, apart, sf)
    copies = {r.doc_id: r.taken // r.size for r in mixing.mix(apart).filter("size > 0").collect()}
    assert {r.doc_id: r["count"] for r in mixed.filter(F.length("text") > 0).groupBy("doc_id").count().collect()} == {d: n for d, n in copies.items() if n}
    assert all(x.columns == docs.columns for x in (good, once, apart, mixed))
    assert [name for name, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


def without_exact_copies(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups["".join((t or "").split())].append((-len(t or ""), d, t))
    return [min(g)[1:] for g in groups.values()]


def without_near_copies(rows):
    rows = sorted(rows, key=lambda r: r[0])
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for b in range(len(rows)):
        for a in range(b):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return [row for i, row in enumerate(rows) if root[i] == i]


def test_run_equals_a_plain_version(spark, tmp_path):
    made = table(200)
    written(spark, tmp_path, made)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    good = {r.doc_id for r in quality_classifier.classify(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).filter("predicted = 1").collect()}
    left = without_near_copies(without_exact_copies([(r[0], r[1]) for r in made if r[0] in good]))
    assert 10 < len(left) < len(good) < len(made)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by_id, times = {r[0]: r for r in made}, Counter(r.doc_id for r in out)
    assert set(times) <= {d for d, _ in left} and max(times.values()) <= 2
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    for r in out:
        assert tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) == by_id[r.doc_id]
        assert (r.ids, r.n_pieces, r.decoded) == ((None, 0, None) if r.text is None else (model.encode(r.text), len(r.ids), r.text))
    # words that the mix takes of each source: the largest sum of at most two copies of each document within the target
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in left}
    size = Counter()
    for d, _ in left:
        size[by_id[d][3]] += words[d]
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, free, rest = {}, set(size), 1.5 * sum(size.values())
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in over} if over else share
        rest -= sum(2 * size[s] for s in over)
        free = free - over if over else set()
    for source, aim in target.items():
        sums = {0}
        for d, _ in left:
            if by_id[d][3] == source:
                sums = {s + k * words[d] for s in sums for k in range(3)}
        assert sum(n * words[d] for d, n in times.items() if by_id[d][3] == source) == max(s for s in sums if s <= aim + 1e-6)


def test_run_with_repeated_ids_nulls_and_clashing_columns(spark, tmp_path):
    rows = [(*r, "x", 7) for r in table(60)]
    rows += [rows[5], (rows[5][0], "another text of the river and the stone in the garden", "en", "s0", 1, "x", 7), (None, "a text of the river without an id in the garden", "en", None, 1, "x", 7)]
    spark.createDataFrame(rows, COLUMNS + ", row string, ids int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 4 > 0), 0) for r in rows[:55]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.filter("row = 'x'").count() == out.count() > 0 and out.filter(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0


def test_run_on_an_empty_table(spark, tmp_path):
    written(spark, tmp_path, table(40))
    empty = tmp_path / "empty"
    spark.createDataFrame([], COLUMNS).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
