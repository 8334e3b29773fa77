"""The quality classifier learns from labelled texts of any length, and from rows that share a doc_id."""

import random

from tributary.llm import quality_classifier


def _texts(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_long_bad_texts_only(spark):
    rng = random.Random(4)
    good, bad = ["river", "stone", "meadow", "harbour", "walking", "quietly"], ["BUY", "NOW!!!", "$$$", "free-pills", "click", ">>>"]
    rows = [(i, _texts(rng, bad if i % 2 else good, 6000 if i % 2 else 80)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    model = quality_classifier.fitted(docs, labels)
    assert model.good and model.bad
    scores = {r.doc_id: r.score for r in quality_classifier.classify(docs, labels).collect()}
    assert min(scores[i] for i in range(0, 300, 2)) > max(scores[i] for i in range(1, 300, 2))


def test_pieces_cover_a_long_text_from_end_to_end(spark):
    text = "".join(chr(0x100 + k // 1000) for k in range(100_000))
    row = spark.createDataFrame([(text,)], "text string")
    piece = row.select(quality_classifier._bounded(row["text"], 20_000).alias("t")).first()["t"]
    assert len(piece) == 20_000 and piece[0] == text[0] and piece[-1] == text[-1] and len(set(piece)) >= 40
    assert row.select(quality_classifier._bounded(row["text"], 100_000).alias("t")).first()["t"] == text


def test_labels_without_documents_and_a_shared_doc_id(spark):
    rng = random.Random(5)
    good, bad = ["river", "stone", "meadow"], ["BUY", "NOW!!!", "$$$"]
    shared = 1
    rows = [(shared, _texts(rng, bad, 60)) for _ in range(3000)] + [(1000 + i, _texts(rng, good, 60)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = [(i, 1) for i in range(1000, 1050)] + [(shared, 0)] + [(10_000 + i, i % 2) for i in range(8000)]
    model = quality_classifier.fitted(docs, spark.createDataFrame(ids, "doc_id long, quality int"), max_rows=40)
    assert model.good and model.bad
