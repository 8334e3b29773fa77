"""Languages: every one is learned, letters are letters, and held-out accuracy on the driver's table."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tributary.llm import language_id

SMALL = "/root/testdata/sf0.001"


def test_every_language_is_learned(spark):
    made = [(k, f"{chr(0x4E00 + 40 * k + j % 3)}{chr(0x4E01 + 40 * k)} " * 20, f"l{k:03d}") for k in range(205) for j in range(12)]
    rows = [(i, t, lang) for i, (_, t, lang) in enumerate(made)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    learned = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert len(learned) == 205 and all(got[i] == lang for i, _, lang in rows if lang in learned)


def test_only_letters_count(spark):
    texts = ["½ ² ①", "Ⅳ", "42 _ !", "٣", "", None, "ﬁ", "ñ"]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(100 + i, "the river and the stone", "en") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    assert all(got[i] == ("und", 0.0) for i in range(6)) and got[6][0] == got[7][0] == "en"


def test_a_language_of_long_texts_only_is_learned(spark):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(4))
    rows = [(i, " ".join(word("abcdef") for _ in range(40)), "short") for i in range(12)] + [(20 + i, " ".join(word("uvwxyz") for _ in range(9000)), "long") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(r.lang_pred == r.lang for r in language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect())


def test_counts_of_a_very_long_word_equal_a_plain_loop(monkeypatch):
    text = "".join(random.Random(2).choice("abcé") for _ in range(5000))
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "PIECE", 700)
    assert (language_id.counts(text) == whole).all() and whole.sum() == 3 * (len(text) + 2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang_pred <> 'und'")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95


def test_languages_whose_rows_share_one_doc_id(spark):
    rows = [(8, f"{word} {i} {word}{'x' * (i % 7)}", lang) for lang, word in (("de", "straße"), ("en", "river")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert not docs.filter(language_id.held_out("doc_id")).count()
    assert {r.lang_pred for r in language_id.identify(docs).collect()} == {"de", "en"}


def test_a_language_that_the_draw_passes_over(spark, monkeypatch):
    """With one row a language and copies of one text, the hash may be above every limit; the language is learned all the same."""
    monkeypatch.setattr(language_id, "MAX_FIT_TOTAL", 1)
    rows = [(8, f"{chr(0x4E00 + k)}{chr(0x4E01 + k)} {chr(0x4E02 + k)}", f"l{k}") for k in range(0, 400, 10) for _ in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.fitted(docs).languages == sorted({r[2] for r in rows})


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(8, "word", f"l{k}") for k in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language_id.identify(docs)
