"""The secret scan's scores from its trees, its candidates from another reading of the table, and its verdicts on findings labelled by hand."""

import re

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tributary.llm import secret_scan

SF = "/root/testdata/sf0.01/documents.parquet"


def test_scores_equal_the_mean_of_the_trees(spark):
    docs = spark.read.parquet(SF)
    words = secret_scan.dictionary(docs)
    found = secret_scan.saved(secret_scan.features(secret_scan.candidates(docs), words))
    model, share = secret_scan.fitted(secret_scan.saved(secret_scan.findings_of(found, words)), secret_scan.SHAPE)
    rows = secret_scan.scored(found, model, share, secret_scan.SHAPE).collect()
    assert len(rows) > 50 and len(model.trees) == secret_scan.TREES
    for r in rows[:: max(1, len(rows) // 60)]:
        v = Vectors.dense([r[c] for c in secret_scan.SHAPE])
        assert r.score == pytest.approx(sum(t.predictProbability(v)[1] for t in model.trees) / len(model.trees))
    got = {(r.doc_id, r.position): r.score for r in secret_scan.scan(docs).collect()}
    assert got == {(r.doc_id, r.position): pytest.approx(r.score, abs=1e-6) for r in rows}


NAME, RUN = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-"), set("!#$%&*+-./0123456789:=?@ABCDEFGHIJKLMNOPQRSTUVWXYZ^_abcdefghijklmnopqrstuvwxyz~\\")
FORMAT = re.compile("|".join(f.replace("eyJ(?<!eyJ[A-Za-z0-9_-]{0,40}eyJ)", "eyJ").replace("}+\\.", "}\\.") for f in secret_scan.FORMATS))


def _value(text, i):
    """The end of the value that begins at i."""
    quote = text[i - 1] if text[i - 1] in "\"'`" else ""
    if quote:
        end = text.find(quote, i)
        if end > i and "\n" not in text[i:end]:
            return end
    end = i
    while end < len(text) and not text[end].isspace() and text[end] not in "\"'`":
        end += 1
    while end > i and text[end - 1] in ".,;)]}":
        end -= 1
    return end


def _assigned(text, i):
    """Where the value begins that is assigned to, or quoted after, the name with a key word that begins at i."""
    end = i
    while end < len(text) and text[end] in NAME:
        end += 1
    if not any(w in text[i:end].lower() for w in secret_scan.KEY_WORDS):
        return None
    if m := re.compile(r"[\"'`]?\s{0,3}[:=]{1,2}>?\s{0,3}(?:(?:bearer|basic)\s{1,3})?[\"'`]?", re.I).match(text, end):
        return m.end()
    m = re.compile(r"\s{1,3}[\"'`]").match(text, end)
    return m.end() if m else None


def plain_candidates(text):
    """What a walk from character to character finds in an ASCII text."""
    out, i = [], 0
    while i < len(text):
        if text[i] in NAME and (i == 0 or text[i - 1] not in NAME):
            begin = _assigned(text, i)
            if begin is None and (m := re.compile(r"bearer\s{1,3}", re.I).match(text, i)):
                begin = m.end()
            if begin is not None and (end := _value(text, begin)) > begin:
                out.append(text[begin:end])
                i = end
                continue
        if m := FORMAT.match(text, i):
            out.append(m.group())
            i = m.end()
            continue
        if text[i] in RUN and (i == 0 or text[i - 1] not in RUN):
            end = i
            while end < len(text) and text[end] in RUN:
                end += 1
            run = text[i:end]
            if len(run) >= secret_scan.LEAST and re.search(r"[0-9!#$%&*+=?@^_~\\]|[A-Za-z][A-Z]", run) and not FORMAT.search(run) and not any(w in run.lower() for w in secret_scan.KEY_WORDS):
                out.append(run)
                i = end
                continue
        i += 1
    return out


def test_candidates_equal_a_walk_over_the_whole_table(spark):
    docs = spark.read.parquet(SF)
    got = {}
    for r in secret_scan.candidates(docs).orderBy("doc_id", "position").collect():
        got.setdefault(r.doc_id, []).append(r.candidate)
    want = {r.doc_id: found for r in docs.collect() if (found := plain_candidates(r.text or ""))}
    assert got == want and sum(map(len, want.values())) > 50


#: Labelled by hand: texts with one candidate at most, none after a key word nor of a provider's format; 1 marks a secret.
FINDINGS = [
    ("use Zk8vQ2xPn4LmT7rBw9Yc to sign in", 1), ("the value 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b is ours", 1), ("paste hX3_q9Lw-77TzPvB2mNd here", 1), ("it was p4XvQz81LmKwTr60Ybn2 then", 1),
    ("log in with 7Gq2ZxWvT9rLk3PmNb5y today", 1), ("send b1946ac92492d2347c6235b4d2611184 along", 1), ("we got Qm4tR8zXv2LpK7wNc1Bs back", 1), ("now 3kD9fLs0Zq7VxN2mTy8Rw5 works", 1),
    ("copy e3b0c44298fc1c149afbf4c8996fb924 over", 1), ("mine is T5vXq9Z2mLr8Kw3PnB7y still", 1),
    ("see https://docs.example.com/guide/start.html first", 0), ("open /usr/local/share/notes/readme.txt now", 0), ("call getUserAccountSettings in there", 0), ("mail first.last@example.com about it", 0),
    ("set max_retry_count_per_host to five", 0), ("version 2024.11.03-stable-release came", 0), ("read chapter-one/section-two/page-three again", 0), ("the file holiday_photos_summer_2019.jpg is old", 0),
    ("a well-known-and-often-quoted-line! it is", 0), ("see www.example.org/archive/2020/index.html there", 0), ("from 2024-01-01T10:00:00 to noon", 0), ("run build/output/release/main.js twice", 0),
]


def test_findings_labelled_by_hand(spark):
    """Half of them teach, the other half is judged, and the other way round; besides, what the rule by context makes of them."""
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(FINDINGS)], "doc_id long, text string, secret int")
    found = secret_scan.candidates(rows).join(rows.select("doc_id", "secret"), "doc_id")
    passed_over = {i for i in range(len(FINDINGS))} - {r.doc_id for r in found.collect()}
    assert len(passed_over) == 4 and not any(FINDINGS[i][1] for i in passed_over)  # runs of letters, dots, slashes and hyphens are no candidates
    corpus = spark.read.parquet(SF).select(F.lit(None).cast("long").alias("doc_id"), "text")
    hit = wrong = missed = 0
    for half in (0, 1):
        judged = rows.filter(F.col("doc_id") % 2 != half).select("doc_id", "text").unionByName(corpus)
        taught = found.filter(F.col("doc_id") % 2 == half).select("candidate", "before", "after", "secret")
        flags = {r.doc_id: r.is_secret for r in secret_scan.scan(judged, taught).filter("doc_id IS NOT NULL").collect()}
        hit += sum(flags[i] and y for i, (_, y) in enumerate(FINDINGS) if i in flags)
        wrong += sum(flags[i] and not y for i, (_, y) in enumerate(FINDINGS) if i in flags)
        missed += sum(not flags[i] and y for i, (_, y) in enumerate(FINDINGS) if i in flags)
    by_context = {r.doc_id: r.is_secret for r in secret_scan.scan(rows.select("doc_id", "text").unionByName(corpus)).filter("doc_id IS NOT NULL").collect()}
    context = [sum(by_context.get(i, False) == flag and y == label for i, (_, y) in enumerate(FINDINGS)) for flag, label in ((True, 1), (True, 0), (False, 1))]
    print(f"taught by hand: precision {hit / max(1, hit + wrong):.2f}, recall {hit / (hit + missed):.2f}; by context: hits {context[0]}, wrong {context[1]}, missed {context[2]} of {len(FINDINGS)}")
    assert hit / max(1, hit + wrong) >= 0.8 and hit / (hit + missed) >= 0.8
