"""The filter audit, periodic runs and license scans against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.test_oracle import TABLES, rows
from tributary.llm import filter_audit, license_scan, periodic_runs, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DOCS)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_license_scan"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


# ---- filter audit


def plain_mask(text, doc_id, smallest):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)), doc_id is not None and doc_id > smallest.get(text, doc_id)]
    return {x for x, f in zip("ABCDE", fails, strict=True) if f}


def plain_audit(docs, labels):
    smallest: dict[str, int] = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(smallest.get(text or "", i), i)
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    masks = [(lang or "", plain_mask(text, i, smallest), i in good, i in toxic) for i, text, lang in docs]
    out = {}
    for part in {m[0] for m in masks}:
        own, shapley = [m for m in masks if m[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, x in enumerate(order):
                early = set(order[:step])
                here = [m for m in own if x in m[1] and not m[1] & early]
                shapley[x] += len(here)
                out[part, "".join(order), step + 1] = [sum(not m[1] & (early | {x}) for m in own), len(here), sum(x in m[1] and bool(m[1] & early) for m in own), sum(m[1] == {x} for m in own), sum(m[2] for m in here), sum(m[3] for m in here)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[k] for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def test_audit_equals_plain(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    long_ok = " ".join(words[:150])
    texts = [None, "", "  \t ", "SHOUT", "a#b", long_ok, long_ok + " AND | MORE", " ".join(words[:20] * 10), "É" * 5000, *[" ".join(rng.choices(words, k=rng.randint(50, 200))) for _ in range(20)]]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 40, 2)] * 2 + [(None, 1, 1)]
    d = spark.createDataFrame([(i, t, lang, 1, "x") for i, t, lang in docs], "doc_id long, text string, lang string, mask int, part string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audited(filter_audit.audit(d, known)) == plain_audit(docs, labels)
    assert filter_audit.audit(d.limit(0), known).count() == 0


def test_packed_fields_do_not_carry():
    numbers = filter_audit.packed_outcomes("ABC")
    n = (1 << 63) - 1
    total = filter_audit.unpacked((n * numbers[0b00111]).to_bytes(filter_audit._width("ABC"), "little"), "ABC")
    assert set(total[1][:, 0].tolist()) == {n} and set(total[2][:, 1:].ravel().tolist()) == {n} and not total[0].any()


def test_audit_with_more_parts_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "MAX_PARTS_HELD", 3)
    d = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), (F.col("id") % 40).cast("string").alias("lang"))
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    last = filter_audit.audit(d, known).filter("filter_order = 'BCDEA' AND step = 4").collect()
    assert len(last) == 40 and all(r["kept"] + r["removed"] <= 10 for r in last) and sum(r["kept"] for r in last) == 1


# ---- periodic runs


def plain_runs(w):
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(w)
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in dropped)))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 5)):
            k = rng.choice([1, 2, 2, 3, 5])
            w = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
            p, at = rng.randint(1, 8), rng.randint(0, len(w))
            texts.append([str(x) for x in w[:at] + (w[:p] * 20)[: rng.randint(0, 60)] + w[:5]])
        assert periodic_runs.runs_of(texts) == [plain_runs(w) for w in texts]


def test_runs_query_equals_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 6000")
    got = {tuple(r) for r in queries.periodic_runs.runs_with_planted(docs).collect()}
    want = {plain_row(r["doc_id"], r["text"]) for r in docs.collect()}
    assert got == want and any(r[1] > 0 for r in want)


def test_runs_of_odd_texts(spark):
    pairs = [(None, "a b " * 9), (1, None), (2, ""), (3, " \n"), (3, " \n"), (4, "x y z " * 5 + "x y x y x y x y"), (5, "Ä ß " * 8), (5, "q " * 300_000)]
    d = docs_of(spark, pairs).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("no"))
    got = sorted((tuple(r) for r in periodic_runs.runs_with_planted(d).collect()), key=str)
    short = [plain_row(i, t) for i, t in pairs if len(t or "") < 1000]
    assert [r for r in got if r[1] == 0 or r[3] < 1000] == sorted(short, key=str)
    assert periodic_runs.find_runs(d).filter("length > 1000").collect() == [(5, 0, 300_000, 1)]
    assert periodic_runs.collapse_runs(docs_of(spark, [(1, "so so so so so so it is")])).first()["collapsed"] == "so it is"
    assert periodic_runs.runs_with_planted(d.limit(0)).count() == 0


# ---- license scans


def plain_scan(pairs, templates=license_scan.TEMPLATES, threshold=license_scan.THRESHOLD):
    out = []
    for doc_id, text in pairs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(i, label) for i in range(len(w)) for phrase, label in license_scan.PHRASES.items() if w[i : i + len(phrase.split())] == phrase.split()]
        own, score, b = set(), 1.0 if places else 0.0, 0
        while True:
            held = set(w[b * 32 : b * 32 + 64])
            here = []
            for label, notice, *marks in templates:
                t = set(notice.split())
                if len(t & held) >= threshold * len(t) - 1e-9 and set(" ".join(marks).split()) <= held:
                    here.append((label, t, len(t & held) / len(t)))
            for label, t, containment in here:
                if not any(t < other for _, other, _ in here):
                    own.add(label)
                    score = max(score, containment)
            if b * 32 + 64 >= len(w):
                break
            b += 1
        starts, base = [i for i, _ in places], {x for _, x in places}
        out.append((doc_id, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), score))
    return sorted(out, key=str)


def test_scan_equals_plain(spark):
    rng = random.Random(9)
    filler = ["the", "of", "to", "software", "free", "under", "license", "version", "copy", "bälle", "lorem", "ipsum", "mit", "gpl", "public"]
    made = []
    for i in range(150):
        w = rng.choices(filler, k=rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            notice = rng.choice(license_scan.TEMPLATES)[1].split()
            at = rng.randint(0, len(w))
            w[at:at] = [x for x in notice if rng.random() < 0.9]
        made.append((i, rng.choice([" ", ", ", "-"]).join(w)))
    pairs = [*made, *made[:5], (None, "MIT License. Apache\nLICENSE; the GNU General-Public license"), (None, None), (900, ""), (900, "..."), (901, "Klicense mitİ license"), (902, "MIT license " * 20_000)]
    d = docs_of(spark, pairs).withColumn("row", F.lit(7)).withColumn("blocks", F.lit("x")).withColumn("label", F.lit(1))
    got = sorted((tuple(r) for r in license_scan.scan(d).collect()), key=str)
    assert got == plain_scan(pairs)
    assert license_scan.scan(d.limit(0)).count() == 0


def test_blocks_of_licenses(spark):
    text = " ".join(f"x{k}" for k in range(100)) + " licensed under CC BY-NC 4.0"
    found = license_scan.license_blocks(docs_of(spark, [(1, text), (2, "no license here")])).collect()
    assert [(r["doc_id"], r["first_word"], r["last_word"], r["label"], r["containment"]) for r in found] == [(1, 64, 106, "cc-by-nc", 1.0)]


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError, match="distinct words"):
        license_scan.scan(docs_of(spark, [(1, "x")]), [("long", " ".join(f"w{k}" for k in range(40)))])


@pytest.mark.parametrize(("text", "labels"), [
    ("this work is licensed under the GNU General Public License version 3", "gpl"),
    ("this work is licensed under the GNU Lesser General Public License version 3", "gpl,lgpl"),
    ("this work is licensed under the GNU Affero General Public License", "agpl,gpl"),
    ("released as a draft; licensed under the Apache License version 2.0", "apache"),
    ("released under the license of the town", ""),
    ("released under the MIT license", "mit"),
    ("licensed under CC BY 4.0", ""),
    ("licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("a license to the public, under general terms of version 3", ""),
])
def test_notices_of_one_family_are_told_apart(spark, text, labels):
    filler = " ".join(f"x{k}" for k in range(50))
    assert license_scan.scan(docs_of(spark, [(1, f"{filler} {text} {filler}")])).first()["labels"] == labels


def test_pairs_are_every_block_over_the_threshold(spark):
    """The join itself, before marks and wider templates have their say."""
    text = "this work is licensed under the gnu general public license"
    read, index = license_scan._joined(docs_of(spark, [(1, text)]), license_scan.TEMPLATES, license_scan.THRESHOLD, {})
    held = set(text.split())
    want = {(k, len(set(n.split()) & held) / len(set(n.split()))) for k, (_, n, _) in enumerate(license_scan.TEMPLATES)}
    assert {(r["template"], r["containment"]) for r in license_scan.similar_blocks(read, index).collect()} == {(k, c) for k, c in want if c >= 0.8 - 1e-9}
    with pytest.raises(ValueError, match="mark"):
        license_scan.template_sets([("a", "b c", "d")])
