"""Tries as owners: shared prefixes, spills by subtree, ids at the edge, repeated rows, one reading of the table."""

import hashlib
import random
from collections import Counter, defaultdict

from tributary.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups["".join((text or "").split())].append((-len(text or ""), doc_id is None, doc_id or 0))
    return Counter(
        (d, (None if min(g)[1] else min(g)[2]), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for d in [None if none else i for _, none, i in g]
    ), len(groups)


def rows_of_one_length(n=400):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(9)) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(n + i, f"{t[:4]} {t[4:]}") for i, t in enumerate(texts[:50])]


def test_forks_and_shared_prefixes():
    trie = exact_dedup.PatriciaTrie()
    rows = rows_of_one_length()
    for i, t in rows:
        trie.add(t.replace(" ", "").encode(), (-len(t), False, i, i), 1)
    distinct = {t.replace(" ", "") for _, t in rows}
    assert trie.ends == len(distinct) > 100 and trie.forks > 50
    assert trie.held < sum(map(len, distinct)) + exact_dedup.NODE_BYTES * (2 * len(distinct))


def test_a_spilled_subtree_takes_its_later_keys_along():
    rng, trie, away = random.Random(4), exact_dedup.PatriciaTrie(), []
    keys = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 8))) for _ in range(900)]
    for i, k in enumerate(keys):
        if not trie.add(k, (0, False, i, i), 1):
            away.append((k, 1))
        if i in (300, 600):
            away += [(key, n) for key, _, n, _ in trie.spilled(True)]
    stayed = {k: n for k, _, n in trie.terminals()}
    assert away and stayed and not {k for k, _ in away} & set(stayed)
    total = Counter(stayed)
    for k, n in away:
        total[k] += n
    assert total == Counter(keys)


def test_spills_change_no_row(spark):
    rows = rows_of_one_length() + [(None, "abab"), (None, "abab"), (2**63 - 1, "only one"), (7, "x y"), (7, "x y"), (7, "xy"), (8, None), (9, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, groups = expected(rows)
    for budget, bits in ((64_000_000, 12), (60_000, 0), (3000, 0), (3000, 12)):
        got = exact_dedup.exact_duplicates(docs, budget, bits).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == groups
    # with one bucket for each length and a small budget rows do spill
    batches = [exact_dedup.pd.DataFrame([(1, 9, 0, t.encode(), 9, hashlib.sha256(t.encode()).digest(), 9, False, i, i, 1) for i, t in rows[:400]], columns=exact_dedup._COLUMNS)]
    kinds = Counter(k for f in exact_dedup._owned(iter(batches), 60_000, 12) for k in f["kind"])
    assert kinds[1] and kinds[2]


def test_one_reading_and_the_kept_rows(spark, tmp_path):
    rows = rows_of_one_length(80) + [(3, "twice"), (3, "twice"), (None, "none"), (None, "none"), (5, None)]
    spark.createDataFrame([(i, t, i, "s") for i, t in rows], "doc_id long, text string, sha long, row string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = exact_dedup.drop_duplicates(docs)
    _, groups = expected(rows)
    assert kept.columns == docs.columns and kept.count() == groups
    stays = Counter((r.doc_id, r.text_sha256) for r in exact_dedup.exact_duplicates(docs).filter("kept").collect())
    assert Counter((r.doc_id, hashlib.sha256("".join((r.text or "").split()).encode()).hexdigest()) for r in kept.collect()) == stays
    assert exact_dedup._hashed(docs).mapInPandas(lambda it: it, exact_dedup._hashed(docs).schema)._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_very_long_texts(spark):
    long = "ab" * 2_000_000
    docs = spark.createDataFrame([(1, long), (2, long + " "), (3, long[:-1] + "c")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs, 1_000_000).collect()}
    assert got == {1: (2, 2), 2: (2, 2), 3: (3, 1)}
