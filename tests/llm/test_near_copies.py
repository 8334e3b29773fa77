"""The pipeline's near-dedup stage against brute force over all pairs."""

import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def kept_by_brute_force(texts):
    """One text of each component of pairs with Jaccard 0.8 or more: the first, as ids rise with the place."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return {i for i, r in enumerate(root) if i == r}


def edited(rng, words, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"edit{rng.randint(0, 10**9)}"
    return words


def test_stage_reaches_jaccard_08(spark):
    rng = random.Random(12)
    made = []
    for _ in range(40):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(100, 300))]
        made += [base, *(edited(rng, base, max(1, round(len(base) * share))) for share in (0.01, 0.02, 0.025, 0.04))]
    crowd = [f"c{k}" for k in range(200)]
    made += [edited(rng, crowd, 2) for _ in range(150)]  # a dense group
    texts = [" ".join(w) for w in made] + [None, "", " \n", "one two", "One  two", "one three"]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)], SCHEMA), "")
    want = kept_by_brute_force(texts)
    assert sorted(r.doc_id for r in got.collect()) == sorted(want) and len(want) < len(texts) / 2


def test_stage_keeps_one_row_of_a_component(spark):
    words = [f"w{k}" for k in range(100)]
    near, other = " ".join([*words[:-1], "end"]), " ".join(f"v{k}" for k in range(100))
    rows = [(None, " ".join(words)), (None, near), (4, other), (4, f"{other} more"), (4, near), (4, near), (None, "alone")]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows], SCHEMA), "").collect()
    assert sorted((r.doc_id or 0, len(r.text.split())) for r in got)[0] == (0, 1) and len(got) == 3
    assert sum(r.text == near and r.doc_id == 4 for r in got) == 1
