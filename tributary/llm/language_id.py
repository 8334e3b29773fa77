"""Language identification by nearest centroids of normalised TF-IDF character n-grams.

Method. A text is lower-cased, runs of characters other than letters become one blank, and its 1- to 3-grams are hashed into
DIMENSIONS bins. Bin counts, dampened by a logarithm and weighted by inverse document frequency, are normalised to length 1.
For each language a few centroids are clustered from a bounded sample (spherical k-means); a text gets the language of the
centroid with the largest cosine. Below the REJECT_QUANTILE quantile of the cosines that the winning language's sample texts
have with their own centroid the row is marked as rejected; lang_pred then still names the nearest language.

Every language that has a labelled text with a letter is learned, up to MAX_LANGUAGES, past which an error is raised: with many, fewer rows of each are
sampled, one at least. Rows are drawn by a hash of doc_id and text, so that rows that share one doc_id are drawn one by one; of a language that the draw passes over, the
row with the smallest hash is taken. Texts of any length are sampled whole, as their bin counts are taken in tasks and only these come to
the driver. The model is a table of CENTROIDS x DIMENSIONS numbers (96 kB) for each language.

Defined results. A letter is a character of Unicode category L. A null text, or one without a letter, gets `und` with score 0,
as does every text if there is nothing to learn from. Score is the cosine, from 0 to 1. Ties go to the language first in code
point order. A very long text is counted in pieces of PIECE code points, whose grams overlap, so memory doesn't grow with it.
Repeated rows get equal results; no documents give no rows. Only doc_id and text are read to predict.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import shared_value, small_batches

#: Bounds of the fit: sampled rows of each language, and of all unless there are more languages than that.
MAX_FIT_ROWS = 800
MAX_FIT_TOTAL = 4000
#: The model is 96 kB a language.
MAX_LANGUAGES = 1000
DIMENSIONS = 8192
CENTROIDS = 3
REJECT_QUANTILE = 0.01
#: Code points of a text that are counted at once.
PIECE = 1 << 20
_OTHER = regex.compile(r"\P{L}+")
UNDEFINED = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    centroids: np.ndarray  # (language * CENTROIDS, DIMENSIONS)
    owner: np.ndarray  # language of each centroid
    idf: np.ndarray
    least: np.ndarray  # cosine below which a text of the language is rejected


def _binned(letters: str) -> np.ndarray:
    """Counts of the 1- to 3-grams that end in `letters`, whose first two characters are only looked back to."""
    p = np.frombuffer(letters.encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint32, copy=False)
    one = p * np.uint32(2654435761)
    two = one[:-1] * np.uint32(31) + p[1:] * np.uint32(1000003)
    three = two[:-1] * np.uint32(131) + p[2:] * np.uint32(97561)
    grams = np.concatenate((one[2:], two[1:], three))
    return np.bincount((grams >> np.uint32(19)), minlength=DIMENSIONS)  # the leading 13 bits


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of one whole text; None if it has no letter."""
    cleaned = _OTHER.sub(" ", text.lower()).strip()
    if not cleaned:
        return None
    padded = f"   {cleaned} "
    found = _binned(padded[: PIECE + 2])
    for i in range(PIECE, len(padded) - 2, PIECE):
        found += _binned(padded[i : i + PIECE + 2])
    return found


def vectors(found: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    v = np.log1p(np.array(found, dtype=np.float32)) * idf.astype(np.float32)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from seeds spread by farthest cosine; the same sample gives the same centroids."""
    seeds = [x.mean(axis=0)]
    while len(seeds) < min(k, len(x)):
        near = np.max(x @ np.array([s / (np.linalg.norm(s) or 1) for s in seeds]).T, axis=1)
        seeds.append(x[int(near.argmin())])
    c = np.array([s / (np.linalg.norm(s) or 1) for s in seeds])
    for _ in range(10):
        own = (x @ c.T).argmax(axis=1)
        means = [x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))]
        c = np.array([m / (np.linalg.norm(m) or 1) for m in means])
    return c


def fit(samples: dict[str, list[np.ndarray]]) -> Model:
    """A model from bin counts of sampled texts of each language."""
    names, total = sorted(samples), sum(map(len, samples.values()))
    df = np.zeros(DIMENSIONS)
    for found in samples.values():
        df += np.sum([c > 0 for c in found], axis=0)
    idf = np.log((1 + total) / (1 + df)) + 0.1
    centroids, owner, least = [np.zeros((0, DIMENSIONS), dtype=np.float32)], [], []
    for j, name in enumerate(names):
        x = vectors(samples[name], idf)
        own = _clusters(x, CENTROIDS)
        centroids.append(own.astype(np.float32))
        owner += [j] * len(own)
        least.append(np.quantile((x @ own.T).max(axis=1), REJECT_QUANTILE))
    return Model(names, np.vstack(centroids), np.array(owner, dtype=int), idf, np.array(least))


def predict(texts: list[str | None], model: Model) -> tuple[list[str], list[float], list[bool]]:
    found = [counts(t) if isinstance(t, str) and model.languages else None for t in texts]
    lang, score, rejected = [UNDEFINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
    if rows := [i for i, c in enumerate(found) if c is not None]:
        cosines = vectors([found[i] for i in rows], model.idf) @ model.centroids.T
        best = cosines.argmax(axis=1)
        for i, k, value in zip(rows, best, cosines[np.arange(len(rows)), best], strict=True):
            j = int(model.owner[k])
            lang[i], score[i], rejected[i] = model.languages[j], float(np.clip(value, 0, 1)), bool(value < model.least[j])
    return lang, score, rejected


def held_out(doc_id: Column | str) -> Column:
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 == 1


def fitted(docs: DataFrame, max_rows: int = MAX_FIT_ROWS, max_total: int = MAX_FIT_TOTAL) -> Model:
    """Fit on at most max_rows documents of each language and max_total of all (or one of each language), none held out."""
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out("doc_id") & F.col("text").rlike(r"\p{L}"))
    n = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(n) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not n:
        return fit({})
    rows = max(1, min(max_rows, max_total // len(n)))
    # a hash limit for each language, above what is needed, picks the sample in one reading of the texts
    top = 2**63 - 1
    limits = docs.sparkSession.createDataFrame([(lang, min(top, int((1.2 * rows + 20) / count * top))) for lang, count in n.items()], "lang string, below long")
    place = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(top))

    @F.pandas_udf("bins binary, amounts binary")
    def binned(batch: pd.Series) -> pd.DataFrame:
        made = [counts(t) for t in batch]
        bins = [np.flatnonzero(c) if c is not None else np.zeros(0, dtype=int) for c in made]
        amounts = [c[b].astype(np.uint32).tobytes() if c is not None else b"" for c, b in zip(made, bins, strict=True)]
        return pd.DataFrame({"bins": [b.astype(np.uint16).tobytes() for b in bins], "amounts": amounts})

    order = [F.col("place") / F.col("below"), F.col("place"), F.col("doc_id"), F.col("digest")]  # languages keep an even pace
    picked = known.join(F.broadcast(limits), "lang").withColumn("place", place).filter("place <= below").withColumn("digest", F.xxhash64("text"))
    found = picked.select("lang", "doc_id", "place", "below", "digest", binned("text").alias("c")).orderBy(*order).limit(3 * rows * len(n)).select("lang", "c.*").collect()
    if passed_over := sorted(set(n) - {r["lang"] for r in found}):
        first = known.filter(F.col("lang").isin(passed_over)).groupBy("lang").agg(F.min_by("text", F.struct(place, "doc_id")).alias("text"))
        found += first.select("lang", binned("text").alias("c")).select("lang", "c.*").collect()
    samples: dict[str, list[np.ndarray]] = defaultdict(list)
    for r in found:
        if r["bins"] and len(samples[r["lang"]]) < rows:
            row = np.zeros(DIMENSIONS, dtype=np.float32)
            row[np.frombuffer(r["bins"], dtype=np.uint16)] = np.frombuffer(r["amounts"], dtype=np.uint32)
            samples[r["lang"]].append(row)
    return fit({lang: some for lang, some in samples.items() if some})


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    spark = docs.sparkSession
    small_batches(spark)
    fit_once = shared_value(spark, fitted(docs))  # CENTROIDS rows of DIMENSIONS numbers for each language

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = fit_once()
        for batch in batches:  # few texts at once, as a row of bins takes 64 kB
            parts = [predict(batch.iloc[i : i + 64].tolist(), model) for i in range(0, len(batch), 64)]
            yield pd.DataFrame({name: [v for p in parts for v in p[k]] for k, name in enumerate(("lang_pred", "score", "rejected"))})

    return docs.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), guess("text").alias("g")).select("doc_id", "held_out", "g.*")
