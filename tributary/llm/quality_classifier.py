"""Quality classifier: compressed sizes under zstandard dictionaries of good and of bad text.

Method. From the labelled rows that have a document a bounded sample of MAX_FIT_ROWS for each class is drawn by a hash of doc_id and text. Of a sampled text over MAX_FIT_CHARS,
pieces of PIECE_CHARS spread evenly from its beginning to its end are taken instead of the whole, so that labelled texts of any length are learned from. Half of the sample trains two
zstandard dictionaries, one of good and one of bad texts; the other half calibrates. A text is cut into blocks of BLOCK
bytes that together cover all of it, each block is compressed under either dictionary, and the difference of the summed
sizes over the text's size is the raw score. A logistic curve, fitted on the second half and shifted to the share of
good rows among all labels that may be learned from, turns it into a probability.

Defined results. Empty and null texts, having no size to compare, get the share of good rows among the labels. With no labelled
rows or only one class that share (smoothed) is the score of all. Repeated rows get equal scores. Rows whose label is
null are not used to fit. A very long text is compressed block by block. No documents give no rows. Only doc_id and text of the documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import forget, small_batches

#: Bounds of the fit: sampled rows of each class, and code points of a text; of a longer one, pieces are sampled.
MAX_FIT_ROWS = 1500
MAX_FIT_CHARS = 20_000
PIECE_CHARS = 500
DICTIONARY_BYTES = 30_000
SAMPLE_BYTES = 512
BLOCK = 256
CUT = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float


def _sizes(text: bytes, packers: list) -> list[int]:
    return [sum(len(p.compress(text[i : i + BLOCK])) for i in range(0, len(text), BLOCK)) for p in packers]


def _packers(model: Model) -> list:
    make = lambda d: zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False, write_checksum=False)
    return [make(model.good), make(model.bad)]


def raw_scores(texts: list[str | None], packers: list) -> np.ndarray:
    """(bad size - good size) over the size of the text; NaN for empty texts."""
    out = np.full(len(texts), np.nan)
    for i, text in enumerate(texts):
        if text:
            body = text.encode("utf-8", "replace")
            good, bad = _sizes(body, packers)
            out[i] = (bad - good) / len(body)
    return out


def probability(raw: np.ndarray, model: Model) -> np.ndarray:
    z = np.clip(model.slope * np.nan_to_num(raw) + model.offset, -30, 30)
    return np.where(np.isnan(raw), model.prior, 1 / (1 + np.exp(-z)))


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    parts = [b[i : i + SAMPLE_BYTES] for b in (t.encode("utf-8", "replace") for t in texts) for i in range(0, len(b), SAMPLE_BYTES)]
    parts = parts[:: max(1, len(parts) // 20_000)]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, parts)) // 4)), parts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(parts)[:DICTIONARY_BYTES]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a small ridge."""
    scale = np.std(x) or 1.0
    design = np.column_stack([x / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - 1e-2 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(texts: list[str], good: list[int], share: float | None = None) -> Model:
    """share: of good rows among all that may be learned from; that of the sample if not given."""
    prior = (sum(good) + 1) / (len(good) + 2) if share is None else share
    pairs = [(t, y) for t, y in zip(texts, good, strict=True) if t]
    halves = [{c: [t for t, y in pairs if y == c][k::2] for c in (0, 1)} for k in (0, 1)]
    if not all(halves[k][c] for k in (0, 1) for c in (0, 1)):
        return Model(b"", b"", 0.0, float(np.log(prior / (1 - prior))), prior)
    model = Model(_dictionary(halves[0][1]), _dictionary(halves[0][0]), 1.0, 0.0, prior)
    x = raw_scores(halves[1][0] + halves[1][1], _packers(model))
    y = np.array([0] * len(halves[1][0]) + [1] * len(halves[1][1]))
    slope, offset = _logistic(x, y)
    offset += float(np.log(prior / (1 - prior)) - np.log(len(halves[1][1]) / len(halves[1][0])))
    return Model(model.good, model.bad, slope, offset, prior)


def held_out(doc_id: Column | str) -> Column:
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 == 0


def _bounded(text: Column, max_chars: int) -> Column:
    """The text, or pieces of it that together have max_chars code points."""
    pieces = max(1, max_chars // PIECE_CHARS)
    gap = (F.char_length(text) - PIECE_CHARS) / max(1, pieces - 1)
    spread = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring(text, F.floor(i * gap).cast("int") + 1, F.lit(PIECE_CHARS)))
    return F.when(F.char_length(text) <= max_chars, text).otherwise(F.array_join(spread, ""))


def fitted(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, max_chars: int = MAX_FIT_CHARS) -> Model:
    """Fit on at most max_rows labelled documents of each class, max_chars of each, none held out."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id")).select("doc_id", F.col("quality").cast("int").alias("quality"))
    n = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    written_of = docs.filter(F.col("text") != "").select("doc_id").distinct()
    there = known.join(written_of, "doc_id", "left_semi")
    texts, sides = docs.select("doc_id", "text").filter(F.col("text") != ""), []
    for v in (0, 1):
        ids = there.filter(F.col("quality") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # a table of known size
        drawn = texts.join(F.broadcast(ids), "doc_id").select("quality", "doc_id", F.xxhash64("doc_id", "text").alias("h"), _bounded(F.col("text"), max_chars).alias("text"))
        sides.append(drawn.orderBy("h", "doc_id", "text").limit(max_rows))
    sample = [(r["text"], r["quality"]) for r in sides[0].unionByName(sides[1]).collect()]
    return fit([t for t, _ in sample], [v for _, v in sample], (n.get(1, 0) + 1) / (sum(n.values()) + 2))


def score_column(model: Model, text: Column | str) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        packers = _packers(model) if model.good else None
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            raw = raw_scores(texts, packers) if packers else np.full(len(texts), np.nan)
            yield pd.Series(probability(raw, model))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    small_batches(docs.sparkSession)
    scored = docs.select("doc_id", score_column(fitted(docs, labels), "text").alias("score"))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """`docs` without the rows that the classifier rejects; the columns stay."""
    small_batches(docs.sparkSession)
    return docs.filter(score_column(fitted(docs, labels), "text") >= cut)
