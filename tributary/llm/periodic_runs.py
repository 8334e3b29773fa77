"""Periodic runs of words, by a branching-tandem test on an enhanced suffix array.

Method. The words of several texts are numbered, a word of one text apart from the same word of another, and put in one sequence, whose suffix array (prefix
doubling on the groups that are still mixed), inverse and LCP array are computed with vector operations. For each LCP interval of depth d, nearest smaller
values give its borders and children, without tree nodes. The suffixes i of all children but the largest are asked for ISA[i + d] and ISA[i - d]: if one lies
in the interval, too, but in another child, a square of period d begins at i or i - d and can't be moved to the right. The square is rotated to the left as
far as it goes, and with that merged into the run that it ends. A square whose period is a multiple of a known run's with the same end is that run again.

Only runs of LEAST_EXPONENT periods or more are asked for. Such a run has four suffixes in its interval, so smaller groups aren't sorted further, smaller
intervals aren't looked at, and the membership test is made for two more steps to the left at once. This drops no run.

Defined results. A word is a run of bytes other than space and U+0009 to U+000D. Null, empty and blank texts have no run. Rows are judged one by one, so repeated rows get
equal results, nulls in other columns and columns of any name play no part, no rows give no rows, and there is no exchange: a lost task is run again. A very long text is
one sequence, whose arrays take about 200 bytes a word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import small_batches

LEAST_EXPONENT = 4
LEAST_WORDS = 6
#: Words that are put in one sequence; a longer text has one of its own.
WORDS_AT_ONCE = 1 << 17
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
Run = tuple[int, int, int]


def suffix_order(s: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for each power of two the names of the words from each place on, so many of them.

    Groups of fewer than LEAST_EXPONENT suffixes keep any order and names of their own.
    """
    n = len(s)
    sa = np.argsort(s, kind="stable").astype(np.int64)
    slots, key = np.arange(n), s[sa]
    name, levels, h = np.zeros(n, dtype=np.int64), [], 1
    while len(slots):
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[begins, len(key)])
        group = np.repeat(slots[begins], size)
        mixed = np.repeat(size >= LEAST_EXPONENT, size)
        name[sa[slots]] = np.where(mixed, group, slots)
        if not mixed.any():
            break
        levels.append(name.astype(np.int32))
        slots, group = slots[mixed], group[mixed]
        places = sa[slots]
        after = places + h
        key = group * (n + 1) + np.where(after < n, name[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sa[slots], key, h = places[order], key[order], 2 * h
    return sa, levels


def common_prefixes(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[k] of suffixes sa[k - 1] and sa[k]; lcp[0] and lcp[n] are -1. In groups that aren't sorted, a lower bound."""
    n = len(sa)
    lcp = np.full(n + 1, -1, dtype=np.int64)
    lcp[1:n] = 0
    if levels:
        k = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
        a, b = sa[k - 1].copy(), sa[k].copy()
        for j in range(len(levels) - 1, -1, -1):
            same = (a < n) & (b < n)
            same[same] = levels[j][a[same]] == levels[j][b[same]]
            a[same] += 1 << j
            b[same] += 1 << j
        lcp[k] = b - sa[k]
    return lcp


def nearest(lcp: np.ndarray, at: np.ndarray, step: int, strict: bool) -> np.ndarray:
    """For each place of `at`, the nearest place to the left (step -1) or right (1) with a smaller value, or (not strict) one as small."""
    to = np.arange(len(lcp)) + step
    to[0 if step < 0 else -1] = 0 if step < 0 else len(lcp) - 1
    open_ = at
    while len(open_):
        seen = to[open_]
        high = lcp[seen] >= lcp[open_] if strict else lcp[seen] > lcp[open_]
        open_, seen = open_[high], seen[high]
        to[open_] = to[seen]
    return to[at]


def branching_squares(sa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of the squares that can't be moved to the right and have two more periods before them."""
    n = len(sa)
    none = np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(lcp[:n] > 0)
    if not len(at):
        return none, none
    isa = np.empty(n, dtype=np.int64)
    isa[sa] = np.arange(n)
    # lcp falls to 0 or less at either side of `at`, so that these searches never leave the group of one word
    low, high = nearest(lcp, at, -1, True), nearest(lcp, at, 1, True)
    wide = high - low >= LEAST_EXPONENT
    before, after = nearest(lcp, at, -1, False), nearest(lcp, at, 1, False)
    leading = wide & (before == low)
    # a child to the right of each border, and one to the left of an interval's first border
    begin, end = np.r_[at[wide], low[leading]], np.r_[after[wide], at[leading]]
    depth = np.r_[lcp[at[wide]], lcp[at[leading]]]
    left, right = np.r_[low[wide], low[leading]], np.r_[high[wide], high[leading]]
    if not len(begin):
        return none, none
    order = np.lexsort((end - begin, left * (n + 1) + right))
    interval = (left * (n + 1) + right)[order]
    smaller = order[np.r_[interval[1:] == interval[:-1], False]]
    begin, end, depth, left, right = (x[smaller] for x in (begin, end, depth, left, right))
    size = end - begin
    child = np.repeat(np.arange(len(size)), size)
    i = sa[np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + begin[child]]
    d, lo, hi, b, e = depth[child], left[child], right[child], begin[child], end[child]

    def inside(x: np.ndarray, k: np.ndarray) -> np.ndarray:
        there = (x >= 0) & (x < n)
        place = isa[np.clip(x, 0, n - 1)]
        return there & (place >= lo[k]) & (place < hi[k])

    found = []
    for first, other in ((i, i + d), (i - d, i - d)):
        k = np.arange(len(i))
        k = k[inside(other, k)]
        place = isa[other[k]]
        k = k[(place < b[k]) | (place >= e[k])]
        for back in (1, 2):
            k = k[inside(first[k] - back * d[k], k)]
        found.append((first[k], d[k]))
    starts, periods = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs = np.unique(np.stack((periods, starts), axis=1), axis=0)  # short periods first
    return pairs[:, 1], pairs[:, 0]


def _rotated(s: np.ndarray, start: int, period: int) -> int:
    """The start of the run that the square at `start` ends: words are compared in growing pieces."""
    piece = 64
    while start > 0:
        least = max(0, start - piece)
        other = np.flatnonzero(s[least:start] != s[least + period : start + period])
        if len(other):
            return least + int(other[-1]) + 1
        start, piece = least, 2 * piece
    return start


def runs(s: np.ndarray) -> list[Run]:
    """(start, length, period) of the runs of LEAST_EXPONENT periods or more in a sequence, of any length, by start, then period."""
    n = len(s)
    if n < LEAST_EXPONENT:
        return []
    sa, levels = suffix_order(s)
    starts, periods = branching_squares(sa, common_prefixes(sa, levels))
    found: list[Run] = []
    ending: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, d in zip(starts.tolist(), periods.tolist(), strict=True):
        end = i + 2 * d
        if end < n and s[end] == s[end - d]:  # children of groups that aren't sorted may be one
            continue
        if any(d % p == 0 and first <= i for first, p in ending[end]):
            continue
        first = _rotated(s, i, d)
        ending[end].append((first, d))
        found.append((first, end - first, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _together(words: list[list]) -> list[list[Run]]:
    """Runs of several texts, whose words are put in one sequence."""
    lengths = np.array([len(w) for w in words])
    code = pd.factorize(np.array([x for w in words for x in w], dtype=object))[0].astype(np.int64) if lengths.sum() else np.zeros(0, dtype=np.int64)
    text = np.repeat(np.arange(len(words)), lengths)
    begins = np.cumsum(lengths) - lengths
    out: list[list[Run]] = [[] for _ in words]
    for start, length, period in runs(text * (int(code.max(initial=0)) + 1) + code):
        if length >= LEAST_WORDS:
            k = int(text[start])
            out[k].append((start - int(begins[k]), length, period))
    return out


def runs_of(texts: list[list]) -> list[list[Run]]:
    """For each text, a list of words: its runs of LEAST_WORDS words and LEAST_EXPONENT periods or more."""
    out: list[list[Run]] = []
    held: list[list] = []
    for words in texts:
        if held and sum(map(len, held)) + len(words) > WORDS_AT_ONCE:
            out += _together(held)
            held = []
        held.append(words)
    return out + _together(held)


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words but those that a run contains after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def with_runs(docs: DataFrame, rewrite: Callable[[int, int], np.ndarray | None] | None = None, number: Column | None = None) -> DataFrame:
    """`doc_id, runs (array of start, length, period; by start, then period), collapsed (the kept words, joined by one space)`, one row per document.

    rewrite: from a text's count of words and the row's `number` (null: not rewritten) to the places that its words are taken from, None for as they are.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, numbers in batches:
            words = [_WORDS.findall(t) if t is not None else [] for t in texts]
            if rewrite is not None:
                for k, h in enumerate(numbers):
                    if not pd.isna(h) and words[k] and (places := rewrite(len(words[k]), int(h))) is not None:
                        words[k] = [words[k][i] for i in places.tolist()]
            found = runs_of(words)
            yield pd.DataFrame({
                "runs": [[{"start": a, "length": b, "period": c} for a, b, c in r] for r in found],
                "collapsed": [b" ".join(collapsed(w, r)) for w, r in zip(words, found, strict=True)],
            })

    h = F.lit(None).cast("long") if number is None else number.cast("long")
    return docs.select(F.col("doc_id").alias("doc_id"), find(F.encode(F.col("text").cast("string"), "UTF-8"), h).alias("found")).select("doc_id", "found.runs", F.decode("found.collapsed", "UTF-8").alias("collapsed"))


def find_runs(docs: DataFrame) -> DataFrame:
    """One row per run: doc_id, start, length, period."""
    return with_runs(docs).select("doc_id", F.inline("runs"))


def collapse_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the text with one period left of each run."""
    return with_runs(docs).select("doc_id", "collapsed")


def digest(found: DataFrame) -> DataFrame:
    """One row per row of with_runs: how many runs, the one with the greatest exponent (exactly compared; then the first, then the shortest period), and checksums."""

    def earlier(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(a != b, F.when(a > b, -1).otherwise(1)).when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)

    best = F.get(F.array_sort("runs", earlier), 0)
    lines = F.array_join(F.transform("runs", lambda x: F.concat_ws("", F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    made = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))
    milli = F.expr("(1000 * best.length) div best.period")
    return made.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def planted(n: int, h: int) -> np.ndarray | None:
    """Where the words of a text with n words and checksum h are taken from: every tenth text repeats a stretch to its end."""
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.r_[np.arange(a), a + np.arange(n - a) % p]


def runs_with_planted(docs: DataFrame) -> DataFrame:
    """The digest of the runs of `docs` once the planted repeats are in."""
    return digest(with_runs(docs, planted, F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))))
