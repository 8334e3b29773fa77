"""Token counts by a dynamic program over a trie of distinct pre-tokens.

Method. A text falls into pre-tokens across which nothing merges. The distinct ones of a batch that a worker hasn't met are sorted, so that
they form a trie, and its nodes are computed level by level (tributary.llm.advance): a node's forward value, the last piece and the number of
tokens of its prefix, is computed once however many pre-tokens share the prefix. The count of each terminal is kept by pre-token, from task to task. See
tributary.llm.pieces for why the forward value is the last piece and not a sum of unigram scores: the public models at hand are of the BPE kind.

Memory. A trie holds at most TOGETHER pre-tokens of at most LONG characters. Longer ones are cut where no piece holds the two characters
that meet, section by section. A part that is still over LONG characters isn't inserted: its forward values are computed in a row, with only
as many kept as the longest piece has characters. Terminals that aren't met again are forgotten when KNOWN_BYTES are taken, which changes no count.

Defined results. Null and empty texts have 0 tokens. Characters without a piece count one token for each UTF-8 byte.
A word of many megabytes is counted whole. Repeated rows get equal counts; no rows give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import batched, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.advance import Forward
from tributary.llm.pieces import MARK, MODEL_PATH, Pieces, load, portions, words
from tributary.llm.shared import kept, shared_value, small_batches

LONG, SECTION = 48, 1 << 20
#: Arrow batches that are counted at once.
BATCHES = 4
#: Pre-tokens of one trie.
TOGETHER = 20_000
#: Characters of texts that are cut into pre-tokens at once.
TEXT_CHARS = 8_000_000
#: Bytes of pre-tokens and counts that a worker keeps, in two generations, and what an entry takes besides its characters.
KNOWN_BYTES, ENTRY_BYTES = 100_000_000, 160


class CountTrie:
    """Pre-tokens to token counts."""

    def __init__(self, pieces: Pieces, known_bytes: int = KNOWN_BYTES) -> None:
        self.pieces, self.forward, self.known_bytes = pieces, Forward(pieces), known_bytes
        self.terminals: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.held = 0

    def inserted(self, parts: set[str]) -> dict[str, int]:
        """Counts of distinct parts of at most LONG characters, by tries of their own."""
        out, some = {}, sorted(parts)
        for i in range(0, len(some), TOGETHER):
            part = some[i : i + TOGETHER]
            points, last, tokens = self.forward.run(part)
            size = np.array([len(w) for w in part])
            counts = tokens[np.arange(len(part)), size].tolist()
            for k in np.flatnonzero(self.forward.followed(points, size, last)[2]).tolist():
                counts[k] = self.in_a_row(part[k])[0]
            out.update(zip(part, counts, strict=True))
        return out

    def in_a_row(self, part: str) -> tuple[int, int]:
        """Tokens and first piece of one part, prefix by prefix."""
        for _, tokens, first in self.pieces.forward(part):  # noqa: B007
            pass
        return tokens, first

    def learn(self, words: set[str]) -> None:
        """Insert pre-tokens that are no terminals yet; those that are stay, so the bound is asked between batches only."""
        some = {MARK + body for w in words if 0 < len(body := w.lstrip(MARK)) < LONG and w[0] == MARK}.difference(self.terminals)
        self.terminals |= self.inserted(some)
        self.held += sum(map(len, some)) + ENTRY_BYTES * len(some)

    def count(self, word: str) -> int:
        if word not in self.terminals:
            self.learn({word})
        found = self.terminals.get(word)
        if found is not None:
            return found
        body = word.lstrip(MARK)
        marks = len(word) - len(body)
        if not body:
            return len(self.pieces.run(marks))
        single = MARK * min(marks, 1) + body
        total = self.terminals.get(single)
        if total is None:
            total = 0
            for section in self.pieces.sections(single, SECTION):
                parts = Counter(self.pieces.cut(section))
                counts = self.inserted({p for p in parts if len(p) <= LONG})
                total += sum(n * (counts[p] if p in counts else self.in_a_row(p)[0]) for p, n in parts.items())
        if marks > 1:  # the last mark belongs to the word unless it stayed alone there
            begin = self.pieces.cut(next(self.pieces.sections(single, SECTION)))[0]
            total += len(self.pieces.run(marks)) - 1 if self.in_a_row(begin)[1] == self.pieces.mark_id else len(self.pieces.run(marks - 1))
        return total

    def totals(self, texts: list[str | None], text_chars: int = TEXT_CHARS) -> list[int]:
        """Counts of whole texts."""
        out = [0] * len(texts)
        for some in portions(texts, text_chars):
            for (k, _), n in zip(some, self._totals([part for _, part in some]), strict=True):
                out[k] += n
        return out

    def _totals(self, texts: list[str]) -> list[int]:
        if self.held > self.known_bytes // 2:  # pre-tokens that are met again are carried over from the generation before
            self.old, self.terminals, self.held = self.terminals, {}, 0
        split = [words(t) for t in texts]
        new = set().union(*split).difference(self.terminals)
        again = {w: self.old[w] for w in new if w in self.old}
        self.terminals |= again
        self.held += sum(map(len, again)) + ENTRY_BYTES * len(again)
        new.difference_update(again)
        self.learn(new)
        rare = {w: self.count(w) for w in new if w not in self.terminals}
        if rare:
            return [sum(rare[w] if w in rare else self.terminals[w] for w in s) for s in split]
        return [sum(map(self.terminals.__getitem__, s)) for s in split]


def count_tokens(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """One row per document: doc_id, n_tokens."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = shared_value(spark, load(model_path))  # one table of the model's pieces

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie = kept(f"token counts {model_path}", lambda: CountTrie(pieces()))
        for some in batched(batches, BATCHES):  # more pre-tokens share a trie
            totals = iter(trie.totals([t for batch in some for t in batch]))
            for batch in some:
                yield pd.Series(list(islice(totals, len(batch))), dtype="int64")

    return docs.select("doc_id", counted("text").alias("n_tokens"))
