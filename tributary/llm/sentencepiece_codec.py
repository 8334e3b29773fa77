"""SentencePiece encoding and decoding by a batched numpy Viterbi.

Method. The distinct words of a batch are grouped by length, and all words of a length advance together, one character a
step (tributary.llm.advance). At each step the hashes of the substrings that end there, differences of prefix hashes, probe the sorted
hashes of the pieces; a hit may end the prefix if it may follow the last piece of the prefix before it (see
tributary.llm.pieces, which says why this stands where a unigram model has a sum of scores). The longest allowed
piece, taken by a vectorised maximum over all lengths, is the backpointer. An exact check compares the pieces' texts with each word;
a word that a hash collision spoilt is encoded merge by merge. Texts are cut into words TEXT_CHARS characters at a time, very long ones in stretches.
Words over LONG characters are first cut where no piece
holds the two characters that meet; a part that is still over PART characters is encoded by itself, with four bytes of backpointers a character.
A Python worker keeps the encodings of short words from task to task, up to KNOWN_BYTES; those of long words are not kept.

Decoding joins the pieces' texts, turns byte pieces back into characters and marks into blanks, and drops the blank in front.

Defined results. Null gives null ids and null text; an empty text gives no ids. Decoding an encoded text gives the text
back, except that U+2581 becomes a blank, as in the public library. A word of many megabytes is encoded whole, in sections. Repeated rows get equal results; no rows give no rows.
Only the text column is read; encode_documents keeps the others, and a column of its result's names is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import batched, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.advance import Forward
from tributary.llm.pieces import MARK, MODEL_PATH, UNKNOWN, Pieces, load, portions, words
from tributary.llm.shared import kept, shared_value, small_batches, trimmed

LONG, PART, SECTION = 48, 1024, 1 << 20
#: Bytes of words and their encodings that a worker keeps, in two generations, and what an entry takes besides its characters.
KNOWN_BYTES, ENTRY_BYTES = 48_000_000, 230
#: Arrow batches that are encoded at once.
BATCHES = 2
#: Words, and their characters, that advance together at most.
TOGETHER, TOGETHER_CHARS = 20_000, 1_000_000
#: Characters of texts that are cut into words at once.
TEXT_CHARS = 4_000_000


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


class Codec:
    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.forward, self.known, self.old, self.held = pieces, Forward(pieces), {}, {}, 0

    def _viterbi(self, some: list[str]) -> list[bytes]:
        """Encodings of sorted, distinct words of one length, as bytes of 32-bit ids."""
        points, last, _ = self.forward.run(some)
        order, ids, odd = self.forward.followed(points, np.full(len(some), points.shape[1]), last)
        odd[order[ids == UNKNOWN]] = True  # to be spelt in bytes
        ends = (4 * np.cumsum(np.bincount(order, minlength=len(some)))).tolist()
        flat = ids.astype(np.int32).tobytes()
        out = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._backwards(some[i], last[i].tolist())
        return out

    def _backwards(self, word: str, row: list[int]) -> bytes:
        ids, j = [], len(word)
        while j > 0:
            piece = row[j]
            if piece == UNKNOWN:
                ids += reversed(self.pieces.spelt(word[j - 1]))
                j -= 1
            elif piece < 0 or not word.endswith(self.pieces.text[piece], 0, j):
                return _packed(self._plain(word))
            else:
                ids.append(piece)
                j -= len(self.pieces.text[piece])
        return _packed(ids[::-1])

    def _plain(self, word: str) -> list[int]:
        made, at, out = self.pieces.simulate(word)[0], 0, []
        for i in made:
            out += self.pieces.spelt(word[at]) if i == UNKNOWN else [i]
            at += 1 if i == UNKNOWN else len(self.pieces.text[i])
        return out

    def _encoded(self, parts: set[str]) -> dict[str, bytes]:
        """Encodings of distinct parts of words, those of one length together."""
        found, by_length = {}, defaultdict(list)
        for p in parts:
            if len(p) > PART:
                found[p] = self.pieces.encode_long(p)
            else:
                by_length[len(p)].append(p)
        for some in by_length.values():
            some.sort()
            step = min(TOGETHER, TOGETHER_CHARS // len(some[0]))
            for i in range(0, len(some), step):
                found.update(zip(some[i : i + step], self._viterbi(some[i : i + step]), strict=True))
        return found

    def _long(self, word: str) -> bytes:
        """The encoding of a word that is long, or has other than one mark in front."""
        body = word.lstrip(MARK)
        marks = len(word) - len(body)
        if not body:
            return _packed(self.pieces.run(marks))
        word = MARK * min(marks, 1) + body
        packed = self.known.get(word)
        if packed is None:
            out = []
            for section in self.pieces.sections(word, SECTION):
                parts = self.pieces.cut(section)
                found = self._encoded(set(parts))
                out += map(found.__getitem__, parts)
            packed = b"".join(out)
        if marks > 1:  # the last mark belongs to the word unless it stayed alone there
            if np.frombuffer(packed[:4], dtype=np.int32)[0] == self.pieces.mark_id:
                return _packed(self.pieces.run(marks)) + packed[4:]
            return _packed(self.pieces.run(marks - 1)) + packed
        return packed

    def encode_batch(self, texts: list[str | None], text_chars: int = TEXT_CHARS) -> list[np.ndarray | None]:
        made: list[list[np.ndarray]] = [[] for _ in texts]
        for some in portions(texts, text_chars):
            for (k, _), ids in zip(some, self._encode([part for _, part in some]), strict=True):
                made[k].append(ids)
        return [None if not x else x[0] if len(x) == 1 else np.concatenate(x) for x in made]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        seen: dict[str, str] = {}
        split = [list(map(seen.setdefault, some := words(t), some)) for t in texts]  # a word that comes again is the first one's object
        if self.held > KNOWN_BYTES // 2:  # words that are met again are carried over from the generation before
            self.old, self.known, self.held = self.known, {}, 0
        new = set(seen).difference(self.known)
        again = {w: self.old[w] for w in new if w in self.old}
        self.known |= again
        self.held += sum(len(w) + len(ids) for w, ids in again.items()) + ENTRY_BYTES * len(again)
        plain, others = set(), set()
        for w in new.difference(again):  # most words have one mark and are short
            (plain if len(w) <= LONG and w[0] == MARK and w[1:2] not in ("", MARK) else others).add(w)
        plain |= {MARK + body for w in others if (body := w.lstrip(MARK)) and len(body) < LONG and w[0] == MARK}
        new = self._encoded(plain.difference(self.known))
        self.held += sum(len(w) + len(ids) for w, ids in new.items()) + ENTRY_BYTES * len(new)
        self.known.update(new)
        rare = {w: self._long(w) for w in others}
        of = (lambda w: rare[w] if w in rare else self.known[w]) if rare else self.known.__getitem__
        return [np.frombuffer(b"".join(map(of, s)), dtype=np.int32) for s in split]


def encode_documents(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """`docs` with ids (array of int), n_pieces and decoded, the text that the ids give back."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = shared_value(spark, load(model_path))  # one table of the model's pieces

    @F.pandas_udf("ids array<int>, n_pieces long, decoded string")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = kept(f"pieces codec {model_path}", lambda: Codec(pieces()))
        for some in batched(batches, BATCHES):  # more words of a length advance together
            all_ids = iter(codec.encode_batch([t for batch in some for t in batch]))
            for batch in some:
                ids = list(islice(all_ids, len(batch)))
                back = [None if x is None else codec.pieces.decode(x.tolist()) for x in ids]
                yield pd.DataFrame({"ids": ids, "n_pieces": [0 if x is None else len(x) for x in ids], "decoded": pd.Series(back, dtype=object)})
            some = batch = all_ids = ids = back = None
            trimmed()  # else what the batches took stays with the worker beside what the next ones take

    others = F.struct(*[c for c in docs.columns if c.lower() not in {"ids", "n_pieces", "decoded"}])
    return docs.select(others.alias("others"), encoded("text").alias("made")).select("others.*", "made.*")


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_pieces, a checksum of the ids, and whether decoding gave the text back."""
    same = F.translate("text", MARK, " ").eqNullSafe(F.col("decoded"))
    return encoded.select("doc_id", "n_pieces", F.xxhash64("ids").alias("ids_xxhash64"), same.alias("round_trip"))
