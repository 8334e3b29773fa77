"""Forward values of many words at once: the words of a list advance together, one character a step, and shared prefixes are computed once.

The words come sorted, so those that share a prefix stand together, and the distinct prefixes are the nodes of their trie: a
word has nodes of its own from the character on in which it differs from the word before it. At each step the hashes of the substrings that end
there, differences of prefix hashes, probe the sorted hashes of the pieces; a hit may end the prefix if it may follow the last piece of
the prefix before it (see tributary.llm.pieces). The longest allowed piece is taken by a vectorised maximum.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

from tributary.llm.pieces import UNKNOWN, Pieces

_P = np.uint64(0x9E3779B97F4A7C15)
#: Leading bits of a hash that a small table of flags is asked for before the sorted keys are probed.
_MAYBE_SHIFT = np.uint64(44)
#: Stands for a prefix whose encoding isn't known, which only a collision of hashes can bring about.
LOST = -1


def _mixed(points: np.ndarray) -> np.ndarray:
    """A 64-bit value for each code point."""
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _padded(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words as a matrix with zeros behind them, and their lengths."""
    size = np.array([len(w) for w in some], dtype=np.int64)
    points = np.zeros((len(some), int(size.max(initial=0))), dtype=np.uint32)
    points[np.arange(points.shape[1]) < size[:, None]] = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return points, size


def _hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes: h[j] = h[j - 1] * P + value[j]."""
    h = np.zeros((points.shape[0], points.shape[1] + 1), dtype=np.uint64)
    values = _mixed(points)
    for j in range(points.shape[1]):
        h[:, j + 1] = h[:, j] * _P + values[:, j]
    return h


class Forward:
    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        keys: list[tuple[int, int]] = []
        by_length = defaultdict(list)
        for s in pieces.ids:
            by_length[len(s)].append(s)
        for some in by_length.values():
            keys += zip(_hashes(_padded(some)[0])[:, -1].tolist(), (pieces.ids[s] for s in some), strict=True)
        keys.sort()
        self.keys, self.key_ids = np.array([k for k, _ in keys], dtype=np.uint64), np.array([i for _, i in keys], dtype=np.int64)
        self.lengths = np.array([max(1, len(t)) for t in pieces.text])
        self.maybe = np.zeros(1 << (64 - int(_MAYBE_SHIFT)), dtype=bool)
        self.maybe[self.keys >> _MAYBE_SHIFT] = True
        self.points = _padded([(t if t in pieces.ids else "")[: pieces.longest].ljust(pieces.longest, "\0") for t in pieces.text])[0]
        powers = [1]
        for _ in range(pieces.longest):
            powers.append(powers[-1] * int(_P) % 2**64)
        self.powers = np.array(powers, dtype=np.uint64)

    def run(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted, distinct words: their code points, and for each prefix of each (columns from 0 on) its last piece and its tokens."""
        points, size = _padded(some)
        n, width = points.shape
        differ = points[1:] != points[:-1]
        common = np.zeros(n, dtype=np.int64)  # characters shared with the word before; it is a zero that a shorter word differs by
        common[1:] = differ.argmax(axis=1)
        h = _hashes(points)
        last, tokens = np.full((n, width + 1), LOST, dtype=np.int64), np.zeros((n, width + 1), dtype=np.int32)
        for j in range(1, width + 1):
            own = common < j
            rows = np.flatnonzero(own & (size >= j))
            self._step(points, h, last, tokens, rows, j)
            node = np.maximum.accumulate(np.where(own, np.arange(n), 0))  # the word that the prefix was computed for
            last[:, j], tokens[:, j] = last[node, j], tokens[node, j]
        return points, last, tokens

    def _step(self, points: np.ndarray, h: np.ndarray, last: np.ndarray, tokens: np.ndarray, rows: np.ndarray, j: int) -> None:
        spans = np.arange(1, min(j, self.pieces.longest) + 1)
        probe = h[rows, j][:, None] - h[rows[:, None], j - spans] * self.powers[spans]
        at, k = np.nonzero(self.maybe[probe >> _MAYBE_SHIFT])  # most substrings are no pieces
        asked = probe[at, k]
        place = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        piece, begin = self.key_ids[place], j - spans[k]
        hit = (self.keys[place] == asked) & (self.lengths[piece] == spans[k])
        single = np.zeros(len(rows), dtype=bool)
        single[at[hit & (k == 0)]] = True
        above = last[rows[at], begin]
        fits = hit & ((begin == 0) | (above != LOST))
        at, k, piece, begin, above = at[fits], k[fits], piece[fits], begin[fits], above[fits]
        fits = self.pieces.may_follow_all(np.where(begin == 0, UNKNOWN, above), piece)
        best = np.zeros(len(rows), dtype=np.int64)  # the backpointer: length and piece of the longest that fits
        np.maximum.at(best, at[fits], (spans[k[fits]] << 32) + piece[fits] + 1)
        found = best > 0
        last[rows, j] = np.where(found, (best & 0xFFFFFFFF) - 1, np.where(single, LOST, UNKNOWN))
        point = points[rows, j - 1]
        in_bytes = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        before = np.where(found, j - (best >> 32), j - 1)
        tokens[rows, j] = tokens[rows, before] + np.where(found, 1, in_bytes)

    def followed(self, points: np.ndarray, size: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Follow the backpointers of all words together, and check each piece against the word it was found in.

        Words and pieces in the order of the words, then of the text; and the words that a collision spoilt.
        """
        word, end, steps = np.arange(len(points)), size.copy(), []
        spoilt = np.zeros(len(points), dtype=bool)
        while len(word):
            piece = last[word, end]
            spoilt[word[piece == LOST]] = True
            word, end, piece = word[piece != LOST], end[piece != LOST], piece[piece != LOST]
            length = np.where(piece == UNKNOWN, 1, self.lengths[piece])
            begin = end - length
            known = piece != UNKNOWN
            for t in range(int(length.max(initial=0))):
                within = known & (t < length)
                spoilt[word[within][points[word[within], begin[within] + t] != self.points[piece[within], t]]] = True
            steps.append((word, piece))
            word, end = word[begin > 0], begin[begin > 0]
        order = np.concatenate([w for w, _ in reversed(steps)])
        ids = np.concatenate([p for _, p in reversed(steps)])[np.argsort(order, kind="stable")]
        return np.sort(order, kind="stable"), ids, spoilt
