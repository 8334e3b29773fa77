"""The pieces of a public SentencePiece model of the BPE kind, and which of them may stand side by side.

A BPE encoding has no additive unigram score, so the dynamic programs of this package carry another forward value: the last
piece of a prefix's encoding, which is unique. A piece may end a prefix if it may follow the last piece of what precedes
it, that is, if no merge across their boundary would have come before the merges that built either of them. This gives
the tokenizer's own encoding, where the best sum of scores would not.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "\u2581"
#: A word with the marks before it, or marks at the end of the text.
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BETWEEN = re.compile(f"(?<=[^ {MARK}]) (?=[^ {MARK}])")
#: Stands for a character without a piece, which is spelt in bytes.
UNKNOWN = -2
NEVER = 1 << 40


@dataclass
class Pieces:
    text: list[str]  # of every id; empty for control pieces
    rank: np.ndarray  # merge order of each id, lower first; NEVER for ids that no merge makes
    byte_ids: list[int]
    ids: dict[str, int]  # pieces that the encoder can give
    left: np.ndarray = field(default=None)  # the two parts of a piece's last merge; -1 for single characters
    right: np.ndarray = field(default=None)
    merges: dict[int, int] = field(default=None)  # left id * number of ids + right id -> rank
    longest: int = 1

    def __post_init__(self) -> None:
        n = len(self.text)
        self.longest = max(map(len, self.ids), default=1)
        self.merges = {}
        for s, i in self.ids.items():
            for cut in range(1, len(s)):
                a, b = self.ids.get(s[:cut]), self.ids.get(s[cut:])
                if a is not None and b is not None:
                    self.merges[a * n + b] = int(self.rank[i])
        self.left, self.right = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        for s, i in [*self.ids.items()]:
            if len(s) > 1:
                made, last = self.simulate(s)
                if made == [i]:
                    self.left[i], self.right[i] = last
                else:
                    del self.ids[s]  # no text is ever encoded with it
        keys = np.array(sorted(self.merges), dtype=np.int64)
        self.merge_keys, self.merge_ranks = keys, np.array([self.merges[k] for k in keys.tolist()], dtype=np.int64)
        self.maybe = np.zeros(1 << 21, dtype=bool)
        self.maybe[self._flag(keys)] = True
        self.raw = [t.encode("utf-8") for t in self.text]
        for value, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([value])
        self.known_pairs: dict[int, bool] = {}
        self.asked = self.found = None
        self._runs: dict[int, list[int]] = {}
        # rank of the merge that made a piece, -1 for single characters; plain lists are faster to look up one by one
        self.made = np.where(self.left >= 0, self.rank, -1)
        self._sides = (n, self.made.tolist(), self.left.tolist(), self.right.tolist(), self.merges)
        self.mark_id = self.ids.get(MARK)
        self.inner = {s[k : k + 2] for s in self.ids for k in range(len(s) - 1)}

    @staticmethod
    def _flag(keys: np.ndarray) -> np.ndarray:
        """Place of a pair in the table of flags that is asked before the sorted keys."""
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)

    def simulate(self, word: str) -> tuple[list[int], tuple[int, int]]:
        """Merge by merge, lowest rank first, then leftmost: the ids, and the parts of the last merge. For short words."""
        out, last, n = [self.ids.get(c, UNKNOWN) for c in word], (-1, -1), len(self.text)
        spans = list(word)
        while len(out) > 1:
            best, at = NEVER, -1
            for k in range(len(out) - 1):
                if out[k] >= 0 and out[k + 1] >= 0 and (r := self.merges.get(out[k] * n + out[k + 1], NEVER)) < best:
                    best, at = r, k
            if at < 0:
                break
            last = (out[at], out[at + 1])
            spans[at : at + 2] = [spans[at] + spans[at + 1]]
            out[at : at + 2] = [self.ids.get(spans[at], UNKNOWN)]
        return out, last

    def run(self, k: int) -> list[int]:
        """Ids of k marks in a row, apart from the word that follows."""
        if k not in self._runs:
            most = max((len(s) for s in self.ids if set(s) == {MARK}), default=1)
            self._runs[k] = [self.ids[MARK * most]] * (k // most) + self.run(k % most) if k > 4 * most else self.simulate(MARK * k)[0]
        return self._runs[k]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the encoding of a's text and b's text together is just a, b."""
        if a < 0 or b < 0:
            return True
        n, made, left, right, merges = self._sides
        key = a * n + b
        found = self.known_pairs.get(key)
        if found is None:
            if len(self.known_pairs) > 2_000_000:
                self.known_pairs.clear()
            until_a = until_b = NEVER
            while True:
                rank = merges.get(a * n + b, NEVER)
                if rank < until_a and rank <= until_b:
                    found = False
                    break
                made_a, made_b = made[a], made[b]
                if made_a < 0 and made_b < 0:
                    found = True
                    break
                if made_b >= made_a:
                    until_b, b = made_b, left[b]
                else:
                    until_a, a = made_a, right[a]
            self.known_pairs[key] = found
        return found

    def may_follow_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """may_follow for many pairs. A table of fixed size holds what was found last for each of its places."""
        if self.asked is None:
            self.asked, self.found = np.full(1 << 21, -1, dtype=np.int64), np.zeros(1 << 21, dtype=bool)
        ok = (a < 0) | (b < 0)
        at = np.flatnonzero(~ok)
        key = a[at].astype(np.int64) * len(self.text) + b[at]
        place = self._flag(key)
        known = self.asked[place] == key
        ok[at] = self.found[place]
        new = np.flatnonzero(~known)
        if len(new):
            key, first = np.unique(key[new], return_index=True)
            at_first, place = at[new[first]], place[new[first]]
            made = self._may_follow_each(a[at_first], b[at_first])
            self.asked[place], self.found[place] = key, made
            ok[at[new]] = made[np.searchsorted(key, a[at[new]].astype(np.int64) * len(self.text) + b[at[new]])]
        return ok

    def _may_follow_each(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Both sides of pairs of pieces are taken apart, the later merge first, and each boundary is checked on the way."""
        ok, at = np.ones(len(a), dtype=bool), np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        until_a, until_b = np.full(len(at), NEVER), np.full(len(at), NEVER)  # ranks at which each side is merged away from the boundary
        while len(at):
            key = a * len(self.text) + b
            asked = np.flatnonzero(self.maybe[self._flag(key)])  # most pairs do not merge
            place = np.minimum(np.searchsorted(self.merge_keys, key[asked]), len(self.merge_keys) - 1)
            rank = self.merge_ranks[place]
            crossing = asked[(self.merge_keys[place] == key[asked]) & (rank < until_a[asked]) & (rank <= until_b[asked])]
            crossed = np.zeros(len(at), dtype=bool)
            crossed[crossing] = True
            ok[at[crossing]] = False
            made_a, made_b = self.made[a], self.made[b]
            more = ~crossed & ((made_a >= 0) | (made_b >= 0))
            undo_b = made_b >= made_a
            until_a, until_b = np.where(undo_b, until_a, made_a), np.where(undo_b, made_b, until_b)
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
            at, a, b, until_a, until_b = at[more], a[more], b[more], until_a[more], until_b[more]
        return ok

    def sections(self, word: str, size: int) -> Iterator[str]:
        """The word in sections of about `size` characters, which end where no piece holds the two characters that meet."""
        start = 0
        while start < len(word):
            end = min(len(word), start + size)
            while end < len(word) and word[end - 1 : end + 1] in self.inner:
                end += 1
            yield word[start:end]
            start = end

    def cut(self, word: str) -> list[str]:
        """The word cut wherever no piece holds the two characters that meet; nothing merges across a cut."""
        cuts = [0, *(k + 1 for k in range(len(word) - 1) if word[k : k + 2] not in self.inner), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def forward(self, word: str) -> Iterator[tuple[int, int, int]]:
        """For each prefix of a word of any length: the last piece of its encoding, its tokens, and its first piece.

        Only as many prefixes as the longest piece has characters are looked back to, and kept.
        """
        n, get = self.longest + 1, self.ids.get
        ring: list = [(None, 0, None)] * n
        for j in range(1, len(word) + 1):
            c = word[j - 1]
            if c not in self.ids:
                _, tokens, first = ring[(j - 1) % n]
                found = UNKNOWN, tokens + len(c.encode("utf-8", "replace")), UNKNOWN if j == 1 else first
            else:
                for i in range(j - 1, max(-1, j - n), -1):
                    piece = get(word[i:j])
                    if piece is not None and (i == 0 or self.may_follow(ring[i % n][0], piece)):
                        found = piece, ring[i % n][1] + 1 if i else 1, ring[i % n][2] if i else piece
                        break
            ring[j % n] = found
            yield found

    def encode_long(self, word: str) -> bytes:
        """The ids of one long word as 32-bit numbers, with four bytes of backpointers for each character."""
        last, j, out = array("i", (f[0] for f in self.forward(word))), len(word), array("i")
        while j:
            piece = last[j - 1]
            if piece == UNKNOWN:
                out.extend(reversed(self.spelt(word[j - 1])))
                j -= 1
            else:
                out.append(piece)
                j -= len(self.text[piece])
        out.reverse()
        return out.tobytes()

    def spelt(self, character: str) -> list[int]:
        """Ids of a character without a piece."""
        return [self.byte_ids[x] for x in character.encode("utf-8", "replace")]

    def decode(self, ids) -> str:
        """The text of a sequence of ids."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")[1:]


def words(text: str) -> list[str]:
    """Parts of a text across which nothing merges; the text gets a mark in front, and marks for its blanks."""
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return _WORDS.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in text.split(" ")]


def stretches(text: str, most: int) -> Iterator[str]:
    """Stretches of a text of `most` characters or more, cut at single blanks between words: words() of one after another are those of the text."""
    at = 0
    while len(text) - at > most:
        cut = _BETWEEN.search(text, at + most - 1)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def portions(texts: list[str | None], most: int) -> Iterator[list[tuple[int, str]]]:
    """Lists of (number of the text, stretch of it), of about `most` characters each, as a word is some ten times larger as an object; texts that are null are left out."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for part in stretches(text, most) if isinstance(text, str) else ():
            if held and size + len(part) > most:
                yield held
                held, size = [], 0
            held.append((k, part))
            size += len(part)
    if held:
        yield held


@lru_cache(maxsize=2)
def load(path: str = MODEL_PATH) -> Pieces:
    """Read a model on the driver; the result is a small table that may be broadcast."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    text = ["" if special[i] else model.id_to_piece(i) for i in range(n)]
    ids = {text[i]: i for i in range(n) if not special[i] and not model.is_byte(i)}
    order = sorted(ids.values(), key=lambda i: -model.get_score(i))
    rank = np.full(n, NEVER, dtype=np.int64)
    for r, i in enumerate(order):
        rank[i] = r
    # runs of marks share one score, the lowest, so that the leftmost pair goes first
    runs = [i for s, i in ids.items() if set(s) == {MARK}]
    if runs:
        rank[runs] = len(order)
    if len(byte_ids) != 256 or byte_ids != list(range(byte_ids[0], byte_ids[0] + 256)) or any(MARK in s.lstrip(MARK) or (s.startswith(MARK * 2) and set(s) != {MARK}) for s in ids):
        raise ValueError("a model with byte pieces, whose pieces hold marks at their start only, is asked for")
    return Pieces(text, rank, byte_ids, ids)
