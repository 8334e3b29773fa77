"""Token counts and encodings of words that are very long: equal to the library's, within a bound of memory."""

import random
import tracemalloc

import sentencepiece

from tributary.llm import sentencepiece_codec, token_counts
from tributary.llm.pieces import MARK, MODEL_PATH, load, portions, stretches, words

rng = random.Random(6)
base64 = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))


def test_long_words_equal_the_library():
    model, pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH), load()
    texts = [base64(30_000), "a" * 5000, "ab" * 3000, "  " + "x" * 3000, "é" * 2000 + "😀" * 50, "   " + base64(60) + "  b", "=" * 1500 + " " + "-" * 1500, "the" * 700 + base64(100), " a  b", "  "]
    want = [model.encode(t) for t in texts]
    trie, codec = token_counts.CountTrie(pieces, 500), sentencepiece_codec.Codec(pieces)
    assert [sum(trie.count(w) for w in token_counts.words(t)) for t in texts] == [len(x) for x in want]
    assert [x.tolist() for x in codec.encode_batch(texts)] == want


def test_sections_change_nothing(monkeypatch):
    pieces, text = load(), base64(3000)
    whole = sentencepiece_codec.Codec(pieces).encode_batch([text])[0].tolist()
    for module in (sentencepiece_codec, token_counts):
        monkeypatch.setattr(module, "SECTION", 100)
    monkeypatch.setattr(sentencepiece_codec, "PART", 7)
    assert sentencepiece_codec.Codec(pieces).encode_batch([text])[0].tolist() == whole
    assert sum(token_counts.CountTrie(pieces).count(w) for w in token_counts.words(text)) == len(whole)


def test_a_word_of_ten_million_characters_within_bounds():
    """Memory goes with a section, not with the word."""
    pieces = load()
    text = base64(1_000_000) * 10
    trie = token_counts.CountTrie(pieces)
    tracemalloc.start()
    n = sum(trie.count(w) for w in token_counts.words(text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 1_000_000 and trie.held < 1000 and peak < 400_000_000


def test_the_codec_forgets_words_beyond_its_bound(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "KNOWN_BYTES", 10_000)
    codec, model = sentencepiece_codec.Codec(load()), sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    for _ in range(5):
        texts = [" ".join(base64(rng.randint(1, 9)) for _ in range(100))]
        assert [x.tolist() for x in codec.encode_batch(texts)] == model.encode(texts)
        assert codec.held < 10_000 + 100 * 400


def test_texts_in_stretches_give_what_whole_texts_give():
    rng, pieces = random.Random(4), load(MODEL_PATH)
    parts = [" ", "  ", "   ", MARK, "a", "der", "the sea", "\n", " x ", "é", "日本", "ing", f" {MARK} ", "word"]
    texts = [None, "", " ", "a b", *["".join(rng.choices(parts, k=rng.randint(0, 80))) for _ in range(150)]]
    for most in (1, 3, 10, 1000):
        for t in texts[1:]:
            assert [w for s in stretches(t, most) for w in words(s)] == words(t)
            assert "".join(stretches(t, most)).replace(" ", "") == t.replace(" ", "")
        whole = sentencepiece_codec.Codec(pieces).encode_batch(texts)
        cut = sentencepiece_codec.Codec(pieces).encode_batch(texts, most)
        assert [None if x is None else x.tolist() for x in cut] == [None if x is None else x.tolist() for x in whole]
        assert token_counts.CountTrie(pieces).totals(texts, most) == [0 if x is None else len(x) for x in whole]


def test_words_of_a_very_long_text_are_held_in_stretches():
    """The words of ten million characters, as objects, would take some 140 MB at once."""
    codec, text, most = sentencepiece_codec.Codec(load(MODEL_PATH)), "the sea was calm " * 600_000, 1_000_000
    codec.encode_batch(["the sea was calm "])
    assert max(sum(len(part) for _, part in some) for some in portions([text, "b"], most)) <= most + 20
    tracemalloc.start()
    ids = codec.encode_batch([text], most)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids) >= 2_400_000 and peak < 60 << 20


def test_words_that_come_again_are_held_once():
    """A million words of two hundred texts, a few of them distinct, would take some 90 MB as objects of their own."""
    codec, texts = sentencepiece_codec.Codec(load(MODEL_PATH)), ["the sea was calm " * 1250] * 200
    want = codec.encode_batch(texts[:1])[0].tolist()
    tracemalloc.start()
    found = codec.encode_batch(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(x.tolist() == want for x in found) and peak < 45 << 20
