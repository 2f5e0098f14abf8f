from __future__ import annotations

import random

import numpy as np
import pytest

from quire.llm import bpe
from quire.llm.common import Words, word_hashes
from tests.llm.helpers import words


@pytest.fixture(scope="module")
def both():
    tokenizers = pytest.importorskip("tokenizers")
    with open(bpe.vocabulary_path(), encoding="utf-8") as f:
        return bpe.Tokenizer(f.read()), tokenizers.Tokenizer.from_file(bpe.vocabulary_path())


def test_small_tables_and_pieces_change_nothing(both, monkeypatch):
    """A table that keeps 50 words, texts read in pieces of 40 code points, very long words, and special tokens."""
    tok, ref = both
    monkeypatch.setattr(bpe, "KEEP_WORDS", 50)
    monkeypatch.setattr(bpe, "PIECE", 40)
    rng = random.Random(7)
    texts = [words(rng, rng.randint(0, 120)) + rng.choice(["", " <|endoftext|>x", "\n\n don't 'RE we'll 12３", "é e\u0301 ﬁ İ"]) for _ in range(80)] + ["", " \n", "ab" * 3000, "a " * 200]
    for k in range(0, len(texts), 7):
        ids, counts = tok.encode_batch(texts[k : k + 7])
        want = [e.ids for e in ref.encode_batch(texts[k : k + 7], add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert [x.decode() for x in tok.joined(tok.token_text, ids, counts)] == [ref.decode(w, skip_special_tokens=False) for w in want]
    assert len(tok.table.hash) < 400


def test_words_of_one_hash_are_told_apart(both, monkeypatch):
    tok, ref = both
    monkeypatch.setattr(bpe, "word_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    monkeypatch.setattr(tok, "table", bpe.WordTable())
    for text in ("one two three one", "three two one four", "one four"):
        assert tok.encode(text) == ref.encode(text, add_special_tokens=False).ids


def test_word_hashes_are_no_polynomial():
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    texts = ["".join("ab"[b] for b in bits).encode(), "".join("ba"[b] for b in bits).encode(), b"a", b"a\x00", b"abcdefgh", b"abcdefgh\x00", b"abcdefghi", b"x" * 64, b"x" * 65]
    w = Words(texts)
    for seed in (0, 2):
        h = w.hashes(seed)
        assert len(set(h.tolist())) == len(texts)
        assert (h == word_hashes(w.data, w.start, w.end, seed)).all()
    assert not set(w.hashes(0).tolist()) & set(w.hashes(2).tolist())
