"""Pieces against the library that the vocabulary is made for."""

from __future__ import annotations

import hashlib
import random

import pytest

from quire.llm import pieces
from quire.sources.shipping import ship
from tests.llm.helpers import corpus, frame, saved

spm = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=pieces.vocabulary_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model() -> bytes:
    with open(pieces.vocabulary_path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def strings() -> list[str]:
    rng = random.Random(5)
    letters = ["aab ▁\n", "abcdefghij klmnop", "ersthin▁ ", "éèüß日本語\U0001f600한́ \t\n", "<>/s0x41 ▁▁", "    \n\t=+-", "".join(map(chr, range(0, 127)))]
    out = ["", " ", "  a b", "▁", "a\x00b", "﻿a", " " * 100, "a" * 300, "ab" * 500, "é" * 77, "日本語" * 40, "\n" * 60, "▁" * 33 + "x", "</s><s><unk><0x41>", "\U0010ffff\U00020000"]
    return out + ["".join(rng.choice(a) for _ in range(rng.randint(1, 160))) for a in letters for _ in range(300)]


def check(own: pieces.Pieces, library, texts: list[str]) -> None:
    ids, counts = own.encode_batch(texts)
    at = 0
    for text, n, back in zip(texts, counts.tolist(), own.decode_batch(ids, counts), strict=True):
        want = library.encode(text, add_bos=False, add_eos=True)
        assert ids[at : at + n].tolist() == want and back.decode() == library.decode(want) == own.decode(want), text
        at += n


@pytest.mark.parametrize(("piece", "long", "keep"), [(1 << 18, 48, 400_000), (40, 48, 50), (300, 3, 400_000), (1 << 18, 10_000, 50)])
def test_ids_are_the_library_s(library, model, monkeypatch, piece, long, keep):
    """Also with texts read in short parts, words that all go through the heap or none, and a table that keeps forgetting."""
    monkeypatch.setattr(pieces, "PIECE", piece)
    monkeypatch.setattr(pieces, "LONG", long)
    monkeypatch.setattr(pieces, "KEEP_WORDS", keep)
    own = pieces.Pieces(model)
    texts = strings()
    for k in range(0, len(texts), 200):
        check(own, library, texts[k : k + 200])


def test_code_points(library, model):
    own = pieces.Pieces(model)
    check(own, library, [f"x{chr(c)} {chr(c)}y" for c in range(1, 0x110000, 23) if not 0xD800 <= c < 0xE000])


def test_each_word_is_segmented_once(model, monkeypatch):
    own, asked = pieces.Pieces(model), []
    plain = pieces.Pieces.segment
    monkeypatch.setattr(pieces.Pieces, "segment", lambda self, words: (asked.extend(words), plain(self, words))[1])
    for _ in range(3):
        own.encode_batch(["the cat the cat\nthe dog", "dog the"] * 5)
    assert len(asked) == len(set(asked)) and {w.decode() for w in asked} >= {"▁the", "▁cat", "\n"}


def test_a_very_long_word(library, model):
    word = "a" * 60_000 + "thethe" * 10_000 + "日本" * 5_000
    check(pieces.Pieces(model), library, [word])


def test_other_vocabularies_are_refused():
    unigram = b"\x0a\x03\x0a\x01a" + b"\x12\x02\x18\x01" + b"\x1a\x00"
    with pytest.raises(ValueError):
        pieces.Pieces(unigram)


def test_rows(spark, library, tmp_path):
    ship(spark)
    rows = corpus()
    rows += [(None, "no id", "en", "s", 5), (3, "same id", "en", "s", 7), (3, "same id", "en", "s", 7), (99, "\ta  b\x00▁c\U0001f600 " * 3000, "en", "s", 1)]
    got = pieces.op12_sentencepiece(spark, saved(spark, tmp_path, rows)).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for d, t, *_ in rows:
        ids = library.encode(t or "", add_bos=False, add_eos=True)
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    docs = frame(spark, rows).withColumnRenamed("doc_id", "n_tokens").withColumnRenamed("text", "ids")
    with_ids = pieces.encode_documents(docs.selectExpr("n_tokens AS key", "ids AS body", "lang AS n_tokens"), id_col="key", text_col="body", with_ids=True).collect()
    assert sorted(str((r.key, r.n_tokens, r.decoded)) for r in with_ids) == sorted(str((d, len(r), library.decode(r))) for d, t, *_ in rows for r in [library.encode(t or "", add_eos=True)])
    assert pieces.encode_documents(frame(spark, [])).count() == 0
