"""Byte-pair encoding and decoding with a published vocabulary, in batched numpy merge rounds.

A text is normalised (NFC, lower case) and cut into words at white space and between letters, digits and other marks,
all by array passes over a chunk of texts. Words are looked up by hash in a table of words that were encoded before,
and compared byte by byte with what is found. The symbols of all new words of a chunk lie in one flat array. In each
round every word's lowest-rank adjacent pair is found by binary search over the sorted pair keys and all its
occurrences merge, left to right; words without a mergeable pair leave the array. Ids and decoded bytes of the chunk are
then gathered from flat arrays, so no step handles single words or ids in Python. A worker's table keeps the more
frequent half of its words when it is full.

Null texts are empty: no ids, an empty decoded text. A text may have any length: a longer one is read in pieces cut at
white space, over which no rule reaches; a word of any length is merged whole. Ties (equal ranks in one word) merge
from the left. The strings of special tokens in a text give their ids. Repeated rows give repeated results; extra
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import documents, eight, eights, slices, word_hashes

KEEP_WORDS = 600_000  # of a worker's table; the more frequent half then stays
PIECE = 1 << 18  # code points of a text that are read at once
SHIFT = np.uint64(20)
#: Code points that the vocabulary's rules take for white space (fixed values).
SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CUT = re.compile(r"[ \t-\r]")
NONE = np.int64(1 << 40)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + k)
    return [table[b] for b in range(256)]


def kinds_of_code_points() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 other, by the interpreter's Unicode tables (the regex package's are newer
    than those the vocabulary's own library was built with)."""
    out = np.full(0x110000, 3, np.uint8)
    of = {"L": 1, "N": 2}
    category = unicodedata.category
    out[:] = np.fromiter((of.get(category(chr(c))[0], 3) for c in range(0x110000)), np.uint8, 0x110000)
    for c in SPACES:
        out[c] = 0
    return out


class Pool:
    """Segments of one growing flat array: `data`, and each segment's first place and length."""

    def __init__(self, dtype: type):
        self.data, self.used = np.zeros(1 << 12, dtype), 0
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(flat) + 8 > len(self.data):  # at least eight to spare, for reading eight at once
            self.data = np.concatenate([self.data[: self.used], np.zeros(self.used + 2 * len(flat), self.data.dtype)])
        self.data[self.used : self.used + len(flat)] = flat
        self.first = np.concatenate([self.first, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.used += len(flat)

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The segments `which` in a row, and their lengths."""
        n = self.length[which]
        ends = np.cumsum(n)
        at = np.repeat(self.first[which] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.data[at], n

    def kept(self, which: np.ndarray) -> Pool:
        out = Pool(self.data.dtype.type)
        out.add(*self.take(which))
        return out


def pool_of(rows: list[bytes]) -> Pool:
    out = Pool(np.uint8)
    out.add(np.frombuffer(b"".join(rows), np.uint8), np.fromiter(map(len, rows), np.int64, len(rows)))
    return out


class WordTable:
    """Words that were encoded before: hash, bytes, ids and how often each was met, in an open hash table."""

    def __init__(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.seen = np.zeros(0, np.int64)
        self.bytes, self.ids = Pool(np.uint8), Pool(np.int32)
        self._place(1 << 16)

    def _place(self, size: int) -> None:
        self.size, self.slot = size, np.full(size, -1, np.int64)
        self._insert(np.arange(len(self.hash)))

    def _insert(self, new: np.ndarray) -> None:
        at = (self.hash[new] & np.uint64(self.size - 1)).astype(np.int64)
        while len(new):
            free = self.slot[at] < 0
            self.slot[at[free]] = new[free]  # of several for one place the last stays
            left = self.slot[at] != new
            new, at = new[left], (at[left] + 1) % self.size

    def find(self, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for one that is not in the table."""
        out = np.full(len(h), -1, np.int64)
        live, at = np.arange(len(h)), (h & np.uint64(self.size - 1)).astype(np.int64)
        while len(live):
            entry = self.slot[at]
            used = entry >= 0
            live, at, entry = live[used], at[used], entry[used]
            same = self.hash[entry] == h[live]
            out[live[same]] = entry[same]
            live, at = live[~same], (at[~same] + 1) % self.size
        # a hash is not proof: the bytes are compared, eight at a time
        live = np.flatnonzero(out >= 0)
        length = end - start
        wrong = length[live] != self.bytes.length[out[live]]
        out[live[wrong]] = -1
        live = live[~wrong]
        mine, theirs, k = eights(data), eights(self.bytes.data, False), 0
        while len(live):
            n = length[live] - k
            wrong = eight(mine, start[live] + k, n) != eight(theirs, self.bytes.first[out[live]] + k, n)
            out[live[wrong]] = -1
            k += 8
            live = live[~wrong & (n > 8)]
        self.seen += np.bincount(out[out >= 0], minlength=len(self.hash))
        return out

    def add(self, h: np.ndarray, words: list[bytes], flat: np.ndarray, lengths: np.ndarray, met: np.ndarray) -> None:
        new = np.arange(len(self.hash), len(self.hash) + len(h))
        self.hash, self.seen = np.concatenate([self.hash, h]), np.concatenate([self.seen, met])
        self.bytes.add(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))
        self.ids.add(flat, lengths)
        if 2 * len(self.hash) > self.size:
            self._place(4 * self.size)
        else:
            self._insert(new)

    def halve(self) -> None:
        """Keeps the more frequent half, with half its counts."""
        keep = np.sort(np.argsort(-self.seen, kind="stable")[: len(self.hash) // 2])
        self.hash, self.seen = self.hash[keep], self.seen[keep] // 2
        self.bytes, self.ids = self.bytes.kept(keep), self.ids.kept(keep)
        self._place(self.size)


class Tokenizer:
    """A word-end BPE vocabulary; `definition` is the JSON text of its file."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.suffix: str = spec["model"]["end_of_word_suffix"] or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (vocab | self.special).items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left, right, made = (np.array([vocab[x] for x in side], np.uint64) for side in ([a for a, _ in merges], [b for _, b in merges], [a + b for a, b in merges]))
        keys = left << SHIFT | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order].astype(np.int64)
        self.split_special = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        self.kind = kinds_of_code_points()
        self.id_text = pool_of([b"%d " % i for i in range(len(self.tokens))])
        self.token_text = pool_of([t.encode() + b" " for t in self.tokens])
        self.table = WordTable()

    def _pairs(self, sym: np.ndarray, last: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place in the table of the pair that starts at each symbol of `at`; NONE where there is none."""
        key = sym[at].astype(np.uint64) << SHIFT | sym[np.minimum(at + 1, len(sym) - 1)].astype(np.uint64)
        place = np.searchsorted(self.keys, key)
        place[place == len(self.keys)] = 0
        found = (self.keys[place] == key) & ~last[at]
        return np.where(found, self.ranks[place], NONE), place

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words in one array, all merged together round by round, and how many each word has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        last = np.zeros(len(data), bool)
        last[first + lengths - 1] = True
        sym = np.where(last, self.final[data], self.inner[data])
        number = np.arange(len(words))
        done_ids, done_words = [], []
        rank, at = self._pairs(sym, last, np.arange(len(sym)))
        while len(sym):
            least = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(sym)))
            done = least == NONE
            live = np.repeat(~done, sizes)
            done_ids.append(sym[~live])
            done_words.append(np.repeat(number[done], sizes[done]))
            hit = np.flatnonzero((rank == np.repeat(least, sizes)) & live)
            moved = np.zeros(len(sym), bool)
            if len(hit):  # of overlapping pairs (a a a) every other one merges, from the left
                fresh = np.append(True, np.diff(hit) != 1)
                run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
                sym[hit] = self.made[at[hit]]
                last[hit] = last[hit + 1]
                live[hit + 1] = False
                moved[hit] = True  # only pairs with a merged symbol are looked up again
                moved[hit[hit > 0] - 1] = True
            sym, last, rank, at = sym[live], last[live], rank[live], at[live]
            moved = np.flatnonzero(moved[live])
            rank[moved], at[moved] = self._pairs(sym, last, moved)
            number = number[~done]
            if len(sym):
                first = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
        of = np.concatenate(done_words)
        order = np.argsort(of, kind="stable")
        return np.concatenate(done_ids)[order].astype(np.int32), np.bincount(of, minlength=len(words))

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the normalised texts, each word's first byte and end in them, and the number of its text."""
        # code points are lowered one by one: no rule for a final sigma
        plain = [unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in texts]
        joined = "\n".join(plain) + "\n"
        point = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.kind[point]
        word = kind != 0
        start = word & ((kind == 2) | (np.diff(kind, prepend=np.uint8(0)) != 0))
        quotes = np.flatnonzero(start & (point == 39))
        if len(quotes):  # 's 't 'm 'd and 're 've 'll are words of their own where a word may start
            one, two = point[quotes + 1], point[np.minimum(quotes + 2, len(point) - 1)]
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            for at, n in ((quotes[short], 2), (quotes[long], 3)):
                start[at + 1] = False
                start[at + n] = word[at + n]
        stop = word & np.append(start[1:] | ~word[1:], True)
        first, end = np.flatnonzero(start), np.flatnonzero(stop) + 1
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in plain]), first, "right")
        if joined.isascii():
            return point.astype(np.uint8), first, end, text
        width = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
        byte = np.concatenate([[0], np.cumsum(width)])
        return np.frombuffer(joined.encode(), np.uint8), byte[first], byte[end], text

    def encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens in one array, and how many each text has."""
        if len(self.table.hash) > KEEP_WORDS:
            self.table.halve()
        data, start, end, text = self.split(texts)
        h = word_hashes(data, start, end)
        entry = self.table.find(h, data, start, end)
        new = np.flatnonzero(entry < 0)
        if len(new):
            raw = data.tobytes()
            number: dict[bytes, int] = {}
            own = np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)), np.int64, len(new))
            hashes = np.zeros(len(number), np.uint64)
            hashes[own] = h[new]
            entry[new] = own + len(self.table.hash)
            words = list(number)
            self.table.add(hashes, words, *self.encode_words(words), np.bincount(own))
        ids, n = self.table.ids.take(entry)
        return ids, np.bincount(text, n, len(texts)).astype(np.int64)

    def pieces(self, text: str) -> Iterator[str | int]:
        """The text in pieces cut at white space, with the ids of special tokens between them."""
        if self.split_special and any(s in text for s in self.special):
            for k, part in enumerate(self.split_special.split(text)):
                if k % 2:
                    yield self.special[part]
                elif part:
                    yield from self.pieces_plain(part)
        elif text:
            yield from self.pieces_plain(text)

    @staticmethod
    def pieces_plain(text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PIECE:
            cut = CUT.search(text, at + PIECE)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        parts: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        held: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            nonlocal held, size
            if held:
                ids, n = self.encode_plain([p for _, p in held])
                np.add.at(counts, [k for k, _ in held], n)
                parts.append(ids)
            held, size = [], 0

        for k, text in enumerate(texts):
            for piece in self.pieces(text):
                if isinstance(piece, int):
                    flush()
                    parts.append(np.array([piece], np.int32))
                    counts[k] += 1
                    continue
                held.append((k, piece))
                size += len(piece)
                if size > PIECE:
                    flush()
        flush()
        return np.concatenate([np.zeros(0, np.int32), *parts]), counts

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, as for a vocabulary without a decoder; special tokens stay."""
        return self.joined(self.token_text, np.array(ids, np.int64), np.array([len(ids)]))[0].decode()

    @staticmethod
    def joined(words: Pool, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """For each text the entries of its ids, joined by a space."""
        flat, n = words.take(ids)
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        raw = flat.tobytes()
        return [raw[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_LOADED: dict[str, Tokenizer] = {}


def loaded(definition: str) -> Tokenizer:
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(definition)
    return _LOADED[key]


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids and the decoded text.

    The driver reads the vocabulary (a few MB, however large the table) and broadcasts it; rows never shuffle.
    """
    with open(path or vocabulary_path(), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(shared.value)
        for batch in batches:
            for part, texts in slices(batch, text_col):
                ids, counts = tok.encode_batch([t.decode("utf-8", "replace") for t in texts])
                decoded = tok.joined(tok.token_text, ids, counts)
                digests = [pa.array([hashlib.sha256(x).hexdigest() for x in side], pa.string()) for side in (tok.joined(tok.id_text, ids, counts), decoded)]
                cols = [part.column(0), pa.array(counts, pa.int64()), *digests]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    cols += [pa.ListArray.from_arrays(ends, ids), pa.array([x.decode() for x in decoded], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
