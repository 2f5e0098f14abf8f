"""SentencePiece encoding and decoding over a table of distinct marked words.

White space becomes a marker and no piece of the vocabulary has a marker behind another character (checked when it is
read), so a text falls into marked words that are segmented by themselves: at each marker after another character, and on
both sides of a character that no longer piece holds. Array passes over a chunk of texts find the words; each distinct
one is looked up by hash in a worker's table, compared byte by byte, and segmented only if it is new there; the ids are
then joined back by position from flat arrays. Segmenting goes in numpy rounds over all new words at once: in each round
every word merges its best pair (the highest score; of equal scores the leftmost), as the score order asks. Words of
over LONG characters go through a heap, so that their time stays near linear. Characters left without a piece are the
pieces of their bytes.

Null texts are empty: only the end id, an empty decoded text. A text may have any length: a longer one is read in parts
cut before a marker; a word without any place to cut is segmented whole, at some 60 bytes of memory a character. The names
of control pieces in a text are ordinary text. Repeated rows give repeated results; extra columns are left out; an empty
table gives no rows. A vocabulary of another kind (not BPE with byte fallback and unchanged text) is an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.llm.bpe import PIECE, SHIFT, WordTable, pool_of, vocabulary_path
from quire.llm.common import documents, slices, word_hashes

MARK = "▁"
KEEP_WORDS, KEEP_BYTES = 400_000, 1 << 25  # of a worker's table; the more frequent half then stays
LONG = 48  # characters of a word from which it is segmented by itself
NONE, PLACE = np.int64(1 << 24), 36  # the rank of no pair; bits of a place beside a rank
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values of the model file: kinds of pieces


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) pairs of a serialised protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, raw[at : at + size]
            at += size


class Pieces:
    """A piece vocabulary; `model` is the content of its file."""

    def __init__(self, model: bytes):
        parts = list(fields(model))
        rows = [dict(fields(v)) for f, v in parts if f == 1]
        # fixed values of the model file: 2 the training settings (3 kind, 24 marks as suffixes, 35 byte fallback), 3 the
        # text rules (2 replacements, 3 a marker before the text, 4 no repeated white space, 5 markers for white space)
        trained, rules = ({k: v for f, v in parts if f == n for k, v in fields(v)} for n in (2, 3))
        self.names = [r[1].decode() for r in rows]
        score = np.array([np.frombuffer(r[2], "<f4")[0] if 2 in r else 0.0 for r in rows], np.float32)
        kind = np.array([r.get(3, NORMAL) for r in rows])
        plain = trained.get(3) == 2 and trained.get(35) and not trained.get(24) and not rules.get(2) and rules.get(3, 1) and not rules.get(4, 1) and rules.get(5, 1)
        own = {self.names[i]: i for i in np.flatnonzero(kind == NORMAL).tolist()}
        if not plain or not np.isin(kind, (NORMAL, UNKNOWN, CONTROL, BYTE)).all() or any(MARK in x.lstrip(MARK) for x in own):
            raise ValueError("not a vocabulary of marked words, merged by score, with pieces for bytes")
        self.end = self.names.index("</s>")
        self.byte = np.zeros(256, np.int32)
        for i in np.flatnonzero(kind == BYTE).tolist():
            self.byte[int(self.names[i][3:5], 16)] = i
        # characters that are no piece of their own may still be part of one: they get numbers after the pieces
        letters = sorted({c for x in own for c in x})
        symbol = own | {c: len(rows) + k for k, c in enumerate(c for c in letters if c not in own)}
        self.stray = len(symbol) + len(rows)  # any other character
        self.of_point = np.full(0x110000, self.stray, np.int32)
        for c in letters:
            self.of_point[ord(c)] = symbol[c]
        self.alone = np.ones(0x110000, bool)  # in no longer piece
        for x in own:
            if len(x) > 1:
                for c in x:
                    self.alone[ord(c)] = False
        splits = [(symbol[x[:k]], symbol[x[k:]], i) for x, i in own.items() for k in range(1, len(x)) if x[:k] in symbol and x[k:] in symbol]
        left, right, made = np.array(splits, np.int64).reshape(-1, 3).T
        keys = left.astype(np.uint64) << SHIFT | right.astype(np.uint64)
        order = np.argsort(keys)
        rank = np.unique(-score, return_inverse=True)[1]  # equal scores have one rank
        self.keys, self.made = keys[order], made[order]
        self.ranks = rank[self.made].astype(np.int64)
        shown = [x.replace(MARK, " ").encode() for x in self.names]
        for i in np.flatnonzero(kind != NORMAL).tolist():
            shown[i] = bytes([int(self.names[i][3:5], 16)]) if kind[i] == BYTE else " ⁇ ".encode() if kind[i] == UNKNOWN else b""
        self.text = pool_of(shown)
        # where a long text may be cut: before a run of markers, after a line end that stands alone
        self.cut = re.compile(f"(?<![ {MARK}]) " + "|(?<=\n)" * bool(self.alone[10]))
        self.id_text = pool_of([b"%d " % i for i in range(len(rows))])
        self.table = WordTable()

    def _pairs(self, sym: np.ndarray, last: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that starts at each symbol of `at` (NONE: no such piece), and its piece."""
        key = sym[at].astype(np.uint64) << SHIFT | sym[np.minimum(at + 1, len(sym) - 1)].astype(np.uint64)
        place = np.searchsorted(self.keys, key)
        place[place == len(self.keys)] = 0
        found = (self.keys[place] == key) & ~last[at]
        return np.where(found, self.ranks[place], NONE), self.made[place]

    def merged(self, sym: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merges words (all symbols in a row, each word's first place): the symbols left, the place where each began, and
        how many a word has."""
        of_word = np.zeros(len(sym), np.int64)
        of_word[first[1:]] = 1
        number, where = np.cumsum(of_word), np.arange(len(sym))
        done: list[tuple[np.ndarray, ...]] = []
        sym, words = sym.astype(np.int64), len(first)
        last = np.append(number[1:] != number[:-1], True)
        rank, made = self._pairs(sym, last, np.arange(len(sym)))
        while len(sym):
            head = np.flatnonzero(np.append(True, last[:-1]))
            # of a word's pairs the least rank, then the leftmost
            best = np.minimum.reduceat((rank << PLACE) + np.arange(len(sym)), head)
            over = best >> PLACE == NONE
            size = np.diff(np.append(head, len(sym)))
            live = np.repeat(~over, size)
            done.append((number[~live], where[~live], sym[~live]))
            hit = best[~over] & ((1 << PLACE) - 1)
            sym[hit], last[hit] = made[hit], last[hit + 1]
            live[hit + 1] = False
            moved = np.zeros(len(sym), bool)
            moved[hit] = True
            moved[hit[hit > 0] - 1] = True
            sym, last, number, where, rank, made, moved = (x[live] for x in (sym, last, number, where, rank, made, moved))
            again = np.flatnonzero(moved)
            rank[again], made[again] = self._pairs(sym, last, again)
        number, where, sym = (np.concatenate([d[k] for d in done]) if done else np.zeros(0, np.int64) for k in range(3))
        order = np.argsort(where)
        return sym[order], where[order], np.bincount(number, minlength=words)

    def merged_long(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As merged(), for one long word: a heap of (rank, place) in one number each, entries that are outdated are passed over."""
        n = len(sym)
        last = np.zeros(n, bool)
        last[-1] = True
        rank, made = self._pairs(sym.astype(np.int64), last, np.arange(n))
        symbol, ranks, piece = (array("q", x.astype(np.int64).tobytes()) for x in (sym, rank, made))
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        heap = (np.flatnonzero(rank != NONE) + (rank[rank != NONE] << PLACE)).tolist()
        heapq.heapify(heap)
        keys, all_ranks, all_made, none = self.keys, self.ranks, self.made, int(NONE)

        def look(at: int) -> None:
            """What the pair at a place is now."""
            ranks[at] = none
            if after[at] < n:
                key = np.uint64(symbol[at] << int(SHIFT) | symbol[after[at]])
                place = int(keys.searchsorted(key))
                if place < len(keys) and keys[place] == key:
                    ranks[at], piece[at] = int(all_ranks[place]), int(all_made[place])
                    heapq.heappush(heap, (ranks[at] << PLACE) + at)

        while heap:
            top = heapq.heappop(heap)
            at = top & ((1 << PLACE) - 1)
            if ranks[at] != top >> PLACE or symbol[at] < 0:
                continue
            gone = after[at]
            symbol[at], symbol[gone], ranks[gone] = piece[at], -1, none
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            look(at)
            if before[at] >= 0:
                look(before[at])
        out = np.frombuffer(symbol, np.int64)
        where = np.flatnonzero(out >= 0)
        return out[where], where

    def segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in one array, and how many each has."""
        texts = [w.decode() for w in words]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        point = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        first = np.cumsum(size) - size
        sym = self.of_point[point]
        if not (size > LONG).any():
            left, where, n = self.merged(sym, first)
        else:
            short = np.repeat(size <= LONG, size)
            at = np.flatnonzero(short)
            parts, own = [], size[size <= LONG]
            n = np.zeros(len(words), np.int64)
            if len(own):
                left, where, n[size <= LONG] = self.merged(sym[at], np.cumsum(own) - own)
                parts.append((left, at[where]))
            for k in np.flatnonzero(size > LONG).tolist():
                left, where = self.merged_long(sym[first[k] : first[k] + size[k]])
                n[k] = len(left)
                parts.append((left, where + first[k]))
            left, where = (np.concatenate([p[k] for p in parts]) for k in range(2))
            order = np.argsort(where)
            left, where = left[order], where[order]
        bare = np.flatnonzero(left >= len(self.names))
        if not len(bare):
            return left.astype(np.int32), n
        # a character without a piece: as many ids as its bytes
        raw = np.frombuffer("".join(map(chr, point[where[bare]].tolist())).encode(), np.uint8)
        code = point[where[bare]]
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        times = np.ones(len(left), np.int64)
        times[bare] = width
        ids = np.repeat(left, times)
        ids[np.repeat(left >= len(self.names), times)] = self.byte[raw]
        word = np.repeat(np.arange(len(words)), n)
        return ids.astype(np.int32), np.bincount(word, times, len(words)).astype(np.int64)

    def encode_marked(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of texts, with markers for spaces, in one array, and how many each part has. A part's end is
        a place to cut."""
        if len(self.table.hash) > KEEP_WORDS or self.table.bytes.used > KEEP_BYTES:
            self.table.halve()
        joined = "".join(parts)
        point = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(size)
        mark, alone = point == ord(MARK), self.alone[point]
        start = alone | mark
        start[1:] &= ~mark[:-1] | alone[1:]
        start[1:] |= alone[:-1]
        start[(ends - size)[size > 0]] = True
        first = np.flatnonzero(start)
        part = np.searchsorted(ends, first, "right")
        width = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
        byte = np.concatenate([[0], np.cumsum(width)])
        begin, end = byte[first], byte[np.append(first[1:], len(point))]
        data = np.frombuffer(joined.encode(), np.uint8)
        h = word_hashes(data, begin, end)
        entry = self.table.find(h, data, begin, end)
        new = np.flatnonzero(entry < 0)
        if len(new):
            raw = data.tobytes()
            number: dict[bytes, int] = {}
            own = np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip(begin[new].tolist(), end[new].tolist(), strict=True)), np.int64, len(new))
            hashes = np.zeros(len(number), np.uint64)
            hashes[own] = h[new]
            entry[new] = own + len(self.table.hash)
            words = list(number)
            self.table.add(hashes, words, *self.segment(words), np.bincount(own))
        ids, n = self.table.ids.take(entry)
        return ids, np.bincount(part, n, len(parts)).astype(np.int64)

    def parts(self, text: str) -> Iterator[str]:
        """The text with a marker before it and for each space, in parts of about PIECE characters."""
        at = 0
        while len(text) - at > PIECE:
            cut = self.cut.search(text, at + PIECE)
            if cut is None:
                break
            yield MARK * (at == 0) + text[at : cut.start()].replace(" ", MARK)
            at = cut.start()
        if text:
            yield MARK * (at == 0) + text[at:].replace(" ", MARK)

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, in one array, and how many each text has."""
        found: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        held: list[str] = []
        of: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal held, of, size
            if held:
                ids, n = self.encode_marked(held)
                np.add.at(counts, of, n)
                found.append(ids)
            held, of, size = [], [], 0

        for k, text in enumerate(texts):
            for part in self.parts(text):
                held.append(part)
                of.append(k)
                size += len(part)
                if size > PIECE:
                    flush()
        flush()
        ids = np.concatenate([np.zeros(0, np.int32), *found])
        return np.insert(ids, np.cumsum(counts), self.end), counts + 1

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode_batch(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Each text's pieces joined, markers as spaces, without the marker put before it."""
        flat, n = self.text.take(ids)
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        raw = flat.tobytes()
        return [raw[a + (raw[a:b][:1] == b" ") : b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(np.array(ids, np.int64), np.array([len(ids)]))[0].decode("utf-8", "replace")

    def id_texts(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Each text's ids in decimal, joined by a space."""
        flat, n = self.id_text.take(ids)
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        raw = flat.tobytes()
        return [raw[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_LOADED: dict[str, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    key = hashlib.sha256(model).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids and the decoded text.

    The driver reads the vocabulary (half a MB, however large the table) and broadcasts it; rows never shuffle.
    """
    with open(path or vocabulary_path("piece_bpe_32k.model"), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(shared.value)
        for batch in batches:
            for part, texts in slices(batch, text_col):
                ids, counts = own.encode_batch([t.decode("utf-8", "replace") for t in texts])
                decoded = own.decode_batch(ids, counts)
                digests = [pa.array([hashlib.sha256(x).hexdigest() for x in side], pa.string()) for side in (own.id_texts(ids, counts), decoded)]
                cols = [part.column(0), pa.array(counts, pa.int64()), *digests]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    cols += [pa.ListArray.from_arrays(ends, ids), pa.array([x.decode() for x in decoded], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
