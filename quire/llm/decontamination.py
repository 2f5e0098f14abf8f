"""Benchmark decontamination with spaced seeds.

Words are lower-cased runs of letters, digits and other non-ASCII characters. Document and item are laid side by side;
an overlap is a run of WINDOW words (of the whole item, if that is shorter) of which MIN_EQUAL are equal, or a whole item
of which MIN_EQUAL are; at least SHORTEST words must be equal. All such runs count, joined where they touch and trimmed to
equal words at both ends. An item of fewer than SHORTEST words can't be told from chance within a text; it is an
overlap only where a document consists of just its words.

Fixed masks find the candidates: each looks at some word positions and ignores others, so a hit survives substitutions
there. WINDOW words with MIN_EQUAL equal hold two intact ones of their four parts of three words; so masks of two parts
at each distance miss none of them, and further distances and pairs of parts do the same for whole items. The
benchmark's seed hashes form a sorted table; every document's hashes are joined to it inside the scan, first through a
bitmap and then by binary search, and each diagonal with a hit is verified on the words around it.

The table goes to the executors in blocks of at most BLOCK_WORDS benchmark words (75 MB), one after the other, each a
pass over the documents: a larger benchmark costs passes, not memory. Documents never shuffle for one block. A seed
that many items hold is worked off in slices of SLICE hits.

Null texts and empty ones are clean. Repeated items count under each of their ids, in `items` and `spans`; an item
without an id is listed as null. Texts are searched whole. Every row of the documents gives one row, repeated or not;
columns with the names of the results give way. An empty benchmark or table is allowed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import Words, documents, mix, shielded, slices
from quire.sources.shared import written

WINDOW, SHORTEST, MIN_EQUAL = 12, 5, 0.8
PART = 3  # words in a part of a window
BLOCK_WORDS = 1 << 20
SLICE = 1 << 20  # seed hits, and words along diagonals, that are looked at together
FILTER_BITS = 20
FACTORS = np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 63, (64, WINDOW), np.uint64) * np.uint64(2) + np.uint64(1)
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain(text: bytes) -> bytes:
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(TABLE)


def least_equal(n: int) -> int:
    """Of n words, how many must be equal."""
    return max(math.ceil(MIN_EQUAL * n - 1e-9), min(n, SHORTEST))


def parted(n: int) -> list[list[int]]:
    """Pairs of parts of an n-word item: with k substitutions allowed, two of its k + 2 parts are intact."""
    parts = [p.tolist() for p in np.array_split(np.arange(n), n - least_equal(n) + 2)]
    return [a + b for a, b in combinations(parts, 2)] if n > SHORTEST else [list(range(n))]


def distances(n: int) -> list[int]:
    """How far two intact parts of an item of n words can be apart, in parts, if no two are nearer."""
    parts = n // PART
    intact = parts - (n - least_equal(n))
    return list(range(1, (parts - 1) // max(1, intact - 1) + 1))


@cache
def offsets() -> list[tuple[int, list[int]]]:
    """Item length (0: WINDOW and over) and the positions compared: two parts at each distance in a window, at further
    distances in whole items that need them, and pairs of parts of items shorter than a window."""
    two = lambda d: [*range(PART), *range(d * PART, (d + 1) * PART)]
    masks = [(0, two(d)) for d in range(1, WINDOW // PART)]
    masks += [(n, two(d)) for n in range(WINDOW, 5 * WINDOW) for d in distances(n) if d >= WINDOW // PART]
    return masks + [(n, o) for n in range(1, WINDOW) for o in parted(n)]


def seed_keys(h: np.ndarray, mask: int, places: list[int]) -> np.ndarray:
    """The hash of the mask's words at each place where it fits (across text ends too; callers leave those out)."""
    n = len(h) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, o in enumerate(places):
        out += h[o : o + n] * FACTORS[mask, k]
    return mix(out)


def ragged(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], ..., lo[0] + n[0] - 1, lo[1], ..."""
    ends = np.cumsum(n)
    return np.repeat(lo - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)


def sliced(n: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive entries with a sum of about `limit` (one entry at least)."""
    ends, a = np.cumsum(n), 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


class Seeds:
    """The sorted seed table of a block of benchmark items; items of the same words are one, with several ids."""

    def __init__(self, ids: list[int | None], texts: list[bytes]):
        own: dict[bytes, list[int | None]] = {}
        for i, t in zip(ids, texts, strict=True):
            own.setdefault(b" ".join(plain(t).split()), []).append(i)
        words = Words(list(own))
        self.ids, self.first, self.h = list(own.values()), words.first, words.hashes()
        keys, items, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.masks = []
        for m, (n, o) in enumerate(offsets()):
            k = seed_keys(self.h, m, o)
            at = np.arange(len(k))
            fits = words.text[at] == words.text[at + o[-1]] if len(at) else np.zeros(0, bool)
            size = words.count[words.text[at]]
            fits &= size >= WINDOW if n == 0 else (size == n) & ((n >= WINDOW) | (at == words.first[words.text[at]]))
            if fits.any():
                self.masks.append(m)
            keys.append(k[fits])
            items.append(words.text[at[fits]])
            places.append(at[fits])
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.place = key[order], np.concatenate(items)[order], np.concatenate(places)[order]
        copies = np.array([len(x) for x in self.ids], np.int64)
        self.weight = np.concatenate([[0], np.cumsum(copies[self.item])])  # of the entries before each
        self.bitmap = np.zeros(1 << FILTER_BITS, bool)
        self.bitmap[self.key >> np.uint64(64 - FILTER_BITS)] = True

    def overlaps(self, words: Words) -> tuple[np.ndarray, list[tuple[int, int | None, int, int]]]:
        """Seed hits of each text, and the overlaps: text, id of the item, first word (in the text) and end."""
        h = words.hashes()
        count = np.zeros(len(words.count), np.int64)
        out: set[tuple[int, int, int, int]] = set()
        for m in self.masks:
            o = offsets()[m][1]
            k = seed_keys(h, m, o)
            at = np.flatnonzero(self.bitmap[k >> np.uint64(64 - FILTER_BITS)])
            at = at[words.text[at] == words.text[at + o[-1]]]
            lo, n = np.searchsorted(self.key, k[at], "left"), np.searchsorted(self.key, k[at], "right")
            n -= lo
            at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
            np.add.at(count, words.text[at], self.weight[lo + n] - self.weight[lo])
            for a, b in sliced(n, SLICE):
                entry = ragged(lo[a:b], n[a:b])
                place = np.repeat(at[a:b], n[a:b])
                lines = np.unique(np.stack([words.text[place], self.item[entry], place - self.place[entry]]), axis=1)
                size = self.first[lines[1] + 1] - self.first[lines[1]]
                for c, d in sliced(size, SLICE):
                    out.update(self.verified(words, h, *lines[:, c:d]))
        return count, [(t, i, a, b) for t, item, a, b in sorted(out) for i in self.ids[item]]

    def verified(self, words: Words, h: np.ndarray, text: np.ndarray, item: np.ndarray, shift: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """The overlaps along diagonals: word i of the block's items lies beside word i + shift of the texts."""
        first, last = self.first[item], self.first[item + 1]
        lo, hi = np.maximum(first, words.first[text] - shift), np.minimum(last, words.first[text + 1] - shift)
        size, whole = last - first, hi - lo == last - first
        # an item of fewer words must be all of the document
        fit = (size >= SHORTEST) | (whole & (words.count[text] == size))
        text, item, shift, lo, hi, size, whole = (x[fit] for x in (text, item, shift, lo, hi, size, whole))
        n = hi - lo
        at = ragged(lo, n)
        equal = self.h[at] == h[at + np.repeat(shift, n)]
        total = np.concatenate([[0], np.cumsum(equal)])
        end = np.cumsum(n)
        begin = end - n
        # runs of `width` words that start at each place
        width = np.minimum(size, WINDOW)
        enough = np.array([least_equal(int(w)) for w in range(WINDOW + 1)])[width]
        starts = np.maximum(0, n - width + 1)
        at = ragged(begin, starts)
        wide = np.repeat(width, starts)
        good = total[at + wide] - total[at] >= np.repeat(enough, starts)
        delta = np.zeros(len(equal) + 1, np.int64)
        np.add.at(delta, at[good], 1)
        np.add.at(delta, (at + wide)[good], -1)
        all_of = whole & (total[end] - total[begin] >= np.maximum(np.ceil(MIN_EQUAL * size - 1e-9), np.minimum(size, SHORTEST)))
        np.add.at(delta, begin[all_of], 1)
        np.add.at(delta, end[all_of], -1)
        covered = np.cumsum(delta)[:-1] > 0
        line = np.repeat(np.arange(len(n)), n)
        fresh = np.ones(len(covered), bool)
        fresh[1:] = line[1:] != line[:-1]
        a = np.flatnonzero(covered & (fresh | ~np.concatenate([[False], covered[:-1]])))
        b = np.flatnonzero(covered & np.concatenate([~covered[1:] | fresh[1:], [True]])) + 1 if len(covered) else a
        at = np.flatnonzero(equal)
        if not len(a):
            return
        a, b = at[np.searchsorted(at, a)], at[np.searchsorted(at, b) - 1] + 1  # trimmed to equal words
        line = line[a]
        base = lo[line] - begin[line] + shift[line] - words.first[text[line]]
        yield from zip(text[line].tolist(), item[line].tolist(), (a + base).tolist(), (b + base).tolist(), strict=True)


#: What a pass over the documents adds, and what it becomes in the end.
FOUND = "n_hits long, found array<struct<item: bigint, a: int, b: int>>"
RESULTS = ("n_hits", "items", "matched_words", "spans", "contaminated")


def blocks(bench: DataFrame, id_col: str, text_col: str) -> Iterator[Seeds]:
    ids, texts, held = [], [], 0
    for r in bench.select(F.col(id_col).cast("long"), text_col).orderBy(id_col, text_col).toLocalIterator():
        text = (r[1] or "").encode()
        if ids and held + len(text) // 2 > BLOCK_WORDS:
            yield Seeds(ids, texts)
            ids, texts, held = [], [], 0
        ids.append(r[0])
        texts.append(text)
        held += len(text) // 2
    if ids:
        yield Seeds(ids, texts)


def contamination(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of docs (all by default) with n_hits, items (benchmark ids that overlap), matched_words
    (words of the document within an overlap), spans (item:first:end in words, comma-joined), contaminated."""
    spark = docs.sparkSession
    keep = [c for c in keep or docs.columns if c.lower() not in (*RESULTS, "found")]
    source = docs.select(*keep, *([] if text_col in keep else [text_col]))
    table = blocks(bench, item_col, item_text)
    first, second = next(table, None), next(table, None)
    if first is None:
        return told(docs.select(*keep, F.lit(0).cast("long").alias("n_hits"), F.array().cast("array<struct<item: bigint, a: int, b: int>>").alias("found")), keep)
    if second is None:
        return told(scanned(source, spark.sparkContext.broadcast(first), text_col, keep), keep)
    # several blocks: rows are numbered and written once; each block is sent, used and taken back before the next
    row = "_row"
    while row in source.columns:
        row += "_"
    numbered = written(source.withColumn(row, F.monotonically_increasing_id()))
    found = None
    for block in chain((first, second), table):
        shared = spark.sparkContext.broadcast(block)
        one = written(scanned(numbered, shared, text_col, [row]).where("n_hits > 0"))
        shared.destroy()
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy(row).agg(F.sum("n_hits").alias("n_hits"), F.flatten(F.collect_list("found")).alias("found"))
    return told(numbered.select(row, *keep).join(merged, row, "left"), keep)


def told(rows: DataFrame, keep: list[str]) -> DataFrame:
    """n_hits and found as the columns of the result."""
    spans = F.array_sort(F.coalesce("found", F.array().cast("array<struct<item: bigint, a: int, b: int>>")))
    zero = F.lit(0).cast("long")
    places = F.array_sort(F.transform("found", lambda x: F.struct(x["a"].cast("long").alias("a"), x["b"].cast("long").alias("b"))))
    start = F.struct(zero.alias("n"), zero.alias("end"))
    covered = F.aggregate(
        places, start,
        lambda s, x: F.struct((s["n"] + F.greatest(zero, x["b"] - F.greatest(x["a"], s["end"]))).alias("n"), F.greatest(s["end"], x["b"]).alias("end")), lambda s: s["n"],
    )
    text = F.transform("found", lambda x: F.concat_ws(":", F.coalesce(x["item"].cast("string"), F.lit("null")), x["a"].cast("string"), x["b"].cast("string")))
    return rows.withColumn("found", spans).select(
        *keep, F.coalesce("n_hits", zero).alias("n_hits"), F.array_distinct(F.transform("found", lambda x: x["item"])).alias("items"),
        covered.alias("matched_words"), F.array_join(text, ",").alias("spans"), (F.size("found") > 0).alias("contaminated"),
    )


def scanned(source: DataFrame, shared: Broadcast, text_col: str, keep: list[str]) -> DataFrame:
    """One pass: the columns `keep`, n_hits and found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        for batch in batches:
            for part, texts in slices(batch, text_col):
                words = Words([plain(t) for t in texts])
                count, found = seeds.overlaps(words)
                by: list[list] = [[] for _ in texts]
                for t, item, a, b in found:
                    by[t].append({"item": item, "a": a, "b": b})
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(count, pa.int64()), pa.array(by, kind)], names=[*keep, "n_hits", "found"])

    kind = pa.list_(pa.struct([("item", pa.int64()), ("a", pa.int32()), ("b", pa.int32())]))
    return source.mapInArrow(run, ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep) + ", " + FOUND)


def clean(docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the contaminated rows, columns as they were."""
    return shielded(docs, (*RESULTS, "found"), lambda d: contamination(d, bench, text_col).where(~F.col("contaminated")))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), benchmark(spark, sf_dir), keep=["doc_id"])
