"""Join of near-equal texts: word 5-gram Jaccard similarity of THRESHOLD or more, with Bayesian candidate pruning.

Equal texts are one class; only one text of each is compared, so copies never multiply. Texts that share a band key of
their MinHash signatures (32 bands of 5: a pair at 0.8 shares none with a chance of 3e-6) are candidates. Pairs stay
inside numpy: texts are dealt to blocks bounded in number and bytes, and two blocks (or one with itself) are compared
where a band key occurs in both. Sets that bands connect and that fit into one block share a block with others; a
larger set has blocks of its own by the least first text of its members' bands, so near copies lie together. To count all links
of N different near texts each of their blocks must meet each other one: a text moves N / BLOCK times. What leaves a
comparison are counts and a spanning forest, never pairs. Signatures are compared 16 values at a time; after n values
with m equal, a pair goes if the posterior chance (uniform prior) that its similarity reaches the threshold is below
TOLERANCE. Whatever stays is verified on the exact sets of shingles: hashes only sort them, the words decide.

Result, a row for each row of the table: doc_id, class_id (least doc_id of the rows with its text), n_links (other
classes linked to its class), n_linked_docs (other rows, copies included), group_id (least doc_id of the connected group
of links). Null counts as the empty text; texts without words have no links to other classes. A text under five words is
one shingle. Every row stands for itself: rows that share a doc_id, or have none, keep their own texts' classes; an id of
a class or group without any doc_id is null. Ties in similarity at the threshold are links. An empty table gives no
rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import NO_ID, Words, documents, eight, eights, fetched, mix, partitions, prefix, slices, span_hash, written
from quire.llm.minhash import SHINGLE, shingle_hashes, signatures
from quire.operators.components import connected_components

THRESHOLD, BANDS, ROWS = 0.8, 32, 5
STEP, TOLERANCE = 16, 1e-6
BLOCK, BLOCK_BYTES, SMALL = 4000, 1 << 22, 300  # texts and bytes in a block (a task holds two); texts of small sets together


def least_matches(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest equal values of n at which the similarity may still reach the threshold: under a uniform prior the
    posterior chance of that after m matches is P(Binomial(n + 1, threshold) <= m)."""
    chance = 0.0
    for m in range(n + 1):
        chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if chance >= tolerance:
            return m
    return n


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band (the band's number is part of it)."""
    values = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        key = mix((key ^ values[:, :, r]) * np.uint64(0xD1342543DE82EF95))
    return key.view(np.int64)


def keyed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc, sha, n_bytes, keys (band keys; none for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                hashes, first = shingle_hashes(texts)
                keys = band_keys(signatures(hashes, first, bands * rows), bands, rows)
                some = np.diff(first) > 0
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([k if s else [] for k, s in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                ], names=["doc", "sha", "n_bytes", "keys"])

    return docs.mapInArrow(run, "doc long, sha binary, n_bytes long, keys array<long>")


def word_numbers(words: Words, h: np.ndarray) -> np.ndarray:
    """A number for each different word: by hash, if all words of one hash are the same bytes, else by the bytes."""
    _, rep, number = np.unique(h, return_index=True, return_inverse=True)
    other, n = rep[number], words.end - words.start
    same = bool((n == n[other]).all())
    loads, live, k = eights(words.data), np.arange(len(n)), 0
    while same and len(live):
        left = n[live] - k
        same = bool((eight(loads, words.start[live] + k, left) == eight(loads, words.start[other[live]] + k, left)).all())
        live = live[left > 8]
        k += 8
    if same:
        return number
    seen: dict[bytes, int] = {}
    data = words.data.tobytes()
    return np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)], np.int64)


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the different shingles of each text in one array, each text's first place (with the end), and the hash of
    each number. Shingles of one number are the same words."""
    words = Words(texts)
    h = words.hashes()
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64)
    word = word_numbers(words, h)
    size = np.minimum(words.count, k)
    n = words.count - size + (words.count > 0)
    first = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(texts)), n)
    at = words.first[:-1][text] + np.arange(first[-1]) - first[:-1][text]
    own = size[text]
    hashes = span_hash(prefix(h), at, at + own) ^ mix(own.astype(np.uint64))
    distinct, rep, number = np.unique(hashes, return_index=True, return_inverse=True)
    other = rep[number]
    same = bool((own == own[other]).all())
    for j in range(k):
        inside = own > j
        same = same and bool((word[at[inside] + j] == word[at[other[inside]] + j]).all())
    if not same:  # one hash for two shingles: number them by their words
        seen: dict[tuple, int] = {}
        number = np.array([seen.setdefault(tuple(word[a : a + m].tolist()), len(seen)) for a, m in zip(at.tolist(), own.tolist(), strict=True)], np.int64)
        distinct = np.zeros(len(seen), np.uint64)
        distinct[number] = hashes
    order = np.lexsort((number, text))
    number, text = number[order], text[order]
    new = np.ones(len(number), bool)
    new[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
    number, text = number[new], text[new]
    return number, np.searchsorted(text, np.arange(len(texts) + 1)), distinct


def surviving(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (rows i of a, j of b) that no step of the comparison drops."""
    equal = np.zeros(len(i), np.int64)
    for n in range(STEP, a.shape[1] + 1, STEP):
        if not len(i):
            break
        for k in range(n - STEP, n):
            equal += a[i, k] == b[j, k]
        stay = equal >= least_matches(n)
        i, j, equal = i[stay], j[stay], equal[stay]
    return i, j


def linked(a: list[bytes], b: list[bytes] | None, prune: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """For each text of a, the numbers of the texts of b (later ones of a, if b is None) that it is linked to."""
    ids, first, hashes = shingle_sets(a + (b or []))
    sig = signatures(hashes[ids], first, BANDS * ROWS) if prune else None
    size = np.diff(first)
    low = len(a) if b is not None else 0
    mark = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    for i in range(len(a)):
        j = np.arange(low if b is not None else i + 1, len(size))
        near = (np.minimum(size[j], size[i]) >= THRESHOLD * np.maximum(size[j], size[i]) - 1e-9) & (size[j] > 0) & (size[i] > 0)
        j = j[near]
        if prune:
            j = surviving(sig, sig, np.full(len(j), i), j)[1]
        if not len(j):
            yield i, j
            continue
        own = ids[first[i] : first[i + 1]]
        mark[own] = True
        n = size[j]
        at = np.repeat(first[j] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.add.reduceat(mark[ids[at]].astype(np.int64), np.cumsum(n) - n)
        mark[own] = False
        # intersection / union >= THRESHOLD in whole numbers
        yield i, j[both * 10 >= round(THRESHOLD * 10) * (size[i] + n - both)] - low


def block_links(pdf: pd.DataFrame, prune: bool = True) -> pd.DataFrame:
    """One pair of blocks (or one block with itself): doc, root, links, copies for each text in a link."""
    mixed = pdf["i"].iloc[0] != pdf["j"].iloc[0]
    pdf = pdf.sort_values(["block", "doc"])
    left = pdf[pdf["block"] == pdf["i"].iloc[0]] if mixed else pdf
    right = pdf[pdf["block"] == pdf["j"].iloc[0]] if mixed else pdf
    n, m = len(left), len(right)
    docs = np.concatenate([left["doc"].to_numpy(), right["doc"].to_numpy()]) if mixed else left["doc"].to_numpy()
    weight = np.concatenate([left["copies"].to_numpy(), right["copies"].to_numpy()]) if mixed else left["copies"].to_numpy()
    links, copies, root = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64), np.arange(len(docs))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    if n and m:
        for i, j in linked([t.encode() for t in left["text"]], [t.encode() for t in right["text"]] if mixed else None, prune):
            if len(j):
                at = j + n if mixed else j
                links[i] += len(at)
                copies[i] += weight[at].sum()
                links[at] += 1
                copies[at] += weight[i]
                for x in at.tolist():
                    p, q = find(i), find(x)
                    if p != q:
                        root[max(p, q)] = min(p, q)
    at = np.flatnonzero(links)
    return pd.DataFrame({"doc": docs[at], "root": docs[[find(x) for x in at.tolist()]] if len(at) else docs[:0], "links": links[at], "copies": copies[at]})


def joined(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, prune: bool = True) -> tuple[DataFrame, DataFrame]:
    """docs: doc, text. The rows (doc, sha) and the classes: sha, first (least doc), kind (number), copies, n_links,
    n_linked_docs, group (the least kind of its group)."""
    parts = partitions(docs.sparkSession)
    told = written(keyed(docs, bands, rows))
    kinds = told.groupBy("sha").agg(F.min("doc").alias("first"), F.count("*").alias("copies"), F.min("n_bytes").alias("n_bytes"))
    kinds = written(kinds.withColumn("kind", F.monotonically_increasing_id()))
    reps = told.join(kinds, "sha").where(F.col("doc").eqNullSafe(F.col("first"))).dropDuplicates(["sha"])
    banded = written(reps.select("kind", F.explode("keys").alias("key")))
    shared = banded.groupBy("key").agg(F.min("kind").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    # a text is linked to the least of its bands' heads, and that head to the others: the same connected sets with
    # one link a text, and few links between heads
    hits = written(banded.join(shared, "key").select("kind", "key", "head"))
    heads = written(hits.groupBy("kind").agg(F.min("head").alias("root"), F.collect_set("head").alias("heads")))
    between = heads.select("root", F.explode("heads").alias("head")).where("root <> head").distinct()
    stars = heads.select(F.col("kind").alias("a"), F.col("root").alias("b")).unionByName(between.select(F.col("head").alias("a"), F.col("root").alias("b")))
    sets = connected_components(stars).withColumnRenamed("node", "kind")
    members = written(sets.join(heads.select("kind", "root"), "kind").join(kinds, "kind"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_bytes") / BLOCK_BYTES)).alias("blocks")
    large = members.groupBy("component").agg(blocks).where("blocks > 1").select("component", F.lit(True).alias("large"))
    members = members.join(large, "component", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    small = members.where("not large").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
    units = 1 + max(small.n // SMALL, small.b // BLOCK_BYTES)
    within = members.where("large").groupBy("root").agg(blocks)
    members = members.join(within, "root", "left")
    # sets of one block share blocks (more pairs are looked at, none is lost)
    own = F.xxhash64("root", F.pmod(F.xxhash64("kind"), "blocks"))
    members = written(members.select("kind", "first", "sha", "copies", "large", F.when(F.col("large"), own).otherwise(F.pmod(F.xxhash64("component"), F.lit(units))).alias("block")))
    # pairs of blocks: each with itself, and those of large sets that hold a common band key
    meet = hits.join(members.where("large").select("kind", "block"), "kind").groupBy("key").agg(F.array_sort(F.collect_set("block")).alias("b")).where("size(b) > 1")
    meet = meet.select(F.posexplode("b").alias("at", "i"), "b").select("i", F.explode(F.expr("slice(b, at + 2, size(b))")).alias("j")).distinct()
    once = members.select(F.col("block").alias("i"), F.col("block").alias("j")).distinct()
    meet = written(meet)
    places = once.unionByName(meet).withColumn("block", F.col("i")).unionByName(meet.withColumn("block", F.col("j")))
    texts = fetched(docs, members).select("block", F.col("kind").alias("doc"), "copies", F.coalesce("text", F.lit("")).alias("text"))
    pairs = texts.join(places, "block").repartition(parts, "i", "j")
    found = written(pairs.groupBy("i", "j").applyInPandas(lambda pdf: block_links(pdf, prune), "doc long, root long, links long, copies long"))
    counts = found.groupBy("doc").agg(F.sum("links").alias("n_links"), F.sum("copies").alias("linked"))
    groups = connected_components(found.where("doc <> root").select(F.col("doc").alias("a"), F.col("root").alias("b")))
    each = kinds.join(counts.withColumnRenamed("doc", "kind"), "kind", "left").join(groups.withColumnRenamed("node", "kind"), "kind", "left")
    each = each.select(
        "sha", "first", "kind", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_linked_docs"), F.coalesce("component", "kind").alias("group"),
    )
    return told.select("doc", "sha"), written(each)


def plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, prune: bool = True) -> DataFrame:
    """doc_id, class_id, n_links, n_linked_docs, group_id of every row; see the module's text. Without pruning every pair of
    texts in blocks that meet is verified."""
    ids, each = joined(plain(docs, id_col, text_col), bands, rows, prune)
    groups = each.groupBy("group").agg(F.min("first").alias("group_id"))
    each = each.join(groups, "group").select("sha", F.col("first").alias("class_id"), "n_links", "n_linked_docs", "group_id")
    return ids.withColumnRenamed("doc", id_col).join(each, "sha").drop("sha")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group, columns as they were: that of the least id (rows without one come last), of these
    the least digest of the text, of rows equal in both the least by all columns."""
    _, each = joined(plain(docs, id_col, text_col))
    least = F.min(F.struct(F.col("first").isNull(), F.col("first"), F.col("sha")))
    kept = written(each.groupBy("group").agg(least.alias("k")).select(F.coalesce("k.first", F.lit(NO_ID)).alias("__id"), F.col("k.sha").alias("__sha")))
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    rows = docs.withColumns({"__id": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "__sha": digest}).join(kept, ["__id", "__sha"], "left_semi")
    return rows.groupBy("__id", "__sha").agg(F.min(F.struct(*[f"`{c}`" for c in docs.columns])).alias("__row")).select("__row.*")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))
