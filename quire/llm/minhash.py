"""MinHash fingerprints over word shingles, and near duplicates by signature bands.

Words are runs without ASCII white space; a shingle is five words in a row (all words of a shorter text). Shingle
hashes of a chunk of texts lie in one array; for each of PERMS multiply-add-shift hash functions one pass over it and
one segmented minimum give that component of every text's signature. A fingerprint is the signature's low 16 bits in
hex. For near duplicates, bands of the signature are joined in Spark and the exact Jaccard similarity decides.

Null and empty texts, and texts of white space, have no shingle: the fingerprint is all f, alike to each other (1.0)
and unlike any text with words (0.0). Equal texts have equal fingerprints. Texts go in whole. Rows with one doc_id
follow each other by their texts' hashes, rows without one come after all others likewise, and the first row follows the
last; a lone row follows itself. Ids are whole numbers. An empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import CHUNK_BYTES, Words, documents, mix, partitions, prefix, slices, span_hash

PERMS, SHINGLE = 128, 5
BANDS, ROWS = 25, 5  # of the signature, for near duplicates
_RNG = np.random.Generator(np.random.PCG64(20240229))
MULTIPLY = _RNG.integers(0, 1 << 63, 512, np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _RNG.integers(0, 1 << 63, 512, np.uint64)
EMPTY = np.uint32(0xFFFFFFFF)
STEP = 1 << 15  # shingles in one inner step: they stay in the processor's cache


def shingle_hashes(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles, and each text's first place among them (with the end)."""
    words = Words(texts)
    if not len(words.start):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    p = prefix(words.hashes())
    size = np.minimum(words.count, k)
    n = words.count - size + (words.count > 0)
    first = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(texts)), n)
    at = words.first[:-1][text] + np.arange(first[-1]) - first[:-1][text]
    return span_hash(p, at, at + size[text]) ^ mix(size[text].astype(np.uint64)), first


def signatures(hashes: np.ndarray, first: np.ndarray, perms: int = PERMS) -> np.ndarray:
    """One row of `perms` 32-bit minima for each text; all ones where a text has no shingle."""
    out = np.full((len(first) - 1, perms), EMPTY, np.uint32)
    for a in range(0, len(hashes), STEP):
        part = hashes[a : a + STEP]
        lo = np.searchsorted(first, a, "right") - 1
        hi = np.searchsorted(first, a + len(part), "left")
        rows = np.flatnonzero(np.diff(first[lo : hi + 1])) + lo  # texts with shingles here
        cuts = np.maximum(first[rows] - a, 0)
        for j in range(perms):
            v = (part * MULTIPLY[j] + ADD[j]) >> np.uint64(32)
            out[rows, j] = np.minimum(out[rows, j], np.minimum.reduceat(v, cuts).astype(np.uint32))
    return out


def hexed(signature: np.ndarray) -> list[str]:
    low = np.ascontiguousarray(signature.astype(np.uint16).astype(">u2"))
    return [row.tobytes().hex() for row in low]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal components of 16 bits; 1 for two empty texts."""
    return (a.astype(np.uint16) == b.astype(np.uint16)).mean(axis=1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", perms: int = PERMS) -> DataFrame:
    """id and `signature` (array of 32-bit minima as long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_col):
                sig = signatures(*shingle_hashes(texts), perms)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(sig.astype(np.int64)), pa.list_(pa.int64()))], names=[id_col, "signature"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, signature array<bigint>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: class_id (least id with its text), n_links, n_linked_docs, group_id, by bands of these
    signatures (BANDS of ROWS values; a pair at 0.8 shares none with a chance of 5e-5) joined in Spark and exact Jaccard
    similarity of 0.8 or more. Texts whose bands meet are compared block by block, so pairs never become rows."""
    from quire.llm.ngram_jaccard import jaccard_join

    return jaccard_join(docs, id_col, text_col, bands=BANDS, rows=ROWS, prune=False)


def followed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows in parts by descending id (rows without one last; of equal ids by hash and text), each part's successor row
    repeated at its end: _nil, _down, _tie (the order), id, text, _to (the part), _extra.

    The parts' edges are quantiles of the ids. An id that holds several quantiles, or rows without one, has as many parts
    of its own by the text's hash. Edges and first rows are one a part, so what the driver holds grows with the
    number of parts alone. The text moves once.
    """
    spark = docs.sparkSession
    parts = max(1, partitions(spark))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(F.isnull("id").cast("int").alias("_nil"), F.bitwise_not(F.coalesce("id", F.lit(0))).alias("_down"), F.xxhash64("text").alias("_tie"), "id", "text")
    n = docs.agg(F.count("*").alias("all"), F.count(id_col).alias("ids")).first()
    nil = -(-parts * (n["all"] - n.ids) // max(1, n["all"]))  # parts of the rows without an id
    some = max(1, parts - nil)
    edges = rows.stat.approxQuantile("id", [i / some for i in range(1, some)], 0.1 / some) if some > 1 and n.ids else []
    edges = np.sort(np.array(edges, np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def part(ids: pd.Series, tie: pd.Series) -> pd.Series:
        x = ids.fillna(0).to_numpy().astype(np.int64)
        low, high = np.searchsorted(edges, x, "left"), np.searchsorted(edges, x, "right")
        share = (tie.to_numpy().astype(np.float64) + 2.0**63) / (2.0**64 + 2.0**12)
        own = len(edges) - high + np.floor((high - low + 1) * share).astype(np.int64)
        return pd.Series(np.where(ids.isna().to_numpy(), len(edges) + 1 + np.floor(max(1, nil) * share).astype(np.int64), own).astype(np.int32))

    rows = rows.withColumn("_part", part("id", "_tie"))
    first = F.min(F.struct("_nil", "_down", "_tie")).alias("_first")
    heads = rows.groupBy("_part").agg(first).collect()
    full = sorted(h._part for h in heads)
    before = {p: full[k - 1] for k, p in enumerate(full)}  # the first follows the last
    marks = spark.createDataFrame([(h._part, *h._first, before[h._part]) for h in heads], "_part int, _nil int, _down long, _tie long, _before int")
    headed = rows.join(F.broadcast(marks), ["_part", "_nil", "_down", "_tie"], "left")  # one row a part: bounded
    order = ["_nil", "_down", "_tie", "id", "text"]
    to = F.array(F.struct(F.col("_part").alias("_to"), F.lit(0).alias("_extra")), F.struct(F.col("_before").alias("_to"), F.lit(1).alias("_extra")))
    both = headed.select(*order, F.explode(F.when(F.isnull("_before"), F.slice(to, 1, 1)).otherwise(to)).alias("x"))
    return both.select(*order, "x._to", "x._extra"), len(edges) + 1 + max(1, nil)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (its last third replaced by the start of the next text)."""
    rows, parts = followed(docs, id_col, text_col)
    dealt = rows.repartitionById(parts, "_to").sortWithinPartitions("_to", "_extra", "_nil", "_down", "_tie", "text")
    dealt = dealt.select("id", "text", "_to", "_extra")
    kind = docs.schema[id_col].dataType.simpleString()

    def table(ids: list, own: list[bytes], nexts: list[bytes]) -> pa.RecordBatch:
        chars = [t.decode("utf-8", "replace") for t in own]
        thirds = [len(c) // 3 for c in chars]
        edited = [(c[: len(c) - m] + n[: 4 * m].decode("utf-8", "ignore")[:m]).encode() for c, m, n in zip(chars, thirds, nexts, strict=True)]
        sig = signatures(*shingle_hashes([*own, *edited, nexts[-1]]))
        k = len(own)
        a, b, n = sig[:k], sig[k : 2 * k], np.concatenate([sig[1:k], sig[2 * k :]])
        return pa.RecordBatch.from_arrays([
            pa.array(ids, id_type), pa.array([len(c) for c in chars], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
            pa.array(hexed(a)), pa.array(hexed(b)), pa.array(likeness(a, b)), pa.array(likeness(a, n)),
        ], names=names)

    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    id_type = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[bytes] = []
        held, at, ended = 0, None, False
        for batch in batches:
            for i, t, to, extra in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if ended and to == at:
                    continue  # more rows of the next part's first id: only the first follows
                if to != at:
                    ids, texts, held, at, ended = [], [], 0, to, False
                texts.append(t)
                if extra:
                    yield table(ids, texts[:-1], texts[1:])
                    ids, texts, held, ended = [], [], 0, True
                    continue
                ids.append(i)
                held += len(t)
                if held > CHUNK_BYTES // 2 and len(ids) > 1:
                    yield table(ids[:-1], texts[:-1], texts[1:])
                    ids, texts, held = ids[-1:], texts[-1:], len(t)

    out = dealt.mapInArrow(run, f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn(id_col, F.col(id_col).cast(kind))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class, links and group by bands of the signatures, verified."""
    return near_duplicates(documents(spark, sf_dir))
