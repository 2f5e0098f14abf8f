"""What several training-data operators share: shared tables, chunks of documents, word hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.shared import written  # noqa: F401

#: Bytes of text that one vectorised step holds at once (a single longer text still goes whole).
CHUNK_BYTES = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
BASE2 = np.uint64(0xD1342543DE82EF95)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_index(df: DataFrame, keys: list[str], order: list, name: str, tie: str, parts: int) -> DataFrame:
    """Adds `name`: a gapless 0-based index within `keys`, without bringing a key's rows to one task.

    Rows go to (keys, pmod(hash(tie), parts)) cells; each cell is numbered alone and starts where the cells
    before it end. The table of cell counts has at most parts rows for each key.
    """
    celled = df.withColumn("_cell", F.pmod(F.xxhash64(F.col(tie)), F.lit(parts)).cast("int"))
    from pyspark.sql import Window

    counts = celled.groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = Window.partitionBy(*keys, "_cell").orderBy(*order)
    numbered = celled.withColumn("_rn", F.row_number().over(own) - 1)
    return numbered.join(offsets, [*keys, "_cell"]).withColumn(name, (F.col("_rn") + F.col("_off")).cast("long")).drop("_rn", "_off", "_cell")


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of a batch of about `limit` bytes of text, each with its texts as UTF-8 (null: empty). Only one piece
    at a time is held outside the batch."""
    at = batch.schema.get_field_index(column)
    lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        held = int(ends[start] - lengths[start])
        stop = max(start + 1, int(np.searchsorted(ends, held + limit, "right")))
        part = batch.slice(start, stop - start)
        yield part, [b"" if x is None else x for x in part.column(at).cast(pa.binary()).to_pylist()]
        start = stop
    pa.default_memory_pool().release_unused()


def shielded(docs: DataFrame, taken: tuple[str, ...], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """apply(docs) with the columns of docs alone, as they were, also those whose names `apply` uses for its own."""
    own = {c: f"_own_{k}" for k, c in enumerate(docs.columns) if c.lower() in taken}
    return apply(docs.withColumnsRenamed(own)).select(*[F.col(own.get(c, f"`{c}`")).alias(c) for c in docs.columns])


SIEVE_BITS = 1 << 26


def sieve(ids: DataFrame, id_col: str) -> DataFrame:
    """(_bucket, _map): a bit for each hash of the ids, 8 MB at most whatever the number of ids (2048 bitmaps of 4 KB,
    made by a distributed aggregate). It only spares work: with very many ids all bits are set and every row passes."""
    position = F.pmod(F.xxhash64(id_col), F.lit(SIEVE_BITS)) + 1
    bits = ids.select(F.bitmap_bucket_number(position).alias("_bucket"), F.bitmap_bit_position(position).alias("_bit"))
    return bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))


def sieved(docs: DataFrame, id_col: str, bitmaps: DataFrame) -> DataFrame:
    """The rows of docs whose id may be among the sieve's, before any shuffle of their texts."""
    position = F.pmod(F.xxhash64(id_col), F.lit(SIEVE_BITS)) + 1
    bit = F.bitmap_bit_position(position)
    byte = F.conv(F.hex(F.substring(F.col("_map"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    hit = docs.withColumn("_bucket", F.bitmap_bucket_number(position)).join(F.broadcast(bitmaps), "_bucket")
    return hit.where(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1).select(*docs.columns)


NO_ID = -(1 << 63)  # stands for a missing id in joins


def fetched(docs: DataFrame, wanted: DataFrame, digest: Column | None = None) -> DataFrame:
    """The rows of `wanted` (first: an id or null; sha: digest of a text with that id) with that text, each once.

    docs: doc (long), text. Id and digest find a text together, so rows that share an id, or have none, stay apart.
    Rows whose id nothing asks for go before the shuffle; those without an id are first reduced to different texts.
    """
    if digest is None:
        digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    wanted = wanted.withColumn("_id", F.coalesce("first", F.lit(NO_ID)))
    some = sieved(docs.where("doc is not null").select(F.col("doc").alias("_id"), "text"), "_id", sieve(wanted, "_id"))
    none = docs.where("doc is null").groupBy(digest.alias("sha")).agg(F.first("text").alias("text"))
    rows = some.select("_id", digest.alias("sha"), "text").unionByName(none.select(F.lit(NO_ID).alias("_id"), "sha", "text"))
    return rows.join(wanted, ["_id", "sha"]).dropDuplicates(["_id", "sha"]).drop("_id")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        size = max(1 << 19, 1 << int(n - 1).bit_length())
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        have = tuple(np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, b, np.uint64))]) for b in (base, inverse))
        if size <= 1 << 20:  # longer tables are not kept
            _POWERS[int(base)] = have
    return have


def prefix(values: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """P[i] = sum of values[j] * base**j for j < i; span hashes follow by subtraction."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values), base)[0][: len(values)], out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Hash of values[start:end] for many spans, whatever their place."""
    return mix((p[end] - p[start]) * powers(len(p), base)[1][start])


#: The first k bytes of eight, and blanks for the others.
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_BLANK = np.uint64(0x2020202020202020) & ~_LOW
_LONG = 256  # bytes of a word from which it is hashed by BLAKE2


def eights(data: np.ndarray, pad: bool = True) -> np.ndarray:
    """The eight bytes that start at each place, as one number (a view; blanks are put after the end if asked for)."""
    padded = np.concatenate([data, np.full(8, 32, np.uint8)]) if pad else data
    return np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))


def eight(loads: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Up to n of the eight bytes at each place, blanks for the rest: no word holds a blank, so none is like another."""
    k = np.minimum(n, 8)
    return (loads[at] & _LOW[k]) | _BLANK[k]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of words (byte spans). Words of up to eight bytes have different hashes for certain; longer ones are
    chained in eights through a mixing that is no polynomial, very long ones go through BLAKE2."""
    loads, n = eights(data), end - start
    own = np.uint64((seed * 0x9FB21C651E98DF25 + 0x2545F4914F6CDD1D) % (1 << 64))
    h = mix(eight(loads, start, n) ^ own)
    live, k = np.flatnonzero(n > 8), 8
    while len(live):
        if k == _LONG:
            for i in live.tolist():
                digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little")).digest()
                h[i] = np.frombuffer(digest, np.uint64)[0]
            break
        v = mix(eight(loads, start[live] + k, n[live] - k) + own)
        h[live] = mix((h[live] + np.uint64(k)) * BASE2 ^ v)
        k += 8
        live = live[n[live] > k]
    return h


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of several texts: byte spans, text numbers, 64-bit hashes."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        edge = np.flatnonzero(np.diff(space, prepend=True))
        self.start, self.end = edge[0::2], edge[1::2]
        if len(self.end) < len(self.start):
            self.end = np.append(self.end, len(self.data))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.base = np.concatenate([[0], np.cumsum(lengths)])[: len(texts)]
        self.first = np.searchsorted(self.start, np.append(self.base, len(self.data)))  # of each text, and the end
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return word_hashes(self.data, self.start, self.end, seed)

    def windows(self, k: int) -> np.ndarray:
        """Word numbers at which k words of one text start."""
        at = np.arange(max(0, len(self.start) - k + 1))
        return at[self.text[at] == self.text[at + k - 1]] if len(at) else at


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w values in a row, in a constant number of passes (block-wise prefix and suffix minima)."""
    n = len(x)
    if w <= 1 or n < w:
        return x.copy() if w <= 1 else x[:0]
    pad = (-n) % w
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])
