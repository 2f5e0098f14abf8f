"""Removal of every byte that lies in a 200-byte string which also starts elsewhere, by sharded suffix arrays.

Suffix arrays of shards can only meet if equal strings lie in one shard. Each 200-byte string has a key, the least
hash of the 100-byte grams in it, so equal strings have equal keys and neighbours mostly share one. Keys that occur
once in the corpus cannot hold a repeat and go; for the others the stretch of text under the key (about 250 bytes) is
dealt to a shard by the key. Each shard sorts the suffixes of its different stretches by induced sorting and reads the
permuted common prefixes: a string is repeated if its suffix has 200 bytes in common with a neighbour in the array, or
if its stretch occurs more than once. No string is ever compared by hash alone.

Equal texts are decided whole; one of each is a partner for others. Keys with more than SALT_ROWS
stretches are dealt in salted groups; what a group cannot decide goes on, one 200-byte string a row and one row for
each different string, to groups by key and string. So no task gathers a hot key.

Null is the empty text; texts under 200 bytes keep all. A long text is cut nowhere: keys and stretches are
those of the whole. A stretch of over PIECE_BYTES (a periodic text has one key all along) goes in pieces that share 199
bytes, so that each string starts in one of them, dealt to different groups. Every row stands for itself, whatever ids others have: rows that share a doc_id, and rows without
one, remove each other's strings like any others, and each gets a result of its own. Extra columns are left out; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, fetched, partitions, prefix, slices, sliding_min, span_hash, written
from quire.llm.suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 200, 100
WINDOWS = LENGTH - GRAM + 1
SALT_ROWS = 2_000  # stretches under one key in a group: about a shard
SHARD_BYTES = 1 << 19
PIECE_BYTES = 1 << 16  # starts of a stretch that go in one row
BREAK = 255  # between stretches; no byte of UTF-8 text plus one


def string_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes in one array, each text's first place in it (with the end), and by place the key of the
    200-byte string that starts there (whether or not it reaches into the next text)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    first = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    if len(data) < LENGTH:
        return data, first, np.zeros(0, np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    return data, first, sliding_min(gram_hashes(data, at), WINDOWS)


def gram_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    p = prefix(data.astype(np.uint64) + np.uint64(1))
    return span_hash(p, at, at + GRAM)


def occurrences(data: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The hashes of grams that are the key of some string around them, one for each place of such a gram."""
    if not len(keys):
        return np.zeros(0, np.int64)
    h = gram_hashes(data, np.arange(len(data) - GRAM + 1))
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    ends = np.full(WINDOWS - 1, most)
    around = most - sliding_min(np.concatenate([ends, most - keys, ends]), WINDOWS)  # the greatest key of strings around
    return h[around == h].view(np.int64)


def digests(docs: DataFrame) -> DataFrame:
    """doc, n_bytes, sha, keys (each with its number of places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                keys = []
                for t in texts:  # text by text: no gram reaches across
                    data, _, k = string_keys([t])
                    keys.append(occurrences(data, k))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc", "n_bytes", "sha", "keys"])

    return docs.mapInArrow(run, "doc long, n_bytes long, sha binary, keys array<long>")


STRETCHES = "h long, salt long, salts long, doc long, at long, piece binary"
NAMES = ["h", "salt", "salts", "doc", "at", "piece"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, TYPES, strict=True)], names=NAMES)


def stretches(docs: DataFrame) -> DataFrame:
    """The text under each key asked for. docs: doc, text, wanted array<struct<h, salts>>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                out = []
                for doc, text, wanted in zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist(), strict=True):
                    asked = {w["h"]: w["salts"] for w in wanted}
                    keys = string_keys([text])[2].view(np.int64)
                    edge = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ 1))
                    for s, e in zip(edge.tolist(), [*edge[1:].tolist(), len(keys)], strict=True):
                        if (salts := asked.get(int(keys[s]))) is not None:
                            for k, a in enumerate(range(s, e, PIECE_BYTES)):
                                out.append((int(keys[s]), (doc + s + k) % salts, salts, doc, a, text[a : min(e, a + PIECE_BYTES) - 1 + LENGTH]))
                if out:
                    yield packed(out)

    return docs.mapInArrow(run, STRETCHES)


def repeated(pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of different pieces: which of its 200-byte strings start elsewhere in them, and which of those come
    first of their kind in the suffix array."""
    text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int64) + 1, BREAK) for p in pieces] + [np.zeros(1, np.int64)])
    sa = suffix_array(text, 256)
    _, plcp = common_prefixes(text, sa)
    lcp = plcp[sa]  # with the one before
    before = lcp >= LENGTH
    after = np.append(before[1:], False)
    again, lead = np.zeros(len(text), bool), np.zeros(len(text), bool)
    again[sa[before | after]] = True
    lead[sa[after & ~before]] = True
    out, at = [], 0
    for p in pieces:
        n = len(p) - LENGTH + 1
        out.append((again[at : at + n], lead[at : at + n]))
        at += len(p) + 1
    return out


def settled(rows: DataFrame, parts: int) -> DataFrame:
    """Shards of whole groups (key, salt). Rows out: with a null key, a stretch [at, at + salts) of starts of repeated
    strings in doc; with a key, strings that other groups still decide (doc null: decided here, a partner only)."""
    dealt = rows.repartition(parts, "h", "salt").sortWithinPartitions("h", "salt")

    def shard(groups: list[tuple]) -> Iterator[pa.RecordBatch]:
        """groups: (h, salts, {piece: [(doc, at)]})"""
        open_ = [len(g[2]) > 1 or len(next(iter(g[2].values()))) == 1 for g in groups]  # else one stretch that occurs again
        several = [g for g, o in zip(groups, open_, strict=True) if o]
        told = iter(repeated([p for g in several for p in g[2]])) if several else iter(())
        out = []
        for (h, salts, pieces), o in zip(groups, open_, strict=True):
            for piece, places in pieces.items():
                n = len(piece) - LENGTH + 1
                again, lead = next(told) if o else (np.zeros(n, bool), np.zeros(n, bool))
                copies = len({x for x in places if x[0] is not None}) + any(x[0] is None for x in places)
                if copies > 1:  # the whole stretch occurs again
                    lead = lead | ~again
                    again = np.ones(n, bool)
                edge = np.flatnonzero(np.diff(again.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                for doc, at in places:
                    if doc is not None:
                        out += [(None, 0, b - a, doc, at + a, b"") for a, b in edge.tolist()]
                if salts > 1:
                    for k in np.flatnonzero(lead | ~again).tolist():
                        string = piece[k : k + LENGTH]
                        own = (places[0][0], places[0][1] + k) if not again[k] else (None, 0)
                        out.append((h, int.from_bytes(hashlib.sha256(string).digest()[:7]), 1, *own, string))
        if out:
            yield packed(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[tuple] = []
        now, held = None, 0
        for batch in batches:
            for h, salt, salts, doc, at, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h, salt) != now:
                    if held > SHARD_BYTES:
                        yield from shard(groups)
                        groups, held = [], 0
                    now = (h, salt)
                    groups.append((h, salts, {}))
                own = groups[-1][2].setdefault(piece, [])
                held += len(piece) if not own else 0
                own.append((doc, at))
        if groups:
            yield from shard(groups)

    return dealt.mapInArrow(run, STRETCHES)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """What is known of each row (doc, n_bytes, sha, copies, kind: the number of its text) and, for texts that occur once
    and lose a part, the removed starts: doc (the kind), text, gone array<struct<at, n>>."""
    parts = partitions(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    told = written(digests(plain))
    kinds = told.groupBy("sha").agg(F.min("doc").alias("first"), F.count("*").alias("copies"))
    kinds = written(kinds.withColumn("kind", F.monotonically_increasing_id()))
    known = told.select("doc", "n_bytes", "sha").join(kinds.select("sha", "copies", "kind"), "sha")
    one = told.where(F.size("keys") > 0).join(kinds, "sha").where(F.col("doc").eqNullSafe(F.col("first"))).dropDuplicates(["sha"])
    keys = written(one.select(F.col("kind").alias("doc"), F.explode("keys").alias("h")).groupBy("h", "doc").agg(F.count("*").alias("n")))
    hot = keys.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h", F.ceil(F.col("n") / SALT_ROWS).cast("long").alias("salts"))
    wanted = keys.select("h", "doc").join(hot, "h").groupBy("doc").agg(F.collect_list(F.struct("h", "salts")).alias("wanted"))
    places = kinds.select(F.col("kind").alias("doc"), "first", "sha")
    texts = fetched(plain, written(wanted.join(places, "doc"))).select("doc", "text", "wanted")
    first = written(settled(stretches(texts), parts))
    second = settled(first.where("h is not null"), parts)
    found = first.where("h is null").unionByName(second.where("h is null"))
    gone = found.groupBy("doc").agg(F.collect_list(F.struct("at", F.col("salts").alias("n"))).alias("gone"))
    gone = written(gone.join(kinds.where("copies = 1").select(F.col("kind").alias("doc"), "first", "sha"), "doc"))  # copies go whole
    return known, fetched(plain, gone).select("doc", F.coalesce("text", F.lit("")).alias("text"), "gone")


def cut(parts: DataFrame) -> DataFrame:
    """doc, n_bytes, n_removed, n_spans, kept (the remaining bytes) of documents that lose a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text, gone in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                delta = np.zeros(len(data) + 1, np.int64)
                np.add.at(delta, np.array([g["at"] for g in gone]), 1)
                np.add.at(delta, np.array([g["at"] + g["n"] - 1 + LENGTH for g in gone]), -1)
                off = np.cumsum(delta)[:-1] > 0
                runs = int((np.diff(off.astype(np.int8), prepend=0) > 0).sum())
                for c, x in zip(out, (doc, len(data), int(off.sum()), runs, data[~off].tobytes()), strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())], names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    return parts.select("doc", "text", "gone").mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, parts = spans(documents(spark, sf_dir))
    some = cut(parts).select(F.col("doc").alias("kind"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return known.join(some, "kind", "left").select(
        F.col("doc").alias("doc_id"), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )
