"""Incremental removal of repeated 50-word windows with a log-structured fingerprint index.

The index is a log of immutable runs, tables bucketed and sorted by key, that hold the hashes of every window seen:
  windows  (h, doc, t, at, w[])   w: hashes of consecutive windows of one document (t: digest of its text) from word `at`
  kinds    (sha, doc)             digests of whole word sequences, with the first document of each
The key h of a window is the least hash of the 25-word grams in it, so equal windows have equal keys, and about 13
consecutive windows share a row. A new batch becomes a run of its own and is merge-joined with the runs of the log by
key; under a shared key, windows of equal hash are candidates, the document with the least number being the source of
the others. Candidates are then verified: the words of each candidate stretch and of its source are compared by their
SHA-256. A stretch that fails (two different windows of one hash) is settled by digests of the single windows
under its key.

Before a batch goes in, the newest runs are compacted into one while they are of like size; of rows with equal hashes the
one of the least document stays. So a document's rows are rewritten a number of times logarithmic in the number of
batches. The log stays in the catalogue under its name until drop(); another Index of that name goes on from there.

Documents with the same word sequence as an earlier one are decided whole. Keys with many rows are dealt in salted
groups, each of which sends on the windows of one document for each different hash, so no task gathers a hot key.

Null and empty texts have no words. A text under 50 words keeps all. Words are `[^\\x20\\x09-\\x0D]+`, unchanged. Of
rows with one doc_id (and of a window repeated within a document) none is smaller, so they don't remove each other;
each is cut by itself. Rows without a doc_id are treated as one document before all others. Batches must come in ascending
order of doc_id. An empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import BASE2, NO_ID, Words, documents, fetched, partitions, prefix, sieve, sieved, slices, sliding_min, span_hash, written
from quire.sources.shared import shared_dir

WINDOW, GRAM = 50, 25
SALT_ROWS = 20_000  # rows under one key in a salted group
RUNS = "quire_runs"  # the schema of the runs where no warehouse is named
BITS = 32  # of a window's hash that the log holds, beside the 64 of its key


def text_digest(text: Column) -> Column:
    """The first eight bytes of the text's SHA-256 as a number, as window_rows() has it."""
    return F.conv(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 16), 16, -10).cast("long")


def window_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers at which windows start, and each window's key."""
    at = words.windows(WINDOW)
    if not len(at):
        return at, np.zeros(0, np.int64)
    grams = np.arange(len(words.start) - GRAM + 1)
    p = prefix(words.hashes())
    least = sliding_min(span_hash(p, grams, grams + GRAM), WINDOW - GRAM + 1)
    return at, least[at].view(np.int64)


def digests(docs: DataFrame) -> DataFrame:
    """doc, n_words, sha (of the words joined by a space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = [t.split() for t in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).digest() for w in words], pa.binary()),
                ], names=["doc", "n_words", "sha"])

    return docs.mapInArrow(run, "doc long, n_words long, sha binary")


def window_rows(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(h, doc, t, at, w): all windows of each document; consecutive windows of one key share a row. docs: doc, text."""
    low = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = Words(texts)
                at, keys = window_keys(words)
                if not len(at):
                    continue
                w = (span_hash(prefix(words.hashes(2), BASE2), at, at + WINDOW, BASE2) & low).astype(np.uint32).view(np.int32)
                text = words.text[at]
                first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])]))
                t = np.array([int.from_bytes(hashlib.sha256(x).digest()[:8], signed=True) for x in texts], np.int64)
                ends = np.append(first, len(at)).astype(np.int32)
                place = (at - words.first[text])[first]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[first]), part.column(0).take(pa.array(text[first])), pa.array(t[text[first]]), pa.array(place.astype(np.int32)), pa.ListArray.from_arrays(ends, w),
                ], names=["h", "doc", "t", "at", "w"])

    return docs.mapInArrow(run, "h long, doc long, t long, at int, w array<int>")


#: Rows of a group, and what is decided in it: a stretch of n windows (its rows' salt is null) with its source.
GROUPED = "h long, salt long, salts long, doc long, t long, old boolean, at int, w array<int>, n int, s_doc long, s_t long, s_at int"
NAMES = [x.split(" ")[0] for x in GROUPED.split(", ")]
TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.int64(), pa.int32()]


def decided(rows: DataFrame, parts: int) -> DataFrame:
    """Stretches of windows that have an equal hash under the same key in a smaller document (n: how many), and, with a
    salt, the windows that other salted groups still decide."""
    dealt = rows.repartition(parts, "h", "salt").sortWithinPartitions("h", "salt")

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        lists = table["w"].combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        w = lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(lengths)), lengths)
        at = table["at"].to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        h, salt, salts, doc, t, old = (table[c].to_numpy(zero_copy_only=False) for c in NAMES[:6])
        group = np.cumsum(np.concatenate([[0], (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])]))[row]
        order = np.lexsort((at, doc[row], w, group))
        new = np.ones(len(order), bool)
        new[1:] = (w[order][1:] != w[order][:-1]) | (group[order][1:] != group[order][:-1])
        head = np.flatnonzero(new)
        source = np.empty(len(order), np.int64)  # of each window, the first of its group
        source[order] = np.repeat(order[head], np.diff(np.append(head, len(order))))
        least = doc[row[source]]
        gone = np.flatnonzero((doc[row] > least) & ~old[row])
        if len(gone):
            src = source[gone]
            fresh = np.ones(len(gone), bool)
            fresh[1:] = (gone[1:] != gone[:-1] + 1) | (row[gone][1:] != row[gone][:-1]) | (src[1:] != src[:-1] + 1) | (row[src][1:] != row[src][:-1])
            k = np.flatnonzero(fresh)
            a, b = gone[k], src[k]
            n = np.diff(np.append(k, len(gone)))
            ra, rb = row[a], row[b]
            cols = [h[ra], None, None, doc[ra], t[ra], None, at[a], None, n, doc[rb], t[rb], at[b]]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(k), ty) if c is None else pa.array(c).cast(ty) for c, ty in zip(cols, TYPES, strict=True)], names=NAMES)
        # of windows in a salted group, the least document's stay open (all its places)
        k = np.flatnonzero((salts[row] > 1) & (doc[row] == least))
        if len(k):
            r = row[k]
            one = pa.ListArray.from_arrays(np.arange(len(k) + 1, dtype=np.int32), w[k])
            cols = [h[r], w[k], np.ones(len(k)), doc[r], t[r], old[r], at[k], one, None, None, None, None]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(k), ty) if c is None else c if c is one else pa.array(c).cast(ty) for c, ty in zip(cols, TYPES, strict=True)], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 20_000:  # whole groups up to the last one go
                table = pa.Table.from_batches(held)
                h, salt = table["h"].to_numpy(), table["salt"].to_numpy()
                cut = int(np.flatnonzero((h != h[-1]) | (salt != salt[-1]))[-1] + 1) if (h[0], salt[0]) != (h[-1], salt[-1]) else 0
                if cut:
                    yield from settle(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if size:
            yield from settle(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, GROUPED)


def warehouse_is_default(spark: SparkSession) -> bool:
    """Whether the warehouse is the folder that Spark takes where none is named."""
    scheme, _, path = spark.conf.get("spark.sql.warehouse.dir").rpartition(":")
    return scheme in ("", "file") and os.path.normpath(path) == os.path.join(os.getcwd(), "spark-warehouse")


def schema_of_runs(spark: SparkSession) -> str:
    """The schema whose folder all executors share: the current one in a warehouse that has been named, else one of its own
    in the shared folder, since the default warehouse is a folder of the driver alone."""
    if not warehouse_is_default(spark):
        return spark.catalog.currentDatabase()
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {RUNS} LOCATION '{shared_dir(spark)}/{RUNS}'")
    return RUNS


class Index:
    """A named log of runs. match() takes the next batch into it and tells which stretches may have been seen."""

    def __init__(self, spark: SparkSession, name: str, bits: int = BITS):
        """Goes on with the runs of that name in the catalogue, if there are any."""
        self.spark, self.name, self.bits, self.schema = spark, name, bits, schema_of_runs(spark)
        self.runs: dict[str, list[tuple[int, str]]] = {"windows": [], "kinds": []}  # (rows, table), oldest first
        for t in sorted(f"{self.schema}.{x.name}" for x in spark.catalog.listTables(self.schema, f"{name}__*")):
            rows = spark.sql(f"SHOW TBLPROPERTIES {t} ('quire.rows')").first()[1]
            self.runs[t.rsplit("__", 3)[1]].append((int(rows), t))

    def _run(self, kind: str, df: DataFrame, key: str, dealt: bool = False) -> None:
        """df as the newest run: bucketed by key, sorted, one file a bucket, in the schema that executors share.
        dealt: its rows have been dealt by the key already."""
        parts = partitions(self.spark)
        number = 1 + max((int(t.rsplit("__", 3)[2]) for r in self.runs.values() for _, t in r), default=-1)
        table = f"{self.schema}.{self.name}__{kind}__{number:08d}__{uuid.uuid4().hex[:8]}"
        (df if dealt else df.repartition(parts, key)).write.bucketBy(parts, key).sortBy(key).format("parquet").saveAsTable(table)
        rows = self.spark.table(table).count()
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('quire.rows' = '{rows}')")
        self.runs[kind].append((rows, table))

    def _plain(self, table: str) -> DataFrame:
        """A run's files without its buckets. A union of bucketed tables passes for one that is dealt by the key, so that
        Spark leaves out the repartition after it; a union of plain files doesn't."""
        place = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()[1]
        return self.spark.read.schema(self.spark.table(table).schema).parquet(place)

    def compact(self, kind: str, key: str) -> None:
        """Merges the newest runs while they are of like size (the older under twice the newer)."""
        runs = self.runs[kind]
        while len(runs) > 1 and runs[-2][0] < 2 * runs[-1][0]:
            both = self._plain(runs[-2][1]).unionByName(self._plain(runs[-1][1])).repartition(partitions(self.spark), key)
            if kind == "windows":
                both = both.groupBy("h", "w").agg(F.min(F.struct("doc", "t", "at")).alias("s")).select("h", "s.*", "w")
            else:
                both = both.groupBy("sha").agg(F.min("doc").alias("doc"))
            old = [runs.pop()[1], runs.pop()[1]]
            self._run(kind, both, key, dealt=True)
            for t in old:
                self.spark.sql(f"DROP TABLE {t}")

    def match(self, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """docs: doc (not null), text. Returns what is known of each row (doc, n_words, sha, whole: an earlier document
        has the same words) and the candidate stretches: h, doc, t, at, n, s_doc, s_t, s_at."""
        parts = partitions(self.spark)
        self.compact("windows", "h")
        self.compact("kinds", "sha")
        told = written(digests(docs))
        kinds = told.groupBy("sha").agg(F.min("doc").alias("doc"))
        for k, (_, run) in enumerate(self.runs["kinds"]):
            kinds = kinds.join(self.spark.table(run).withColumnRenamed("doc", f"_o{k}"), "sha", "left")
            kinds = kinds.select("sha", F.least("doc", F.coalesce(f"_o{k}", "doc")).alias("doc"))
        self._run("kinds", kinds, "sha")
        first = self.spark.table(self.runs["kinds"][-1][1]).withColumnRenamed("doc", "first")
        known = written(told.join(first, "sha").select("doc", "n_words", "sha", (F.col("doc") > F.col("first")).alias("whole")))
        lone = sieved(docs, "doc", sieve(known.where("not whole and n_words >= " + str(WINDOW)), "doc"))
        earlier = [self.spark.table(t) for _, t in self.runs["windows"]]
        self._run("windows", window_rows(lone, self.bits), "h")
        rows = self.spark.table(self.runs["windows"][-1][1])
        keys = rows.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("n"))
        seen = F.lit(0)
        for k, run in enumerate(earlier):
            keys = keys.join(run.groupBy("h").agg(F.count("*").alias(f"_n{k}")), "h", "left")
            seen = seen + F.coalesce(f"_n{k}", F.lit(0))
        hot = keys.where((F.col("lo") < F.col("hi")) | (seen > 0))
        hot = written(hot.select("h", F.ceil((F.col("n") + seen) / SALT_ROWS).cast("long").alias("salts")))
        compare = rows.join(hot, "h").withColumn("old", F.lit(False))
        for run in earlier:  # each merge-joined by itself, so that no run is dealt anew
            compare = compare.unionByName(run.join(hot, "h").withColumn("old", F.lit(True)))
        compare = compare.withColumn("salt", F.pmod(F.xxhash64("doc", "at"), "salts"))
        added = {c: F.lit(None).cast(ty) for c, ty in (("n", "int"), ("s_doc", "long"), ("s_t", "long"), ("s_at", "int"))}
        one = written(decided(compare.withColumns(added).select(NAMES), parts))
        two = decided(one.where("n is null"), parts)
        stretches = one.where("n > 0").unionByName(two.where("n > 0")).select("h", "doc", "t", "at", "n", "s_doc", "s_t", "s_at")
        return known, written(stretches)

    def drop(self) -> None:
        for runs in self.runs.values():
            for _, table in runs:
                self.spark.sql(f"DROP TABLE {table}")
        self.runs = {"windows": [], "kinds": []}


def words_digest(words: list[bytes], at: int, n: int) -> bytes:
    """Of the words that n windows from word `at` cover."""
    return hashlib.sha256(b" ".join(words[at : at + n - 1 + WINDOW])).digest()


def covered_digests(texts: DataFrame) -> DataFrame:
    """doc, t, at, n, digest. texts: doc, t, text, asked array<struct<at, n>>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, t, text, asked in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words = text.encode().split()
                for x in asked:
                    for c, v in zip(out, (doc, t, x["at"], x["n"], words_digest(words, x["at"], x["n"])), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["doc", "t", "at", "n", "digest"])

    return texts.select("doc", "t", "text", "asked").mapInArrow(run, "doc long, t long, at int, n int, digest binary")


def cut_words(texts: DataFrame) -> DataFrame:
    """doc, t, sha (of the words), n_words, n_removed, kept (the kept words, joined by a space), failed (stretches whose words
    are not those of their source; these stay). texts: doc, t, text, gone array<struct<at, n, h, digest>>; no digest: not verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, t, text, gone in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words = text.encode().split()
                failed = []
                delta = np.zeros(len(words) + 1, np.int64)
                for x in gone:
                    if x["digest"] is not None and words_digest(words, x["at"], x["n"]) != x["digest"]:
                        failed.append({"h": x["h"], "at": x["at"], "n": x["n"]})
                        continue
                    delta[x["at"]] += 1
                    delta[x["at"] + x["n"] - 1 + WINDOW] -= 1
                left = np.cumsum(delta)[:-1] == 0
                kept = b" ".join([w for w, k in zip(words, left.tolist(), strict=True) if k])
                for c, x in zip(out, (doc, t, hashlib.sha256(b" ".join(words)).digest(), len(words), len(words) - int(left.sum()), kept.decode(), failed), strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(out, types, strict=True)], names=["doc", "t", "sha", "n_words", "n_removed", "kept", "failed"])

    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))]
    return texts.select("doc", "t", "text", "gone").mapInArrow(run, "doc long, t long, sha binary, n_words long, n_removed long, kept string, failed array<struct<h: long, at: int, n: int>>")


def with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (doc, t, ...) with the texts of those rows; docs: doc (null: none), text."""
    asked = wanted.withColumn("first", F.nullif("doc", F.lit(NO_ID))).withColumnRenamed("t", "sha")
    found = fetched(docs, asked, text_digest(F.col("text"))).withColumnRenamed("sha", "t")
    return found.withColumn("text", F.coalesce("text", F.lit("")))


def removed(docs: DataFrame, stretches: DataFrame) -> DataFrame:
    """Verifies the stretches on the words and cuts: doc, sha, n_words, n_removed, kept of the documents that lose a part.

    docs: doc (null: none), text of the batch and of the documents before it; only the texts of sources and of cut
    documents go further.
    """
    sources = stretches.select(F.col("s_doc").alias("doc"), F.col("s_t").alias("t"), F.col("s_at").alias("at"), "n").distinct()
    asked = written(sources.groupBy("doc", "t").agg(F.collect_list(F.struct("at", "n")).alias("asked")))
    sure = covered_digests(with_texts(docs, asked)).select(F.col("doc").alias("s_doc"), F.col("t").alias("s_t"), F.col("at").alias("s_at"), "n", "digest")
    each = stretches.join(sure, ["s_doc", "s_t", "s_at", "n"]).groupBy("doc", "t").agg(F.collect_list(F.struct("at", "n", "h", "digest")).alias("gone"))
    each = written(each)
    cut = written(cut_words(with_texts(docs, each)))
    failed = cut.where(F.size("failed") > 0).select("doc", "t", F.explode("failed").alias("x")).select("doc", "t", "x.*")
    if failed.isEmpty():
        return cut.drop("failed", "t").dropDuplicates(["doc", "sha"])
    # two windows of one hash: all windows under those keys are told apart by their digests
    keys = written(failed.select("h").distinct())
    every = window_rows(docs.select(F.coalesce("doc", F.lit(NO_ID)).alias("doc"), "text")).select("h", "doc", "t", "at", F.size("w").alias("n"))
    every = sieved(every, "h", sieve(keys, "h")).join(keys, "h")
    single = every.select("doc", "t", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("at")).distinct()
    asked = written(single.groupBy("doc", "t").agg(F.collect_list(F.struct("at", F.lit(1).alias("n"))).alias("asked")))
    exact = written(covered_digests(with_texts(docs, asked)))
    least = exact.groupBy("digest").agg(F.min("doc").alias("least"))
    late = failed.select("doc", "t", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("at")).distinct()
    found = exact.join(least, "digest").where("doc > least").join(late, ["doc", "t", "at"]).select("doc", "t", "at")
    more = found.groupBy("doc", "t").agg(F.collect_list(F.struct("at", F.lit(1).alias("n"), F.lit(None).cast("long").alias("h"), F.lit(None).cast("binary").alias("digest"))).alias("more"))
    again = each.join(failed.select("doc", "t").distinct(), ["doc", "t"], "left_semi").join(more, ["doc", "t"], "left")
    again = written(again.select("doc", "t", F.concat("gone", F.coalesce("more", F.array().cast(more.schema["more"].dataType))).alias("gone")))
    rest = cut.where(F.size("failed") == 0)
    return written(rest.unionByName(cut_words(with_texts(docs, again))).drop("failed", "t").dropDuplicates(["doc", "sha"]))


def dedup(docs: DataFrame, batches: int = 3, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Passes the table through an index of its own in `batches` ranges of the id. Returns doc, n_words, sha, whole
    of each row, and doc, sha, n_words, n_removed, kept of those that lose a part. The candidates of all batches are verified
    together, in one reading of their texts."""
    spark = docs.sparkSession
    raw = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    cuts = sorted({int(c) for c in raw.stat.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01)}) if batches > 1 else []
    index, known, stretches, low = Index(spark, f"quire_index_{uuid.uuid4().hex}", bits), None, None, None
    try:
        for high in [*cuts, None]:
            inside = F.lit(True) if high is None else F.col("doc") <= high
            inside = inside & (F.col("doc") > low) if low is not None else inside | F.col("doc").isNull()
            told, found = index.match(raw.where(inside).select(F.coalesce("doc", F.lit(NO_ID)).alias("doc"), "text"))
            known = told if known is None else known.unionByName(told)
            stretches = found if stretches is None else stretches.unionByName(found)
            low = high
    finally:
        index.drop()
    return known, removed(raw, stretches)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, cut = dedup(documents(spark, sf_dir))
    gone = F.col("whole") & (F.col("n_words") >= WINDOW)
    parted = cut.select("doc", "sha", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return known.join(parted, ["doc", "sha"], "left").select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )
