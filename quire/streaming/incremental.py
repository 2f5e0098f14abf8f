"""Incremental upkeep over file streams: the batch operators inside foreachBatch, with availableNow triggers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.schemas import REGISTRY
from quire.operators.registry import claims, register
from quire.operators.rows import merge_recency
from quire.plans.publication import Publication
from quire.sources import files
from quire.sources.shared import written


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def follow_registry(spark: SparkSession, landing: str, table: str, checkpoint: str, pull_date: str, influx: int = 250, first_run: bool = False) -> StreamingQuery:
    """New keys of a landing folder of (src_ord, reg_key, pos) files enter the registry, batch by batch. A batch writes
    a folder of its own, so a repeated batch replaces what it wrote before and cannot add a key twice. first_run: the
    stream's first batch is a first run of the registry (only the newest of each source are news)."""
    source = spark.readStream.schema("src_ord long, reg_key string, pos long").parquet(landing)

    def upsert(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        known = table_or_empty(s, f"{table}/batch=*", REGISTRY)
        # what this batch itself has written before it is repeated does not count
        known = known.where(~F.input_file_name().contains(f"/batch={number}/"))
        new = written(register(batch, known, pull_date, first_run=first_run and number == 0, influx=influx))
        new.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return source.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


PULLED = "reg_key string, src_ord long, n long, places array<long>, first_seen date, pull date"


def registered(spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
    """The registry that follow_pull() keeps: of several rows of a key the newest batch's (of those before a batch)."""
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("long")
    try:
        rows = spark.read.schema(PULLED).parquet(f"{table}/batch=*").withColumn("_b", number)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PULLED)
    rows = rows if before is None else rows.where(F.col("_b") < before)
    own = [c for c in rows.columns if c != "_b"]
    return rows.groupBy("reg_key").agg(F.max_by(F.struct(*own), "_b").alias("r")).select("r.*")


def first_places(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """(keys, places): the least `most` positions, cut down before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    return rows.withColumn("_k", place).where(F.col("_k") <= most).groupBy(*keys).agg(F.array_sort(F.collect_list("pos")).alias("places"))


def follow_pull(spark: SparkSession, landing: str, table: str, checkpoint: str, pull_date: str, influx: int = 250, seeds: int = 3, first_run: bool = False) -> StreamingQuery:
    """One pull whose files land bit by bit: new keys of (src_ord, reg_key, pos) files enter the registry at once, and
    whether they are news is decided by the whole pull.

    The registry's rows of a pull are the counters of its sources: a batch adds its own to those of the batches before it.
    Once a source has more than `influx` new keys it is being taken in: its first `seeds` places stay news, the batch that
    finds out writes the earlier keys again without a date, and so for a key that a later batch puts out of the first
    places. The registry after the last batch is that of the pull in one batch, but that a key belongs to the first
    batch it is in. A batch writes a folder of its own, so a repeated one changes nothing.
    """
    source = spark.readStream.schema("src_ord long, reg_key string, pos long").parquet(landing)
    day = F.lit(pull_date).cast("date")

    def upsert(batch: DataFrame, number: int) -> None:
        known = written(registered(batch.sparkSession, table, number))
        claimed = batch.join(claims(batch, known), ["reg_key", "src_ord"])
        keys = ["reg_key", "src_ord"]
        new = claimed.groupBy(*keys).agg(F.count("*").alias("n")).join(first_places(claimed, keys, seeds), keys)
        new = new.withColumns({"first_seen": F.lit(None).cast("date"), "pull": day, "_new": F.lit(True)})
        pulled = written(known.where(F.col("pull") == day).withColumn("_new", F.lit(False)).unionByName(new))
        sizes = pulled.groupBy("src_ord").agg(F.sum("n").alias("_n"))
        first = first_places(pulled.select("src_ord", F.explode("places").alias("pos")), ["src_ord"], seeds).withColumnRenamed("places", "_s")
        news = (F.lit(not first_run) & (F.col("_n") <= influx)) | F.arrays_overlap("places", "_s")
        decided = pulled.join(sizes, "src_ord").join(first, "src_ord").withColumn("_seen", F.when(news, day))
        out = decided.where(F.col("_new") | ~F.col("_seen").eqNullSafe(F.col("first_seen")))
        out.select("reg_key", "src_ord", "n", "places", F.col("_seen").alias("first_seen"), "pull").write.mode("overwrite").parquet(f"{table}/batch={number}")

    return source.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_cache(spark: SparkSession, landing: str, data: str, name: str, checkpoint: str) -> StreamingQuery:
    """Citation counts (doi_key, c, t) of a landing folder become parts of a published cache, one a batch: what is written
    follows the batch, and a batch that is in already is passed over. Later t, then the larger c."""
    schema = "doi_key string, c long, t int"
    source = spark.readStream.schema(schema).parquet(landing)

    def merge(batch: DataFrame, number: int) -> None:
        pub = Publication(batch.sparkSession, data)
        if pub.answered(f"{name}/{checkpoint}", number):
            return
        own = batch.groupBy("doi_key").agg(F.max(F.struct("t", "c")).alias("m")).select("doi_key", "m.c", "m.t")
        held = pub.cache(name, schema).join(own.select("doi_key"), "doi_key", "left_semi")
        pub.add(name, written(merge_recency(held, own, "doi_key", "t", "c")), f"{name}/{checkpoint}", number)

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_counts(spark: SparkSession, landing: str, table: str, checkpoint: str) -> StreamingQuery:
    """Citation counts (doi_key, c, t) of a landing folder are merged into versions of the cache: later t, then larger
    c. Version n+1 is made of version n and batch n, so a repeated batch gives the same version; older ones go."""
    schema = "doi_key string, c long, t int"
    source = spark.readStream.schema(schema).parquet(landing)

    def merge(batch: DataFrame, number: int) -> None:
        current = table_or_empty(batch.sparkSession, f"{table}/v{number}", schema)
        merge_recency(current, batch, "doi_key", "t", "c").write.mode("overwrite").parquet(f"{table}/v{number + 1}")
        files.remove(batch.sparkSession, f"{table}/v{number - 1}")

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
