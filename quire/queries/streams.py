"""Streams over landing folders that are filled from tables, and whole builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.config import Config
from quire.functions.schemas import PAPER
from quire.plans import build
from quire.plans.run import catalogue
from quire.queries import query, table
from quire.queries.records import document, folder, keyed_document, reply
from quire.operators import rows
from quire.plans.publication import Publication
from quire.sources import files
from quire.sources.shared import written
from quire.streaming import queue
from quire.streaming.incremental import follow_cache, follow_counts, follow_pull, follow_registry, registered


@query("""WITH k AS (SELECT event_type, CAST(user_id AS VARCHAR) || ':' || (event_id % 40) AS reg_key, min(event_id % 2) AS half FROM events GROUP BY ALL), f AS (SELECT reg_key, min(half) AS half FROM k GROUP BY reg_key)
SELECT reg_key, CASE WHEN half = 0 THEN DATE '2026-01-01' ELSE DATE '2026-02-01' END AS first_seen FROM f""")
def registry_stream(spark, sf_dir):  # noqa: ANN001, ANN201
    """Keys of two landings enter the registry batch by batch; a key keeps the date of its first batch."""
    base = folder(spark)
    ev = table(spark, sf_dir, "events")
    key = F.concat("user_id", F.lit(":"), F.col("event_id") % 40)
    rows = ev.select(F.lit(0).cast("long").alias("src_ord"), key.alias("reg_key"), F.col("event_id").alias("pos"), (F.col("event_id") % 2).alias("half"))
    for half, day in ((0, "2026-01-01"), (1, "2026-02-01")):
        rows.where(F.col("half") == half).drop("half").write.mode("append").parquet(f"{base}/in")
        follow_registry(spark, f"{base}/in", f"{base}/registry", f"{base}/mark", day, influx=10**9).awaitTermination()
    return spark.read.parquet(f"{base}/registry/batch=*").select("reg_key", "first_seen")


@query("""WITH x AS (SELECT CAST(user_id AS VARCHAR) AS doi_key, CAST(round(value) AS BIGINT) AS c, (CAST(ts AS DATE) - DATE '1970-01-01')::INTEGER AS t FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY doi_key ORDER BY t DESC, c DESC) AS p FROM x) SELECT doi_key, c, t FROM r WHERE p = 1""")
def count_stream(spark, sf_dir):  # noqa: ANN001, ANN201
    """Counts of two landings merged into versions of a cache: the later day, then the larger count."""
    base = folder(spark)
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doi_key"), F.round("value").cast("long").alias("c"), F.unix_date(F.col("ts").cast("date")).alias("t"), (F.col("event_id") % 2).alias("half"))
    for half in (0, 1):
        rows.where(F.col("half") == half).drop("half").write.mode("append").parquet(f"{base}/in")
        follow_counts(spark, f"{base}/in", f"{base}/cache", f"{base}/mark").awaitTermination()
    return spark.read.parquet(f"{base}/cache/v{max(files.versions(spark, f'{base}/cache'))}")


KEYED = "SELECT event_id % 997 AS m, min(event_id) AS pos FROM events GROUP BY 1"


def keyed(spark, sf_dir):  # noqa: ANN001, ANN201
    """Keys of three sources, each with its first place: two of the sources have about four hundred keys, one two hundred."""
    m = F.col("event_id") % 997
    each = table(spark, sf_dir, "events").groupBy(m.alias("m")).agg(F.min("event_id").alias("pos"))
    source = F.when(F.col("m") < 400, 0).when(F.col("m") < 600, 1).otherwise(2).cast("long")
    return each.select("m", source.alias("src_ord"), F.concat(F.lit("k"), "m").alias("reg_key"), "pos")


@query(f"""WITH e AS ({KEYED}), s AS (SELECT m, pos, CASE WHEN m < 400 THEN 0 WHEN m < 600 THEN 1 ELSE 2 END AS src FROM e),
r AS (SELECT *, count(*) OVER (PARTITION BY src) AS n, row_number() OVER (PARTITION BY src ORDER BY pos) AS place FROM s)
SELECT 'k' || m AS reg_key, src::BIGINT AS src_ord, CASE WHEN n <= 250 OR place <= 3 THEN DATE '2026-03-01' END AS first_seen FROM r""")
def registry_influx(spark, sf_dir):  # noqa: ANN001, ANN201
    """A pull that lands in two parts. Neither part of a source is an influx; both together are, which the second finds
    out: the keys of the first lose their date, but for the source's first three."""
    base, landed = folder(spark), keyed(spark, sf_dir)
    for half in (1, 0):
        landed.where(F.col("m") % 2 == half).drop("m").write.mode("append").parquet(f"{base}/in")
        follow_pull(spark, f"{base}/in", f"{base}/registry", f"{base}/mark", "2026-03-01").awaitTermination()
    return registered(spark, f"{base}/registry").select("reg_key", "src_ord", "first_seen")


@query("""WITH x AS (SELECT CAST(user_id AS VARCHAR) AS doi_key, CAST(round(value) AS BIGINT) AS c, (CAST(ts AS DATE) - DATE '1970-01-01')::INTEGER AS t FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY doi_key ORDER BY t DESC, c DESC) AS p FROM x) SELECT doi_key, c, t FROM r WHERE p = 1""")
def cache_parts(spark, sf_dir):  # noqa: ANN001, ANN201
    """Counts of four landings as parts of a published cache: each batch writes its own keys, reading takes a key's newest."""
    base = folder(spark)
    landed = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doi_key"), F.round("value").cast("long").alias("c"), F.unix_date(F.col("ts").cast("date")).alias("t"), (F.col("event_id") % 4).alias("part"))
    for part in range(4):
        landed.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/in")
        follow_cache(spark, f"{base}/in", base, "counts", f"{base}/mark").awaitTermination()
    return Publication(spark, base).cache("counts", "doi_key string, c long, t int").select("doi_key", "c", "t")


@query("""SELECT '10.1/' || doc_id AS doi_key, count(*)::BIGINT AS answers, max(CASE WHEN doc_id % 3 > 0 THEN doc_id END)::BIGINT AS c FROM documents GROUP BY doc_id""")
def queue_units(spark, sf_dir):  # noqa: ANN001, ANN201
    """A queue of requests in units, stopped after the third and gone on with: each key is answered once."""
    base = folder(spark)
    keys = table(spark, sf_dir, "documents").select(F.concat(F.lit("10.1/"), "doc_id").alias("doi_key"), F.col("doc_id").alias("n"))
    asked = written(rows.numbered_batches(keys, ["n", "doi_key"], 50))
    unit = 1 + asked.agg(F.max("batch")).first()[0] // 8
    done: list[int] = []

    def work(most):  # noqa: ANN001, ANN202
        def one(name, requests, number):  # noqa: ANN001, ANN202
            if len(done) >= most:
                return False
            requests.select("doi_key", F.when(F.col("n") % 3 > 0, F.col("n")).alias("c")).write.mode("overwrite").parquet(f"{base}/answers/{name}-{number}")
            done.append(number)
            return True

        return one

    queue.drain(spark, f"{base}/queue", lambda: asked, unit, work(3))
    queue.drain(spark, f"{base}/queue", lambda: asked.limit(0), unit, work(10**9))
    return spark.read.option("recursiveFileLookup", True).schema("doi_key string, c long").parquet(f"{base}/answers").groupBy("doi_key").agg(F.count("*").alias("answers"), F.max("c").alias("c"))


@query("""WITH c AS (SELECT 'Author ' || upper(chr((97 + doc_id % 23)::INTEGER)) AS author, count(*)::BIGINT AS papers, count(DISTINCT source)::BIGINT AS journals FROM documents GROUP BY 1)
SELECT author, papers, journals, (row_number() OVER (ORDER BY papers DESC, author) - 1)::INTEGER AS place FROM c""")
def published_authors(spark, sf_dir):  # noqa: ANN001, ANN201
    """The list of authors as it is published: its order is that of the document written from it."""
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("Author "), F.chr((F.lit(65) + F.col("doc_id") % 23).cast("int")))
    rows = d.select(F.array(name).alias("authors"), F.array(F.lit("")).alias("orcids"), F.col("source").alias("jkey"), F.col("source").alias("journal"), F.lit("").alias("area"), F.concat(F.lit("10.1/"), "doc_id").alias("doi_key"), F.col("doc_id").alias("ord"), F.lit(0).cast("long").alias("src_ord"), F.lit(0).cast("long").alias("pub_rank"))
    papers = spark.createDataFrame([], PAPER).unionByName(rows, allowMissingColumns=True)
    path = f"{folder(spark)}/authors.json"
    files.write_document(build.authors(papers, Config()).select("author", "papers", "journals"), path)
    back = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.from_json("value", "array<struct<author: string, papers: bigint, journals: array<string>>>")).alias("place", "a"))
    return back.select("a.author", "a.papers", F.size("a.journals").cast("long").alias("journals"), "place")


@query("""WITH n AS (SELECT n_nationkey AS k, r_name AS jkey, r_regionkey AS r FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 4), p AS (SELECT DISTINCT ON (jkey, k // 2) jkey, k // 2 AS g, r FROM n ORDER BY jkey, k // 2, k)
SELECT jkey, count(*)::BIGINT AS papers, count(CASE WHEN g % 2 = 0 THEN 1 END)::BIGINT AS cited, (SELECT count(*) FROM p)::BIGINT AS total, count(*)::BIGINT AS listed, count(*)::BIGINT AS registered FROM p GROUP BY jkey""")
def catalogue_build(spark, sf_dir):  # noqa: ANN001, ANN201
    """The whole build of a landing folder: journals (one of them retired), their pulls with repeated keys, cached counts."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base, pair = folder(spark), F.floor(F.col("n_nationkey") / 2).cast("string")
    doi = F.concat(F.lit("10.1/"), "r_name", F.lit("-"), pair)
    journal = F.struct(F.col("r_name").alias("key"), F.concat(F.lit("J "), "r_name").alias("name"), (F.col("r_regionkey") == 4).alias("retired"))
    dims = n.select("r_regionkey", journal.alias("j")).distinct().groupBy().agg(F.array_sort(F.collect_list(F.struct("r_regionkey", "j"))).alias("a"))
    document(dims.select(F.to_json(F.transform("a", lambda x: x["j"])).alias("value")), f"{base}/journals.json")
    work = F.struct(doi.alias("DOI"), F.lit("journal-article").alias("type"), F.array(F.concat(F.lit("T "), "n_name")).alias("title"), F.struct(F.array(F.array(F.lit(2020))).alias("date-parts")).alias("issued"))
    reply(n.select(F.col("r_name").alias("jkey"), F.col("n_nationkey").alias("o"), work.alias("work")), base)
    document(keyed_document(n.where(F.floor(F.col("n_nationkey") / 2) % 2 == 0), doi, F.struct(F.lit(5).alias("c"), F.lit(1).alias("t"))), f"{base}/citations.json")
    out = catalogue(spark, base, Config())
    by = out["papers"].groupBy("jkey").agg(F.count("*").alias("papers"), F.count_if(F.col("cited_by") == 5).alias("cited"))
    listed = out["manifest"].select(F.col("key").alias("jkey"), F.col("count").alias("listed"))
    registered = out["registry"].groupBy(F.regexp_extract("reg_key", "^10.1/(.*)-", 1).alias("low")).agg(F.count("*").alias("registered"))
    total = out["meta"].first().paper_count
    return by.join(listed, "jkey").join(registered, F.lower("jkey") == F.col("low")).select("jkey", "papers", "cited", F.lit(total).cast("long").alias("total"), "listed", "registered")
