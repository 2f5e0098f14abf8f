"""State: registries, caches, queues and guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import registry, rows, state
from quire.queries import query, table


@query("""WITH d AS (SELECT source, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)), n AS (SELECT source, count(*) AS n FROM d GROUP BY source),
r AS (SELECT d.*, n, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS k FROM d JOIN n USING (source))
SELECT CAST(doc_id AS VARCHAR) AS reg_key, CASE WHEN n <= 30 OR k <= 3 THEN DATE '2026-07-23' END AS first_seen FROM r""")
def onboarding_seed(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select(F.regexp_extract("source", "[0-9]+", 0).cast("long").alias("src_ord"), F.col("doc_id").cast("string").alias("reg_key"), (-F.col("doc_id")).alias("pos"))
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("reg_key"))
    return registry.register(d, known, "2026-07-23", influx=30)


CACHES = "a AS (SELECT user_id AS k, max(CAST(value AS BIGINT)) AS c, max(CAST(ts AS DATE) - DATE '1970-01-01')::INTEGER AS t FROM events WHERE event_id % 2 = 0 GROUP BY user_id), b AS (SELECT user_id AS k, max(CAST(value AS BIGINT)) AS c, max(CAST(ts AS DATE) - DATE '1970-01-01')::INTEGER AS t FROM events WHERE event_id % 2 = 1 GROUP BY user_id)"


def caches(spark, sf_dir):  # noqa: ANN001, ANN201
    ev = table(spark, sf_dir, "events")
    day = F.unix_date(F.col("ts").cast("date"))
    half = [ev.where(F.col("event_id") % 2 == r).groupBy(F.col("user_id").alias("k")).agg(F.max(F.round("value").cast("long")).alias("c"), F.max(day).alias("t")) for r in (0, 1)]
    return half[0], half[1]


CACHES = CACHES.replace("CAST(value AS BIGINT)", "CAST(round(value) AS BIGINT)")


@query(f"""WITH {CACHES}, u AS (SELECT *, 1 AS cur FROM a UNION ALL SELECT *, 0 FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY coalesce(t, 0) DESC, coalesce(c, 0) DESC, cur DESC) AS p FROM u)
SELECT k, c, t FROM r WHERE p = 1""")
def merge_recency(spark, sf_dir):  # noqa: ANN001, ANN201
    a, b = caches(spark, sf_dir)
    return rows.merge_recency(a, b, "k", "t", "c")


#: The two halves of the events by user, type and day: many keys are in one half only.
HALVES = """h AS (SELECT event_id % 2 AS half, user_id || '|' || event_type || '|' || (CAST(ts AS DATE) - DATE '1970-01-01') AS k, max(CAST(round(value) AS BIGINT)) AS c, max(event_id) AS t FROM events GROUP BY ALL),
a AS (SELECT k, c, t FROM h WHERE half = 0), b AS (SELECT k, c, t FROM h WHERE half = 1)"""


def halves(spark, sf_dir):  # noqa: ANN001, ANN201
    ev = table(spark, sf_dir, "events")
    key = F.concat_ws("|", "user_id", "event_type", F.unix_date(F.col("ts").cast("date")).cast("string")).alias("k")
    return [ev.where(F.col("event_id") % 2 == r).groupBy(key).agg(F.max(F.round("value").cast("long")).alias("c"), F.max("event_id").alias("t")) for r in (0, 1)]


@query(f"""WITH {HALVES}, x AS (SELECT k, CASE WHEN c % 3 = 0 THEN 'u' || c END AS u, t FROM a), y AS (SELECT k, CASE WHEN c % 2 = 0 THEN 'v' || c END AS u, t FROM b)
SELECT k, CASE WHEN x.u IS NOT NULL THEN x.u WHEN y.k IS NOT NULL THEN y.u ELSE x.u END AS u, CASE WHEN x.u IS NOT NULL THEN x.t WHEN y.k IS NOT NULL THEN y.t ELSE x.t END AS t FROM x FULL JOIN y USING (k)""")
def merge_found_wins(spark, sf_dir):  # noqa: ANN001, ANN201
    a, b = halves(spark, sf_dir)
    name = lambda p, m: F.when(F.col("c") % m == 0, F.concat(F.lit(p), F.col("c")))
    return rows.merge_found_wins(a.select("k", name("u", 3).alias("u"), "t"), b.select("k", name("v", 2).alias("u"), "t"), "k", "u")


@query(f"""WITH {HALVES} SELECT k, CASE WHEN b.k IS NOT NULL THEN b.c ELSE a.c END AS c, CASE WHEN b.k IS NOT NULL THEN b.t ELSE a.t END AS t FROM a FULL JOIN b USING (k)""")
def record_overlay(spark, sf_dir):  # noqa: ANN001, ANN201
    a, b = halves(spark, sf_dir)
    return rows.overlay_all(a, b, "k")


@query("""WITH x AS (SELECT d.doc_id, n_chars AS p, l.quality AS a, l.toxic AS b, d.doc_id % 2 = 0 AS od, d.doc_id % 3 = 0 AS sd FROM documents d LEFT JOIN labels l USING (doc_id)),
y AS (SELECT *, CASE WHEN od THEN coalesce(a, 0) ELSE 0 END AS ca, CASE WHEN sd THEN coalesce(b, 0) ELSE 0 END AS cb FROM x)
SELECT doc_id, nullif(CASE WHEN p > greatest(ca, cb) AND NOT (od AND sd) THEN p ELSE greatest(ca, cb) END, 0)::BIGINT AS c, (NOT (p > greatest(ca, cb) AND NOT (od AND sd)) AND cb > ca) AS s2 FROM y""")
def carry_forward(spark, sf_dir):  # noqa: ANN001, ANN201
    x = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    got = state.counted(F.col("quality").cast("long"), F.col("toxic").cast("long"), F.col("doc_id") % 2 == 0, F.col("doc_id") % 3 == 0, F.col("n_chars"))
    return x.select("doc_id", got.alias("g")).select("doc_id", "g.c", "g.s2")


@query("""WITH c AS (SELECT user_id, max(CAST(ts AS DATE) - DATE '1970-01-01')::INTEGER AS t FROM events WHERE event_type = 'click' GROUP BY user_id), p AS (SELECT user_id, min(event_id) AS o FROM events GROUP BY user_id),
m AS (SELECT max(CAST(ts AS DATE) - DATE '1970-01-01')::INTEGER AS d FROM events)
SELECT p.user_id, o, t FROM p LEFT JOIN c USING (user_id), m WHERE t IS NULL OR t <= d - 2 ORDER BY coalesce(t, 0), o, p.user_id LIMIT 100""")
def ttl_queue(spark, sf_dir):  # noqa: ANN001, ANN201
    ev = table(spark, sf_dir, "events").withColumn("d", F.unix_date(F.col("ts").cast("date")))
    cache = ev.where("event_type = 'click'").groupBy("user_id").agg(F.max("d").alias("t"))
    today = ev.agg(F.max("d")).first()[0]
    return state.ttl_queue(ev.select("user_id", F.col("event_id").alias("o")), cache, "user_id", "t", "o", today, 2, 100)


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS y, CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 4)::INTEGER END AS v FROM orders
WHERE o_orderkey % 3 = 0 AND coalesce(o_orderkey % 4, 0) < 3 AND year(o_orderdate) >= 1994 ORDER BY coalesce(nullif(o_orderkey % 4, 0), 0) <> 0, year(o_orderdate) DESC, o_orderkey LIMIT 1000""")
def search_queue(spark, sf_dir):  # noqa: ANN001, ANN201
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"))
    version = F.nullif((F.col("o_orderkey") % 4).cast("int"), F.lit(0))
    cache = o.select("o_orderkey", (F.col("o_orderkey") % 3 == 0).alias("none"), version.alias("v"))
    return state.search_queue(o, cache, "o_orderkey", "y", "none", "v", 3, 1994, 1000)


@query("""WITH f AS (SELECT doc_id, source, 'fresh' AS origin FROM documents WHERE doc_id % 3 > 0 AND (source <> 'src1' OR doc_id % 4 = 0)), c AS (SELECT doc_id, source, 'committed' AS origin FROM documents),
b AS (SELECT c.source FROM (SELECT source, count(*) AS n FROM c GROUP BY source) c LEFT JOIN (SELECT source, count(*) AS n FROM f GROUP BY source) f USING (source) WHERE coalesce(f.n, 0) * 2 < c.n)
SELECT * FROM f WHERE source NOT IN (SELECT source FROM b) UNION ALL SELECT * FROM c WHERE source IN (SELECT source FROM b)""")
def shrink_guard_fallback(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    fresh = d.where("doc_id % 3 > 0 and (source <> 'src1' or doc_id % 4 = 0)").withColumn("origin", F.lit("fresh"))
    return rows.shrink_guard(fresh, d.withColumn("origin", F.lit("committed")), "source")


@query("""SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'u' || d.doc_id END AS u, (coalesce(l.toxic, 0) <> 1) AS none FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.doc_id % 7 > 0""")
def stamped_misses(spark, sf_dir):  # noqa: ANN001, ANN201
    found = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.concat(F.lit("u"), "doc_id").alias("u"))
    return state.stamp(found, table(spark, sf_dir, "documents").select("doc_id"), "doc_id", F.col("doc_id") % 7 > 0)
