"""Joins, overlays, set operations and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import matching, rows
from quire.queries import query, table
from quire.queries.scalars import titles


@query("""SELECT doc_id, text, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents WHERE coalesce(text, '') <> '') WHERE r = 1
UNION ALL SELECT doc_id, text, source FROM documents WHERE coalesce(text, '') = ''""")
def dedup_keep_first(spark, sf_dir):  # noqa: ANN001, ANN201
    return rows.keep_first(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "text", ["doc_id"])


LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"""SELECT {LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE}) AS r FROM lineitem) WHERE r = 1""")
def dedup_line_items(spark, sf_dir):  # noqa: ANN001, ANN201
    cols = LINE.split(", ")
    keyed = table(spark, sf_dir, "lineitem").select(*cols).withColumn("k", F.concat_ws(":", "l_orderkey", "l_linenumber"))
    return rows.keep_first(keyed, "k", cols).drop("k")


@query("""SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 2 = 0 THEN nullif(d.lang, '') END, CAST(l.quality AS VARCHAR), '') AS lang, coalesce(CAST(l.toxic AS VARCHAR), d.source) AS source
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def lookup_fill_if_empty(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("lang"), "source")
    s = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("lang"), F.col("toxic").cast("string").alias("source"))
    return rows.overlay(d, s, "doc_id", fill=("lang",), override=("source",))


@query("""SELECT doc_id, 'label' AS origin FROM labels UNION ALL SELECT doc_id, 'text' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def anti_append(spark, sf_dir):  # noqa: ANN001, ANN201
    have = table(spark, sf_dir, "labels").select("doc_id", F.lit("label").alias("origin"))
    return rows.append_unseen(have, table(spark, sf_dir, "documents").select("doc_id", F.lit("text").alias("origin")), "doc_id")


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def unseen_keys(spark, sf_dir):  # noqa: ANN001, ANN201
    known = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return rows.unseen(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), known, "c_custkey")


@query("""WITH seen AS (SELECT user_id, event_type, max(CAST(ts AS DATE)) AS last_seen FROM events GROUP BY ALL), top AS (SELECT max(last_seen) AS d FROM seen)
SELECT user_id, event_type, last_seen FROM seen, top WHERE last_seen >= d - 3 ORDER BY last_seen DESC, user_id, event_type LIMIT 1500""")
def recent_window(spark, sf_dir):  # noqa: ANN001, ANN201
    ev = table(spark, sf_dir, "events").withColumn("k", F.concat_ws("|", "user_id", "event_type"))
    registry = ev.groupBy("k").agg(F.max(F.col("ts").cast("date")).alias("last_seen"))
    pull = registry.agg(F.max("last_seen")).first()[0]
    keys = ev.select("user_id", "event_type", "k").distinct()
    found = rows.recent(keys, registry, "k", "last_seen", str(pull), 3)
    return rows.top(found.select("user_id", "event_type", "last_seen"), [F.desc("last_seen"), F.col("user_id"), F.col("event_type")], 1500)


@query("""SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'q' || l.quality END, d.source) AS source FROM documents d LEFT JOIN labels l USING (doc_id)""")
def overlay_keep_old(spark, sf_dir):  # noqa: ANN001, ANN201
    cache = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "q1").otherwise("").alias("found"))
    return rows.keep_old_unless_found(table(spark, sf_dir, "documents").select("doc_id", "source"), cache, "doc_id", "source", "found")


@query("""WITH c AS (SELECT c_nationkey AS k, count(*)::BIGINT AS n FROM customer GROUP BY ALL)
SELECT s_suppkey, CASE WHEN n > s_suppkey THEN n ELSE s_suppkey END AS cited, CASE WHEN n > s_suppkey THEN 'cache' ELSE 'own' END AS source FROM supplier LEFT JOIN c ON s_nationkey = k""")
def lift_max_provenance(spark, sf_dir):  # noqa: ANN001, ANN201
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("cited"), F.lit("own").alias("source"))
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    return rows.lift_max(s, c, "k", "cited", "source", "n", F.lit("cache")).drop("k")


@query("""SELECT doc_id, floor((row_number() OVER (ORDER BY doc_id) - 1) / 50)::BIGINT AS batch FROM (SELECT DISTINCT doc_id FROM documents)""")
def batch_assign(spark, sf_dir):  # noqa: ANN001, ANN201
    keys = rows.distinct_first(table(spark, sf_dir, "documents"), "doc_id", "n_chars").select("doc_id")
    return rows.numbered_batches(keys, ["doc_id"], 50)


@query("""WITH t AS (SELECT page_id AS id, regexp_replace(strip_accents(lower(regexp_extract(html, '<title>([^<]*)</title>', 1))), '[^a-z0-9]', '', 'g') AS t FROM pages),
u AS (SELECT id, CASE WHEN id % 3 = 0 THEN substr(t, 1, 20) ELSE t END AS t FROM t)
SELECT t.id AS l_id, u.id AS r_id, CASE WHEN t.t = u.t THEN 'exact' ELSE 'prefix' END AS kind FROM t JOIN u ON t.t <> '' AND u.t <> '' AND (t.t = u.t
 OR (least(length(t.t), length(u.t)) >= 14 AND (starts_with(t.t, u.t) OR starts_with(u.t, t.t))
 AND NOT regexp_matches(CASE WHEN length(t.t) > length(u.t) THEN substr(t.t, length(u.t) + 1) ELSE substr(u.t, length(t.t) + 1) END, 'comment|reply|replies|corrigend|errat|rejoinder|retract')))""")
def fuzzy_prefix_match(spark, sf_dir):  # noqa: ANN001, ANN201
    t = titles(spark, sf_dir).select(F.col("page_id").alias("id"), T.match_norm(F.col("title")).alias("title"))
    cut = t.withColumn("title", F.when(F.col("id") % 3 == 0, F.substring("title", 1, 20)).otherwise(F.col("title")))
    return matching.match_titles(t, cut)


@query("""WITH a AS (SELECT n_nationkey, trim(regexp_replace(regexp_replace(replace(lower(n_name), '&', ' and '), '^the\\s+', ''), '[^a-z0-9]+', ' ', 'g')) AS n FROM nation),
b AS (SELECT r_regionkey, trim(regexp_replace(lower(substr(r_name, 1, 4)), '[^a-z0-9]+', ' ', 'g')) AS r FROM region)
SELECT n_nationkey, r_regionkey, (contains(n, r) OR contains(r, n)) AS ok FROM a JOIN nation USING (n_nationkey) JOIN b ON n_regionkey = r_regionkey""")
def contains_either_way(spark, sf_dir):  # noqa: ANN001, ANN201
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("n_nationkey", "r_regionkey", matching.title_agrees(F.col("n_name"), F.substring("r_name", 1, 4)).alias("ok"))


@query("""WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source), gone AS (SELECT source FROM s WHERE source IN ('src1', 'src2'))
SELECT doc_id, source FROM documents WHERE source NOT IN (SELECT source FROM gone)""")
def retired_drop(spark, sf_dir):  # noqa: ANN001, ANN201
    from quire.plans.publish import drop_retired

    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("jkey"))
    dims = d.select(F.col("jkey").alias("key")).distinct().withColumn("retired", F.col("key").isin("src1", "src2"))
    return drop_retired(d, dims).select("doc_id", F.col("jkey").alias("source"))


@query("""SELECT source, count(*)::BIGINT AS n FROM documents WHERE source IN ('src3', 'src5') GROUP BY source""")
def only_prune(spark, sf_dir):  # noqa: ANN001, ANN201
    from quire.plans.build import active

    d = table(spark, sf_dir, "documents").select(F.col("source").alias("key"), F.lit(False).alias("retired"))
    return active(d, ("src3", "src5")).groupBy(F.col("key").alias("source")).agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT conv_id, role, unnest(string_split(lower(regexp_replace(text, '[^A-Za-z ]', '', 'g')), ' ')) AS s FROM conversations), a AS (SELECT DISTINCT conv_id, s FROM w WHERE role = 'user' AND length(s) >= 2), b AS (SELECT DISTINCT conv_id, s FROM w WHERE role <> 'user' AND length(s) >= 2),
n AS (SELECT conv_id FROM conversations GROUP BY conv_id), x AS (SELECT conv_id, (SELECT count(*) FROM a WHERE a.conv_id = n.conv_id) AS na, (SELECT count(*) FROM b WHERE b.conv_id = n.conv_id) AS nb, (SELECT count(*) FROM a JOIN b USING (conv_id, s) WHERE a.conv_id = n.conv_id) AS m FROM n)
SELECT conv_id, m::BIGINT AS shared, (na > 0 AND nb > 0 AND m >= least(2, na, nb)) AS enough FROM x""")
def shared_surnames(spark, sf_dir):  # noqa: ANN001, ANN201
    """The words of either side of a conversation as people's last names: what they share, and whether that is enough."""
    c = table(spark, sf_dir, "conversations").withColumn("w", F.split(F.lower(F.regexp_replace("text", "[^A-Za-z ]", "")), " "))
    side = lambda cond, n: F.flatten(F.collect_list(F.when(cond, F.col("w")))).alias(n)
    user = F.col("role") == "user"
    both = c.groupBy("conv_id").agg(side(user, "a"), side(~user, "b")).select("conv_id", T.surnames(F.col("a")).alias("a"), T.surnames(F.col("b")).alias("b"))
    return both.select("conv_id", F.size(F.array_intersect("a", "b")).cast("long").alias("shared"), matching.enough_shared(F.col("a"), F.col("b")).alias("enough"))


@query("""WITH x AS (SELECT o_orderkey, year(o_orderdate) AS mine, CASE WHEN o_custkey % 7 > 0 THEN 1980 + o_custkey % 25 END AS theirs, o_orderkey % 2 = 0 AS exact FROM orders)
SELECT o_orderkey, coalesce(theirs BETWEEN mine - CASE WHEN exact THEN 12 ELSE 6 END AND mine + 1, TRUE) AS ok FROM x""")
def plausible_years(spark, sf_dir):  # noqa: ANN001, ANN201
    kind = F.when(F.col("o_orderkey") % 2 == 0, "exact").otherwise("prefix")
    theirs = F.when(F.col("o_custkey") % 7 > 0, (F.col("o_custkey") % 25 + 1980).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", matching.plausible_year(kind, F.year("o_orderdate"), theirs).alias("ok"))
