"""Aggregations, components, rollups and published views."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import entities, rows
from quire.operators.components import connected_components as components
from quire.plans import publish
from quire.queries import query, table
from quire.sources.shared import written


@query("""SELECT source AS jkey, count(*)::BIGINT AS count, min(CASE WHEN n_chars <> 0 THEN n_chars END)::BIGINT AS first_year FROM documents GROUP BY source""")
def source_manifest(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("jkey"), F.col("n_chars").cast("string").alias("year"))
    return publish.source_counts(d, "jkey", "year")


@query("""SELECT o_orderpriority AS jkey, count(*)::BIGINT AS count, min(CAST(year(o_orderdate) AS BIGINT)) AS first_year FROM orders GROUP BY ALL""")
def first_year(spark, sf_dir):  # noqa: ANN001, ANN201
    return publish.source_counts(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("jkey"), F.year("o_orderdate").cast("string").alias("y")), "jkey", "y")


@query("""WITH s AS (SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source)
SELECT source, n, (SELECT sum(n) FROM s)::BIGINT AS paper_count, (SELECT count(*) FROM s)::BIGINT AS journal_count FROM s""")
def per_source_map(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("jkey"), F.lit("2020").alias("year"))
    no = F.lit(None)
    dims = d.select(F.col("jkey").alias("key")).distinct().withColumns({c: no.cast("string") for c in ("name", "short", "publisher", "abs", "url", "base")} | {c: no.cast("boolean") for c in ("aia", "editors", "seEditors", "aeEditors", "limitedCoverage", "notFT", "retired")} | {"src_ord": F.col("key")})
    out = publish.meta(d, dims, "2026-07-23")
    return out.select(F.explode("per_source").alias("source", "n"), "paper_count", "journal_count")


@query("""WITH c AS (SELECT l_orderkey, l_partkey, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL), k AS (SELECT l_orderkey, count(*) AS m FROM c GROUP BY ALL)
SELECT l_orderkey, l_partkey, n FROM c JOIN k USING (l_orderkey) WHERE m = 1 OR n >= 2""")
def pair_histogram_guard(spark, sf_dir):  # noqa: ANN001, ANN201
    return entities.pair_guard(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey", "l_partkey")


ROUNDS = 14  # of least labels in the SQL: more than the components of orders and parts are wide
LABELS = """e AS (SELECT DISTINCT 'o' || l_orderkey AS a, 'p' || l_partkey AS b FROM lineitem), s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), l0 AS (SELECT a AS node, a AS l FROM s GROUP BY a), """ + ", ".join(
    f"l{k} AS (SELECT s.a AS node, least(min(x.l), any_value(y.l)) AS l FROM s JOIN l{k - 1} x ON s.b = x.node JOIN l{k - 1} y ON s.a = y.node GROUP BY s.a)" for k in range(1, ROUNDS + 1)
) + f", labels_ AS (SELECT node, l AS component FROM l{ROUNDS})"


def labels_of(li):  # noqa: ANN001, ANN201
    """(node, component) of orders and parts. They go through the rounds as numbers, even ones for orders, and get their names
    with the least name of each component at the end."""
    found = components(li.select((2 * F.col("l_orderkey").cast("long")).alias("a"), (2 * F.col("l_partkey").cast("long") + 1).alias("b")))
    named = written(found.select(F.concat(F.when(F.col("node") % 2 == 0, "o").otherwise("p"), F.shiftright("node", 1)).alias("node"), F.col("component").alias("c")))
    return named.join(named.groupBy("c").agg(F.min("node").alias("component")), "c").select("node", "component")


@query(f"WITH {LABELS} SELECT node, component FROM labels_")
def connected_components(spark, sf_dir):  # noqa: ANN001, ANN201
    return labels_of(table(spark, sf_dir, "lineitem"))


@query(f"""WITH {LABELS}, m AS (SELECT component, p_name AS name, l_orderkey AS o, p_type AS area FROM lineitem JOIN labels_ ON node = 'p' || l_partkey JOIN part ON l_partkey = p_partkey),
n AS (SELECT component, name, count(*) AS n, min(o) AS f FROM m GROUP BY ALL), g AS (SELECT component, list(name ORDER BY n DESC, f, name) AS names, sum(n)::BIGINT AS papers FROM n GROUP BY component),
a AS (SELECT component, count(DISTINCT area)::BIGINT AS areas FROM m GROUP BY component)
SELECT component, names[1] AS author, papers, areas, array_to_string(names[2:], '|') AS variants FROM g JOIN a USING (component)""")
def component_rollup(spark, sf_dir):  # noqa: ANN001, ANN201
    return rolled_up(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


def rolled_up(lines, part):  # noqa: ANN001, ANN201
    labels = labels_of(lines)
    li = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    m = li.join(labels, F.concat(F.lit("p"), "l_partkey") == F.col("node")).select("component", F.col("p_name").alias("name"), F.col("l_orderkey").alias("o"), F.col("p_type").alias("area"))
    counts = m.groupBy("component", "name").agg(F.count("*").alias("n"), F.min("o").alias("f"))
    named = entities.mode_and_variants(counts, "component", "name", "n", "f")
    total = counts.groupBy("component").agg(F.sum("n").alias("papers"))
    areas = m.groupBy("component", "area").agg(F.min("o").alias("o")).groupBy("component").agg(entities.ordered_set("area", "o").alias("areas"))
    return named.join(total, "component").join(areas, "component").select("component", F.col("mode").alias("author"), "papers", F.size("areas").cast("long").alias("areas"), F.array_join("variants", "|").alias("variants"))


@query("""WITH c AS (SELECT lower(c_name) AS name, c_mktsegment AS area, o_orderkey AS o FROM orders JOIN customer ON o_custkey = c_custkey),
n AS (SELECT name, count(*)::BIGINT AS papers, string_agg(DISTINCT area, '|' ORDER BY area) AS areas FROM c GROUP BY name) SELECT name AS author, papers, areas FROM n""")
def author_rollup(spark, sf_dir):  # noqa: ANN001, ANN201
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    m = o.select(F.col("o_orderkey").alias("ord"), F.lower("c_name").alias("name"), F.lit("").alias("orcid"), F.col("c_mktsegment").alias("area"), F.lit("j").alias("journal"))
    rolled = entities.author_rollup(m, entities.identities(m))
    return rolled.select("author", "papers", F.array_join(F.array_sort("areas"), "|").alias("areas"))


@query("""WITH x AS (SELECT DISTINCT l_orderkey, lower(p_type) AS k, p_type FROM lineitem JOIN part ON l_partkey = p_partkey), b AS (SELECT l_orderkey, lower(p_type) AS k, min(p_brand) AS brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT p_type AS name, count(*)::BIGINT AS papers, count(DISTINCT brand)::INTEGER AS area_count FROM x JOIN b USING (l_orderkey, k) GROUP BY p_type ORDER BY papers DESC, name LIMIT 3000""")
def facet_topk(spark, sf_dir):  # noqa: ANN001, ANN201
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    r = entities.facet_rollup(li.select("l_orderkey", "p_type", "p_brand", F.struct("p_brand").alias("o")), "l_orderkey", "p_type", "p_brand", "o")
    return rows.top(r.select("name", "papers", "area_count"), [F.desc("papers"), F.col("name")], 3000)


@query("""WITH c AS (SELECT o_custkey, count(*)::BIGINT AS papers FROM orders GROUP BY ALL), r AS (SELECT *, row_number() OVER (ORDER BY papers DESC, o_custkey) AS p FROM c)
SELECT o_custkey, papers FROM r WHERE papers >= 12 OR p <= 500""")
def trim_or_top(spark, sf_dir):  # noqa: ANN001, ANN201
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("papers"))
    return rows.trim_or_top(c, "papers", [F.desc("papers"), F.col("o_custkey")], "o_custkey", 500, enough=12)


def papers_of_lines(spark, sf_dir):  # noqa: ANN001, ANN201
    """Orders as papers: parts are authors, suppliers their identifiers (some missing)."""
    ident = F.when(F.col("l_tax") > 0.04, F.col("l_suppkey").cast("string")).otherwise("")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ident.alias("i")).distinct()
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "i")
    g = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("a"))
    none, blank = F.lit(None).cast("string"), F.lit("")
    return g.select(
        F.col("l_orderkey").cast("string").alias("title"), F.transform("a", lambda x: x["l_partkey"].cast("string")).alias("authors"), F.transform("a", lambda x: x["i"]).alias("orcids"), F.array().cast("array<string>").alias("affiliations"),
        F.concat(F.lit("10.1/"), "l_orderkey").alias("doi_key"), *[blank.alias(c) for c in ("volume", "issue", "page", "status", "abstract", "editor", "area")], F.lit("2020").alias("year"), *[none.alias(c) for c in ("senior_editor", "associate_editor", "cited_src", "preprint", "preprint_src")],
        F.lit("J").alias("journal"), F.lit("j").alias("jkey"), F.lit(None).cast("long").alias("cited_by"),
    )


PUBLISHED = """WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_tax > 0.04 THEN CAST(l_suppkey AS VARCHAR) ELSE '' END AS i FROM lineitem)
SELECT 'https://doi.org/10.1/' || l_orderkey AS doi, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_linenumber, l_partkey, l_suppkey, i) AS authors,
 CASE WHEN max(i) <> '' THEN string_agg(i, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, i) END AS orcids FROM l GROUP BY l_orderkey"""


@query(PUBLISHED)
def public_projection(spark, sf_dir):  # noqa: ANN001, ANN201
    p = publish.public(papers_of_lines(spark, sf_dir))
    return p.select(F.col("DOI").alias("doi"), F.col("Authors").alias("authors"), F.col("Orcids").alias("orcids"))


@query("""SELECT '10.1/' || l_orderkey AS doi_key, count(*)::BIGINT AS authors, count(*)::BIGINT AS orcids, 2020000000000 AS pub_rank FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax > 0.04 AS i FROM lineitem) GROUP BY l_orderkey""")
def rehydrate_roundtrip(spark, sf_dir):  # noqa: ANN001, ANN201
    dims = spark.createDataFrame([("j", 0)], "key string, src_ord long")
    back = publish.rehydrated(publish.public(papers_of_lines(spark, sf_dir)), dims)
    return back.select("doi_key", F.size("authors").cast("long").alias("authors"), F.size("orcids").cast("long").alias("orcids"), "pub_rank")


@query("""SELECT count(*)::BIGINT AS total, count(CASE WHEN l.quality = 1 THEN 1 END)::BIGINT AS linked, count(CASE WHEN l.doc_id IS NULL THEN 1 END)::BIGINT AS backlog FROM documents d LEFT JOIN labels l USING (doc_id)""")
def coverage_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    from quire.operators.state import coverage

    cache = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "x").alias("found"))
    return coverage(table(spark, sf_dir, "documents").select("doc_id"), cache, "doc_id", "found")


