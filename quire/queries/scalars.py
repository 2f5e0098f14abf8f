"""Scalar rules over pages, orders, parts and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.queries import query, table

TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


def titles(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'),
 '[\t\n\v\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+', ' ', 'g')) AS plain FROM pages""")
def strip_markup(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "pages").select("page_id", T.strip_markup(F.col("html")).alias("plain"))


@query(f"""SELECT page_id, trim(regexp_replace(lower({TITLE}), '[^a-z0-9]+', ' ', 'g')) AS normal, regexp_replace(strip_accents(lower({TITLE})), '[^a-z0-9]', '', 'g') AS matching,
 lower(strip_accents({TITLE})) AS folded FROM pages""")
def fold_title(spark, sf_dir):  # noqa: ANN001, ANN201
    t = F.col("title")
    return titles(spark, sf_dir).select("page_id", T.norm_title(t).alias("normal"), T.match_norm(t).alias("matching"), T.norm_name(t).alias("folded"))


@query("""WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS y, substr(o_orderpriority, 1, 1) AS v, o_orderstatus AS st, CAST(o_custkey AS VARCHAR) || '-x' AS p FROM orders)
SELECT o_orderkey, (CASE WHEN st = 'F' THEN 10000000000000 ELSE 0 END + CAST(y AS BIGINT) * 1000000000 + coalesce(TRY_CAST(v AS BIGINT), 0) * 1000000
 + least(o_orderkey, 999) * 1000 + least(TRY_CAST(string_split(p, '-')[1] AS BIGINT), 999))::BIGINT AS rank FROM o""")
def prefix_int_rank(spark, sf_dir):  # noqa: ANN001, ANN201
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "x").otherwise("")
    page = F.concat(F.col("o_custkey").cast("string"), F.lit("-x"))
    rank = T.pub_rank(F.year("o_orderdate").cast("string"), F.substring("o_orderpriority", 1, 1), F.col("o_orderkey").cast("string"), page, status)
    return o.select("o_orderkey", rank.cast("long").alias("rank"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' AND year(o_orderdate) >= 1998 - 3 THEN 'Articles in Advance' ELSE '' END AS status FROM orders""")
def status_case(spark, sf_dir):  # noqa: ANN001, ANN201
    o = table(spark, sf_dir, "orders")
    volume = F.when(F.col("o_orderstatus") == "F", "1").otherwise("")
    return o.select("o_orderkey", T.forthcoming_status(volume, F.lit(""), F.year("o_orderdate").cast("string"), 1998).alias("status"))


@query(f"""SELECT page_id, lower(regexp_replace(url, '(?i)^https?://doi\\.org/', '')) AS doi,
 CASE WHEN page_id % 2 = 0 THEN lower(regexp_replace(url, '(?i)^https?://doi\\.org/', '')) ELSE 't:' || trim(regexp_replace(lower({TITLE}), '[^a-z0-9]+', ' ', 'g')) || '|' || '2020' END AS reg_key FROM pages""")
def reg_key(spark, sf_dir):  # noqa: ANN001, ANN201
    doi = T.doi_key(F.col("url"))
    given = F.when(F.col("page_id") % 2 == 0, doi).otherwise("")
    return titles(spark, sf_dir).select("page_id", doi.alias("doi"), T.reg_key(given, F.col("title"), F.lit("2020")).alias("reg_key"))


@query(r"""WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'http://www.arxiv.org/pdf/' || page_id || '.0001v2.pdf' WHEN 1 THEN 'https://papers.ssrn.com/x?id=' || page_id WHEN 2 THEN 'ftp://arxiv.org/abs/' || page_id
 WHEN 3 THEN 'https://www.nber.org/system/files/working_papers/w' || page_id || '/w.pdf' ELSE 'https://arxiv.org.evil.com/abs/1' END AS c, url FROM pages)
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://arxiv.org/abs/' || page_id || '.0001' WHEN 1 THEN c WHEN 3 THEN 'https://www.nber.org/papers/w' || page_id END AS u,
 CASE page_id % 5 WHEN 0 THEN 'arxiv' WHEN 1 THEN 'ssrn' WHEN 3 THEN 'nber' END AS s, CASE page_id % 5 WHEN 0 THEN 'https://arxiv.org/abs/' || page_id || '.0001' ELSE c END AS canon FROM u""")
def pick_host_priority(spark, sf_dir):  # noqa: ANN001, ANN201
    k, ident = F.col("page_id") % 5, F.col("page_id").cast("string")
    c = (
        F.when(k == 0, F.concat(F.lit("http://www.arxiv.org/pdf/"), ident, F.lit(".0001v2.pdf"))).when(k == 1, F.concat(F.lit("https://papers.ssrn.com/x?id="), ident)).when(k == 2, F.concat(F.lit("ftp://arxiv.org/abs/"), ident))
        .when(k == 3, F.concat(F.lit("https://www.nber.org/system/files/working_papers/w"), ident, F.lit("/w.pdf"))).otherwise("https://arxiv.org.evil.com/abs/1")
    )
    found = T.pick_preprint(F.array("url", "c"))
    return table(spark, sf_dir, "pages").withColumn("c", c).select("page_id", found["u"].alias("u"), found["s"].alias("s"), T.canon_arxiv(F.col("c")).alias("canon"))


@query(f"""WITH w AS (SELECT page_id, unnest(list_filter(string_split(trim(regexp_replace({TITLE}, '\\s+', ' ', 'g')), ' '), lambda x: x <> '')) AS t FROM pages),
s AS (SELECT DISTINCT page_id, regexp_replace(strip_accents(lower(t)), '[^a-z]', '', 'g') AS n FROM w)
SELECT page_id, string_agg(n, ' ' ORDER BY n) AS names, count(*)::BIGINT AS n FROM s WHERE length(n) >= 2 GROUP BY page_id""")
def surname_set(spark, sf_dir):  # noqa: ANN001, ANN201
    found = T.surnames(F.split(T.squeeze(F.col("title")), " "))
    return titles(spark, sf_dir).select("page_id", F.array_sort(found).alias("f")).where(F.size("f") > 0).select("page_id", F.array_join("f", " ").alias("names"), F.size("f").cast("long").alias("n"))


@query("""WITH p AS (SELECT p_partkey, lower(p_name) AS n, CASE WHEN p_partkey % 3 = 0 THEN regexp_replace(lower(p_name), '^(\\S+) ', '\\1 q. ') ELSE lower(p_name) END AS full_name FROM part)
SELECT p_partkey, full_name, CASE WHEN len(string_split(full_name, ' ')) >= 3 THEN regexp_replace(full_name, '^(\\S+) q\\. ', '\\1 ') ELSE full_name END AS short FROM p""")
def strip_middle_initial(spark, sf_dir):  # noqa: ANN001, ANN201
    n = F.lower("p_name")
    full = F.when(F.col("p_partkey") % 3 == 0, F.regexp_replace(n, r"^(\S+) ", "$1 q. ")).otherwise(n)
    return table(spark, sf_dir, "part").select("p_partkey", full.alias("full_name")).withColumn("short", T.without_initials(F.col("full_name")))


@query("""WITH d AS (SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN 'the committee' ELSE 'Ann ' || upper(substr(source, 1, 1)) || 'o' END AS who FROM documents)
SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN '' ELSE 'This paper was accepted by ' || who || ', ' || source || '.' END AS editor, CASE WHEN doc_id % 4 < 2 THEN '' ELSE source END AS area FROM d""")
def accepted_by(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("doc_id") % 4
    who = F.when(k == 1, "the committee").otherwise(F.concat(F.lit("Ann "), F.upper(F.substring("source", 1, 1)), F.lit("o")))
    body = F.when(k == 0, "").otherwise(F.concat(F.lit("We study it. This paper was accepted by "), who, F.lit(", "), F.col("source"), F.lit(". Funding: none. Data: there.")))
    return table(spark, sf_dir, "documents").select("doc_id", T.acceptance(body).alias("a")).select("doc_id", "a.editor", "a.area")


@query("""SELECT doc_id, substr(text, 1, 4000) AS head, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9_''\\s\\x{A0}\\v-]', ' ', 'g'), '[\\s\\x{A0}\\v]+', ' ', 'g')) AS sanitised FROM documents""")
def text_prefix(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", T.text_prefix(F.col("text")).alias("head"), T.sanitised_query(F.col("text")).alias("sanitised"))


@query("""SELECT event_id, CASE WHEN value > 0 THEN value END AS value FROM events""")
def positive_count(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "events").select("event_id", T.positive(F.col("value")).alias("value"))


@query("""SELECT event_id, floor(epoch_ms(ts) / 86400000)::INTEGER AS day, floor(epoch_ms(ts) / 86400000)::INTEGER > 19800 - 2 AS fresh,
 greatest(CASE WHEN event_id % 3 = 0 THEN user_id::DOUBLE ELSE 0 END, least(5 * pow(2, event_id % 7), 60))::DOUBLE AS wait FROM events""")
def clocks(spark, sf_dir):  # noqa: ANN001, ANN201
    """Epoch days, whether a check of that day is still fresh, and waits between tries."""
    e = table(spark, sf_dir, "events")
    after = F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("double"))
    day = T.epoch_day(F.col("ts"))
    return e.select("event_id", day.alias("day"), (day > 19800 - 2).alias("fresh"), T.retry_wait(F.col("event_id") % 7 + 1, after).alias("wait"))
