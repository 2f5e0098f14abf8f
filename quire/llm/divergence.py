"""How the sources of a language differ in their words: p-distributions over one vocabulary, compared pairwise.

Plain relational: the matches of a pattern are exploded, counted by (lang, source, term), the terms in at least MIN_DOCS
documents of a language are its vocabulary, every source of the language is crossed with it so that a term it lacks counts
0, and the dense table is joined with itself on lang and term. All arithmetic is on whole numbers: a share of one
thousand million parts is had by long division in three steps of three digits, so no product leaves 64 bits
below 9e15 occurrences. A difference is the same either way round, so the self-join makes each pair once.

Nothing but the counts is shuffled, after they have been added up where the texts are read: a frequent word or a source
with most of the rows is one row a task. The cross is an equal-join by language and a salt of the term, so that no
language gathers in one task; the table of sources, repeated for each salt, is never broadcast. The ten first terms
of a group are cut down before the shuffle by the rank limit.

Null text, lang and source are ''. A document is a row: repeated rows and rows that share an id count each. A document
without terms still makes its group appear: such a group has no occurrences and equal shares. A language without
vocabulary has value 0 for all pairs and no terms; a group that is alone in its language has no pairs. Ties are ranked
by the item's UTF-8 bytes. Texts of any length are read whole. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import documents, partitions, written

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # the longest runs of all other characters: what lies between them are TERM's matches
MIN_DOCS, TOP = 10, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased; a text of ASCII alone takes the faster way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it)."""
    text, lang, source = (F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source"))
    found = docs.select(text, lang, source).select("lang", "source", F.split(ascii_lower(F.col("text")), BETWEEN).alias("t"))
    both = F.array(F.struct(F.lit(1).alias("n"), F.lit(0).alias("docs"), F.col("t")), F.struct(F.lit(0).alias("n"), F.lit(1).alias("docs"), F.array_distinct("t").alias("t")))
    each = found.select("lang", "source", F.explode(both).alias("x")).select("lang", "source", "x.n", "x.docs", F.explode("x.t").alias("term"))
    # a text that begins or ends between terms has an empty piece there
    return each.where("term <> ''").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str) -> Column:
    """1 + floor(10^9 * count / total) for 0 <= count <= total, by long division, three digits at a time."""
    first = f"({count}) * 1000"
    second = f"(({first}) % {total}) * 1000"
    third = f"(({second}) % {total}) * 1000"
    return F.expr(f"1 + (({first}) div {total}) * 1000000 + (({second}) div {total}) * 1000 + (({third}) div {total})")


def difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def ranked(rows: DataFrame, part: str) -> DataFrame:
    own = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return rows.withColumn("rank", F.row_number().over(own)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair': item is another source, 'term': a term that the source has more of than its language),
    item, value, rank."""
    parts = partitions(docs.sparkSession)
    counts = written(term_counts(docs))
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    vocabulary = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs"))
    kept = written(counts.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "n", "all"))
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("all_n"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    sized = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").withColumn("twice", 2 * F.coalesce("v", F.lit(0)))
    sized = written(sized.select("lang", "source", (F.coalesce("own_n", F.lit(0)) + F.col("twice")).alias("d"), (F.coalesce("all_n", F.lit(0)) + F.col("twice")).alias("all_d")))

    salted = sized.select("lang", "source", "d", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("salt"))
    cells = vocabulary.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")).join(salted, ["lang", "salt"])
    dense = cells.join(kept.select("lang", "source", "term", "n"), ["lang", "source", "term"], "left")
    dense = written(dense.select("lang", "term", "source", share("coalesce(n, 0) + 2", "d").alias("p")))

    meet = dense.join(dense.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q")), ["lang", "term"]).where("source < item")
    once = meet.groupBy("lang", "source", "item").agg(F.sum(difference("p", "q")).alias("value"))
    way = lambda a, b: F.struct(F.col(a).alias("source"), F.col(b).alias("item"))
    both = once.select("lang", "value", F.explode(F.array(way("source", "item"), way("item", "source"))).alias("x")).select("lang", "x.*", "value")
    pairs = groups.join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(both, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))

    more = kept.join(sized, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), share("n + 2", "d").alias("p"), share("`all` + 2", "all_d").alias("q"))
    terms = ranked(more.where("p > q").withColumn("value", difference("p", "q")), "term").where(F.col("rank") <= top)
    return ranked(pairs, "pair").unionByName(terms)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


def oracle() -> str:
    p = lambda n, d: f"(1 + (1000000000::HUGEINT * ({n} + 2)) // {d})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT k, lang, source, unnest(t) AS term FROM d),
voc AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= {MIN_DOCS}),
lang_size AS (SELECT lang, sum(n)::HUGEINT + 2 * count(*) AS d FROM voc GROUP BY lang),
cnt AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN voc USING (lang, term) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, voc.term, coalesce(cnt.n, 0)::HUGEINT AS n, voc.n::HUGEINT AS n_all
    FROM g JOIN voc USING (lang) LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = voc.term),
size AS (SELECT lang, source, sum(n) + 2 * count(*) AS d FROM dense GROUP BY lang, source),
share AS (SELECT lang, source, term, n, {p("n", "size.d")} AS p, {p("n_all", "lang_size.d")} AS q
    FROM dense JOIN size USING (lang, source) JOIN lang_size USING (lang)),
pair_sum AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair_sum s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM share WHERE n > 0 AND p > q),
both_parts AS (SELECT * FROM pair UNION ALL SELECT * FROM term)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM (SELECT *,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= {TOP}"""
