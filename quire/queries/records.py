"""Raw records, JSON documents and lookups: each query lays down records that follow from a table, in the form the library
reads, and returns what its readers, build and matching make of them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.config import Config
from quire.functions import text as T
from quire.functions.schemas import PAPER, PAPER_COLUMNS, SEARCH_HIT, WORK, WORK_HIT
from quire.operators import entities, matching, rows
from quire.plans import build, jobs, publish
from quire.queries import query, table
from quire.sources import files, json_docs, lookups
from quire.sources.dumps import Dumps
from quire.sources.shared import shared_dir, written

CONFIG = Config()


def folder(spark) -> str:  # noqa: ANN001
    return f"{shared_dir(spark)}/quire-docs-{uuid.uuid4().hex}"


def document(value, path):  # noqa: ANN001, ANN201
    """A table of one text (value) as a document: a folder of that name with one file, as Spark writes it."""
    value.coalesce(1).write.mode("overwrite").text(path)


def keyed_document(rows, key, record):  # noqa: ANN001, ANN201
    """(value): an object of records by key, in the order of the keys."""
    members = F.array_sort(F.collect_list(F.struct(key.alias("k"), record.alias("v"))))
    return rows.groupBy().agg(F.to_json(F.map_from_entries(members), {"ignoreNullFields": "true"}).alias("value"))


def reply(works, base, issn=None, bare=False):  # noqa: ANN001, ANN201
    """Works (jkey, o, work) as the pulls of a folder, a file a journal (works-<jkey>.json, or with the ISSN's place and a page)."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("o", "work"))), lambda x: x["work"])
    each = works.groupBy("jkey").agg(F.to_json(items if bare else F.struct(F.struct(items.alias("items")).alias("message"))).alias("value"))
    for r in each.select("jkey").orderBy("jkey").collect():  # journals are a small dimension
        document(each.where(F.col("jkey") == r.jkey).select("value"), f"{base}/.laid")
        files.rename_only(each.sparkSession, f"{base}/.laid", f"{base}/works-{r.jkey}" + ("" if issn is None else f".{issn}.0") + ".json")


def journals_of(spark, sf_dir):  # noqa: ANN001, ANN201
    """The sources as journals: some with editors, some with the two other roles, all of them local."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("key")).distinct()
    n = F.regexp_extract("key", "[0-9]+", 0).cast("long")
    return d.select("key", F.concat(F.lit("Journal "), "key").alias("name"), n.alias("src_ord"), (n % 2 == 0).alias("editors"), (n % 3 == 0).alias("seEditors"), (n % 4 == 0).alias("aeEditors"), (n % 5 == 0).alias("aia"), F.lit(False).alias("retired"))


def works_of(spark, sf_dir):  # noqa: ANN001, ANN201
    """documents as raw works (JSON in the API's form, parsed by the library's schema)."""
    k = F.col("doc_id")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    none = F.lit(None).cast("string")
    person = lambda given, family, name, orcid, places: F.struct(given.alias("given"), family.alias("family"), name.alias("name"), orcid.alias("ORCID"), places.alias("affiliation"))
    place = lambda x: F.struct(x.alias("name"))
    unis = F.array(place(text("Uni  ", F.col("lang"))), place(text("Uni ", F.col("lang"))), place(F.lit("")), place(text("Lab ", F.col("source"))))
    nowhere = F.array().cast("array<struct<name:string>>")
    authors = F.array(
        person(F.lit("Ann"), text("Lee, ", F.col("source")), none, text("https://orcid.org/0-", (k % 10).cast("string")), unis),
        person(F.lit(""), none, none, F.lit("https://orcid.org/9-9"), nowhere),
        person(none, none, text("Group ", F.col("lang")), F.lit("http://ORCID.org/7"), nowhere),
    )
    dates = lambda y: F.struct(F.array(F.array(y)).alias("date-parts"))
    abstract = F.when(k % 3 == 0, "<p>We ask. This paper was accepted by Bo Chen, finance. Data: none.</p>").when(k % 3 == 1, "History: Cy Diaz, Senior Editor; Di Fox and Ed Gil, Associate Editors.").otherwise("")
    asserted = F.array(F.struct(F.lit("Received").alias("label"), none.alias("name"), F.lit("May").alias("value")), F.struct(none.alias("label"), F.lit("Handling Editor").alias("name"), F.when(k % 6 == 1, "").otherwise("Flo Hu.").alias("value")))
    work = F.struct(
        text("https://doi.org/10.1/D", k.cast("string")).alias("DOI"), F.when(k % 5 == 1, "").when(k % 5 == 2, "book").when(k % 5 > 2, "journal-article").alias("type"),
        F.array(F.when(k % 7 == 0, " <i></i>").otherwise(text("<i>Paper</i> &amp;lt; ", k.cast("string")))).alias("title"), authors.alias("author"), F.when(k % 4 == 0, abstract).otherwise(abstract).alias("abstract"),
        dates(F.when(k % 3 == 0, 0).otherwise((2000 + k % 20).cast("int"))).alias("issued"), dates(F.lit(1999)).alias("published-print"), F.when(k % 8 == 0, F.array(F.lit("Area A."))).alias("group-title"),
        F.array(F.lit("Special Issue on Digital Finance.")).alias("subject"), F.when(k % 2 == 0, asserted).alias("assertion"), (F.col("n_chars") % 3).alias("is-referenced-by-count"),
    )
    raw = table(spark, sf_dir, "documents").select(F.col("source").alias("jkey"), k.alias("ord"), F.to_json(work).alias("body"))
    return raw.select("jkey", "ord", F.from_json("body", WORK).alias("w")).select("jkey", "ord", "w.*")


def built(spark, sf_dir):  # noqa: ANN001, ANN201
    labels = table(spark, sf_dir, "labels")
    overrides = labels.where("toxic = 1").select(F.concat(F.lit("10.1/d"), "doc_id").alias("doi_key"), F.lit("Gus Ho..").alias("editor"), F.lit("<b>Ops</b>. ").alias("area"))
    return build.map_journals(works_of(spark, sf_dir), journals_of(spark, sf_dir), CONFIG, overrides=overrides)


#: The same documents in SQL: n is the source's number, k the document's.
SEEN = """d AS (SELECT doc_id AS k, source, lang, n_chars, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) AS n FROM documents WHERE doc_id % 5 <> 2 AND doc_id % 7 <> 0),
o AS (SELECT doc_id AS k FROM labels WHERE toxic = 1), w AS (SELECT d.*, o.k IS NOT NULL AS over FROM d LEFT JOIN o USING (k))"""


@query(f"""WITH {SEEN} SELECT '10.1/d' || k AS doi_key, 'Paper &lt; ' || k AS title, 'Ann Lee ' || source || '|Group ' || lang AS authors, '0-' || k % 10 || '|http://ORCID.org/7' AS orcids, 'Uni ' || lang || '|Lab ' || source AS affiliations,
 CASE WHEN k % 3 = 0 THEN '1999' ELSE CAST(2000 + k % 20 AS VARCHAR) END AS year, nullif(n_chars % 3, 0)::BIGINT AS cited_by FROM w""")
def mapped_records(spark, sf_dir):  # noqa: ANN001, ANN201
    """Types and titles filtered, authors paired with identifiers, places, years and counts."""
    b = built(spark, sf_dir)
    return b.select("doi_key", "title", *[F.array_join(c, "|").alias(c) for c in ("authors", "orcids", "affiliations")], "year", "cited_by")


@query(f"""WITH {SEEN}, e AS (SELECT k, n, CASE WHEN n % 2 > 0 THEN '' WHEN k % 3 = 0 THEN 'This paper was accepted by Bo Chen, finance.' WHEN k % 2 = 0 AND k % 6 <> 1 THEN 'This paper was accepted by Flo Hu.'
 WHEN over THEN 'This paper was accepted by Gus Ho.' ELSE '' END AS editor, CASE WHEN n % 2 > 0 THEN '' WHEN k % 3 = 0 THEN 'finance' WHEN over THEN 'ops' WHEN k % 8 = 0 THEN 'area a' ELSE 'special issue on the digital finance' END AS area FROM w)
SELECT '10.1/d' || k AS doi_key, editor, area, CASE WHEN n % 3 = 0 THEN CASE WHEN k % 3 = 1 THEN 'Cy Diaz' ELSE '' END END AS senior_editor, CASE WHEN n % 4 = 0 THEN CASE WHEN k % 3 = 1 THEN 'Di Fox; Ed Gil' ELSE '' END END AS associate_editor FROM e""")
def editors_and_areas(spark, sf_dir):  # noqa: ANN001, ANN201
    """Editor and area by text, assertion, override, group title and subject; roles by the journal's flags."""
    return built(spark, sf_dir).select("doi_key", "editor", "area", "senior_editor", "associate_editor")


@query(f"""WITH {SEEN}, c AS (SELECT doc_id AS k, CASE WHEN doc_id % 2 = 0 THEN 'Own ' || doc_id ELSE 'Shared ' || doc_id END AS se FROM labels)
SELECT '10.1/d' || k AS doi_key, CASE WHEN n % 3 = 0 THEN CASE WHEN k % 3 = 1 THEN 'Cy Diaz' ELSE coalesce(se, '') END END AS senior_editor,
 CASE WHEN n % 12 = 0 THEN CASE WHEN k % 3 = 1 THEN 'Di Fox; Ed Gil' WHEN k % 2 = 1 AND se IS NOT NULL THEN 'Aid' ELSE '' END WHEN n % 4 = 0 THEN CASE WHEN k % 3 = 1 THEN 'Di Fox; Ed Gil' ELSE '' END END AS associate_editor FROM w LEFT JOIN c USING (k)""")
def cached_editors(spark, sf_dir):  # noqa: ANN001, ANN201
    """Two caches of editors, an own record over a shared one, where the text names none and the journal has the role."""
    labels = table(spark, sf_dir, "labels")
    key = F.concat(F.lit("10.1/d"), "doc_id").alias("doi_key")
    shared = labels.select(key, F.concat(F.lit("Shared "), "doc_id").alias("se"), F.lit("Aid").alias("ae"))
    own = labels.where("doc_id % 2 = 0").select(key, F.concat(F.lit("Own "), "doc_id").alias("se"), F.lit("").alias("ae"))
    out = build.apply_editors(built(spark, sf_dir).select(*PAPER_COLUMNS), shared, own, journals_of(spark, sf_dir))
    return out.select("doi_key", "senior_editor", "associate_editor")


@query(f"""WITH {SEEN}, have AS (SELECT k FROM w), s AS (SELECT doc_id AS k, source, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) AS n FROM documents WHERE doc_id % 2 = 0)
SELECT '10.1/d' || k AS doi_key, 'Advance ' || k AS title, source AS jkey, 'Articles in Advance' AS status, '2026' AS year, 'Jo Roe|Al Poe' AS authors, 12026000000000 AS pub_rank FROM s WHERE n % 5 = 0 AND k NOT IN (SELECT k FROM have)""")
def advance_supplement(spark, sf_dir):  # noqa: ANN001, ANN201
    """Advance papers that no journal has yet, for journals that publish in advance; of entries for one key the first."""
    d = table(spark, sf_dir, "documents").where("doc_id % 2 = 0")
    fields = [F.concat(F.lit("10.1/d"), "doc_id").alias("doi_key"), F.col("source").alias("jkey"), F.lit("Jo Roe, , Al Poe ").alias("Authors"), F.lit("").alias("Affiliations"), F.lit(None).cast("string").alias("Abstract"), F.lit("").alias("Year")]
    first = d.select(*fields, F.concat(F.lit("Advance "), "doc_id").alias("Title"), F.lit(0).alias("pos"))
    later = d.select(*fields, F.lit("A later entry").alias("Title"), F.lit(1).alias("pos"))
    papers = built(spark, sf_dir).select(*PAPER_COLUMNS)
    out = build.append_supplement(papers, later.unionByName(first), journals_of(spark, sf_dir).withColumn("base", F.lit(None).cast("string")), CONFIG).where("ord > 1000000000000")
    return out.select("doi_key", "title", "jkey", "status", "year", F.array_join("authors", "|").alias("authors"), "pub_rank")


NATION = "lower(n_name) AS doi_key"


@query(f"""SELECT {NATION}, CAST(n_regionkey AS VARCHAR) AS volume, CASE WHEN n_nationkey % 2 = 0 THEN '7' ELSE '' END AS issue, CASE WHEN n_nationkey % 3 = 0 THEN '2001' END AS year FROM nation""")
def sidecar_document(spark, sf_dir):  # noqa: ANN001, ANN201
    """A keyed JSON document (inside a "map" member) through the sidecar reader."""
    k = F.col("n_nationkey")
    record = F.struct(F.col("n_regionkey").cast("string").alias("volume"), F.when(k % 2 == 0, "7").otherwise("").alias("issue"), F.when(k % 3 == 0, "2001").alias("year"))
    path = f"{folder(spark)}/fixups.json"
    inner = keyed_document(table(spark, sf_dir, "nation"), F.col("n_name"), record)
    document(inner.select(F.concat(F.lit('{"map":'), "value", F.lit("}")).alias("value")), path)
    return json_docs.fixups(spark, path).select("doi_key", "volume", "issue", "year")


@query("""SELECT n_name AS reg_key, CASE WHEN n_nationkey % 3 > 0 THEN DATE '2026-01-01' + n_nationkey END AS first_seen, FALSE AS first_run FROM nation""")
def registry_state(spark, sf_dir):  # noqa: ANN001, ANN201
    """The registry document: dates, and blanks for what is known without one; a broken document is a first run."""
    base, k = folder(spark), F.col("n_nationkey").cast("int")
    day = F.when(k % 3 > 0, F.date_add(F.lit("2026-01-01").cast("date"), k).cast("string")).otherwise("")
    document(keyed_document(table(spark, sf_dir, "nation"), F.col("n_name"), day), f"{base}/registry.json")
    files.write_text(spark, f"{base}/broken.json", "{nope")
    known, first = json_docs.registry(spark, f"{base}/registry.json")
    _, broken = json_docs.registry(spark, f"{base}/broken.json")
    return known.withColumn("first_run", F.lit(first or not broken))


@query("""SELECT r_name AS key, r_regionkey::BIGINT AS src_ord, 'The ' || r_name AS name, r_regionkey % 2 = 1 AS retired, CASE WHEN r_regionkey = 2 THEN 'https://elsewhere' END AS base FROM region WHERE r_regionkey % 2 = 0 AND r_regionkey <> 2
UNION ALL SELECT 'lost', -1, '', FALSE, '' WHERE FALSE""")
def journal_document(spark, sf_dir):  # noqa: ANN001, ANN201
    """The journal dimension from its document, active and held here; a missing document has no rows."""
    base, k = folder(spark), F.col("r_regionkey")
    entry = F.struct(F.col("r_name").alias("key"), F.concat(F.lit("The "), "r_name").alias("name"), (k % 2 == 1).alias("retired"), F.when(k == 2, "https://elsewhere").alias("base"))
    listed = table(spark, sf_dir, "region").groupBy().agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), entry.alias("e")))).alias("a"))
    document(listed.select(F.to_json(F.transform("a", lambda x: x["e"])).alias("value")), f"{base}/journals.json")
    dims = build.local(build.active(json_docs.journals(spark, f"{base}/journals.json"))).select("key", "src_ord", "name", "retired", "base")
    return dims.unionByName(json_docs.json_or_empty(spark, f"{base}/none.json", "key string, src_ord long, name string, retired boolean, base string"))


@query("""SELECT r_name AS jkey, string_agg('10.1/' || n_nationkey, ',' ORDER BY n_nationkey % 2, n_nationkey) AS dois, count(*)::BIGINT AS n FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 1 GROUP BY r_name""")
def pulled_documents(spark, sf_dir):  # noqa: ANN001, ANN201
    """Replies and bare arrays of several ISSNs of each journal, read in one scan; files of other journals are left out."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base = folder(spark)
    work = F.struct(F.concat(F.lit("10.1/"), "n_nationkey").alias("DOI"), F.array(F.lit("t")).alias("title"))
    for issn in (0, 1):
        own = n.where(F.col("n_nationkey") % 2 == issn).select(F.col("r_name").alias("jkey"), F.col("n_nationkey").alias("o"), work.alias("work"))
        reply(own, base, issn, bare=issn == 1)
    keys = table(spark, sf_dir, "region").where("r_regionkey <> 1").select(F.col("r_name").alias("key"))
    w = json_docs.works_folder(spark, base, keys)
    dois = F.transform(F.array_sort(F.collect_list(F.struct("ord", "DOI"))), lambda x: x["DOI"])
    return w.groupBy("jkey").agg(F.array_join(dois, ",").alias("dois"), F.count("*").alias("n"))


@query("""SELECT r_name AS source, count(*)::BIGINT AS n, sum(n_nationkey)::BIGINT AS total FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 3 GROUP BY r_name""")
def manifest_scan(spark, sf_dir):  # noqa: ANN001, ANN201
    """The files a manifest names, written by the document writer and read in one scan; entries elsewhere are left out."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base = folder(spark)
    keys = [r.r_name for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect()]
    for key in keys:
        files.write_document(n.where(F.col("r_name") == key).select("r_name", "n_nationkey").orderBy("n_nationkey"), f"{base}/papers-{key}.json")
    manifest = table(spark, sf_dir, "region").select(F.col("r_name").alias("key"), F.when(F.col("r_regionkey") == 3, "elsewhere").alias("base"))
    got = json_docs.manifest_papers(spark, manifest, base, "r_name string, n_nationkey long")
    return got.groupBy(F.col("r_name").alias("source")).agg(F.count("*").alias("n"), F.sum("n_nationkey").alias("total"))


@query("""SELECT n_name AS doi_key, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey END::BIGINT AS c FROM nation""")
def positional_zip(spark, sf_dir):  # noqa: ANN001, ANN201
    """A positional reply beside its request."""
    k = F.col("n_nationkey")
    requests = table(spark, sf_dir, "nation").groupBy(F.floor(k / 10).alias("batch")).agg(F.array_sort(F.collect_list(F.struct(k, "n_name"))).alias("a"))
    slot = F.transform("a", lambda x: F.when(x["n_nationkey"] % 3 > 0, F.struct(x["n_nationkey"].alias("citationCount"))))
    batches = requests.select("batch", F.transform("a", lambda x: x["n_name"]).alias("keys"), F.to_json(slot).alias("body"))
    return lookups.slots(batches.select("batch", "keys"), batches.select("batch", F.lit(True).alias("done"), "body")).select("doi_key", "c")


def asked(spark, sf_dir, size):  # noqa: ANN001, ANN201
    keys = table(spark, sf_dir, "documents").select(F.concat(F.lit("10.1/"), "doc_id").alias("doi_key"))
    return rows.numbered_batches(keys, ["doi_key"], size)


def number(key="doi_key"):  # noqa: ANN001, ANN201
    """The document's number in a key."""
    return F.substring_index(key, "/", -1).cast("long")


@query("""SELECT '10.1/' || doc_id AS doi_key, CASE WHEN doc_id % 3 > 0 THEN doc_id END::BIGINT AS c, TRUE AS done FROM documents""")
def keyed_lookup(spark, sf_dir):  # noqa: ANN001, ANN201
    """Fifty keys a call: the kept replies of all calls, read as records; a key that an answered call lacks has no count."""
    requests = written(asked(spark, sf_dir, 50))
    record = F.when(number() % 3 > 0, F.struct(F.concat(F.lit("https://doi.org/"), "doi_key").alias("doi"), number().alias("cited_by_count")))
    replies = requests.groupBy("batch").agg(F.to_json(F.struct(F.collect_list(record).alias("results"))).alias("body")).withColumn("done", F.lit(True))
    got = lookups.records(requests, replies)
    return got.select("doi_key", F.get_json_object("body", "$.cited_by_count").cast("long").alias("c"), "done")


@query("""SELECT '10.1/' || doc_id AS doi_key, CASE WHEN doc_id % 4 > 0 THEN 2 * doc_id END::BIGINT AS c, TRUE AS done FROM documents""")
def batch_post_lookup(spark, sf_dir):  # noqa: ANN001, ANN201
    """Five hundred keys a call: kept positional replies, read beside their requests."""
    batches = written(lookups.batched_keys(asked(spark, sf_dir, 500)))
    slot = F.transform("keys", lambda k: F.when(number(k) % 4 > 0, F.struct((2 * number(k)).alias("citationCount"))))
    return lookups.slots(batches, batches.select("batch", F.lit(True).alias("done"), F.to_json(slot).alias("body")))


@query("""SELECT r_name AS jkey, issn_ord, page_ord, item_ord, '10.1/' || issn || '-' || page_ord || '-' || item_ord AS doi FROM (SELECT r_name, unnest([0, 1]) AS issn_ord, r_regionkey FROM region), (SELECT unnest([0, 1]) AS page_ord), (SELECT unnest([0, 1, 2]) AS item_ord),
 LATERAL (SELECT CASE WHEN issn_ord = 0 THEN CAST(1000 + r_regionkey AS VARCHAR) ELSE CASE WHEN r_regionkey % 2 = 0 THEN '9' ELSE '2' END || r_regionkey END AS issn) WHERE NOT starts_with(issn, '9')""")
def paged_pull(spark, sf_dir):  # noqa: ANN001, ANN201
    """Kept pages of two ISSNs a journal: a pull ends at its empty page; a second ISSN without a reply is passed over."""
    r = F.col("r_regionkey").cast("string")
    pulls = table(spark, sf_dir, "region").select(F.col("r_name").alias("jkey"), F.col("r_regionkey").alias("n"), F.explode(F.array(F.lit(0), F.lit(1))).alias("issn_ord"), F.concat(F.lit("100"), r).alias("i0"), F.concat(F.when(F.col("r_regionkey") % 2 == 0, "9").otherwise("2"), r).alias("i1"))
    pages = pulls.select("jkey", "issn_ord", F.when(F.col("issn_ord") == 0, F.col("i0")).otherwise(F.col("i1")).alias("issn"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("page_ord"))
    item = lambda i: F.struct(F.concat(F.lit("10.1/"), "issn", F.lit("-"), F.col("page_ord").cast("string"), F.lit("-"), i.cast("string")).alias("DOI"))
    items = F.when(F.col("page_ord") == 2, F.array().cast("array<struct<DOI: string>>")).otherwise(F.transform(F.sequence(F.lit(0), F.lit(2)), item))
    kept = pages.select("jkey", "issn_ord", "page_ord", (~F.col("issn").startswith("9")).alias("done"), F.to_json(F.struct(F.struct(items.alias("items")).alias("message"))).alias("body"))
    return json_docs.page_items(kept).select("jkey", "issn_ord", "page_ord", "item_ord", F.get_json_object("body", "$.DOI").alias("doi"))


@query("""SELECT n_name AS key, CASE WHEN n_nationkey % 5 = 0 THEN 'no ISSN' WHEN n_nationkey % 4 = 0 THEN 'no journal for ISSN ' || n_nationkey || ' (HTTP 404)' WHEN n_nationkey % 2 = 1 THEN 'title mismatch' END AS warning FROM nation""")
def issn_check(spark, sf_dir):  # noqa: ANN001, ANN201
    """Registered titles by first ISSN, from the registry's dump, against the journals' names; warnings only."""
    n = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation")
    dims = nations.select(F.col("n_name").alias("key"), F.when(n % 2 == 0, F.concat(F.lit("Journal "), n.cast("string"))).otherwise("Elsewhere").alias("name"), F.when(n % 5 > 0, F.array(n.cast("string"))).otherwise(F.array().cast("array<string>")).alias("issns"), F.lit(False).alias("retired"))
    registered = nations.where(n % 4 > 0).select(n.cast("string").alias("issn"), F.concat(F.lit("The Journal "), n.cast("string")).alias("title"))
    return jobs.issn_check(dims, Dumps(works=nations, journals=registered), CONFIG).select("key", "warning")


def searched_papers(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("doc_id")
    name = F.concat(F.lit("Ann Lee"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (k % 3 + 1).cast("int")))
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("10.1/"), k).alias("doi_key"), F.concat(F.lit("Paper "), k, F.lit(" on the order of things")).alias("title"), F.lit("2021").alias("year"), F.array(name, F.lit("Bo Chen")).alias("authors"))


FOUND = "CASE WHEN doc_id % 3 = 0 THEN 'https://papers.ssrn.com/sol3/papers.cfm?abstract_id=' || doc_id END"


def open_hits(spark, sf_dir):  # noqa: ANN001, ANN201
    """(doi_key, ord, hit): two hits of each title search. The first is by other people; the second, in capitals, matches
    where it is there (documents divisible by 3)."""
    k = F.col("doc_id")
    p = table(spark, sf_dir, "documents").select(k, F.concat(F.lit("10.1/"), k).alias("doi_key"), F.concat(F.lit("Paper "), k, F.lit(" on the order of things")).alias("title"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (k % 3 + 1).cast("int")).alias("l"))
    person = lambda name: F.array(F.struct(F.struct(name.alias("display_name")).alias("author")))
    place = F.array(F.struct(F.lit("https://arxiv.org/abs/1").alias("landing_page_url")))
    none = F.array().cast("array<struct<landing_page_url: string>>")
    hit = lambda doi, title, year, who, places: F.struct(doi.alias("doi"), title.alias("title"), F.lit(year).alias("publication_year"), who.alias("authorships"), places.alias("locations"))
    other = hit(F.lit(None).cast("string"), F.col("title"), 2020, person(F.lit("Zoe Quux")), place)
    match = hit(F.concat(F.lit("10.2139/ssrn."), k), F.upper("title"), 2019, person(F.concat(F.lit("Ann L. Lee"), "l")), none)
    return p.select("doi_key", k, F.posexplode(F.when(k % 3 == 0, F.array(other, match)).otherwise(F.array(other))).alias("ord", "hit"))


def registry_works(spark, sf_dir):  # noqa: ANN001, ANN201
    """(doi_key, work): the registry's work of each document divisible by 5; where by 10 it is many years too late."""
    k = F.col("doc_id")
    year = F.when(k % 10 == 0, 2035).otherwise(2020)
    family = F.concat(F.lit("Lee"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (k % 3 + 1).cast("int")))
    work = F.struct(F.concat(F.lit("10.2139/ssrn."), k).alias("DOI"), F.array(F.concat(F.lit("Paper "), k, F.lit(" on the order of things"))).alias("title"), F.array(F.struct(F.lit("Ann").alias("given"), family.alias("family"))).alias("author"), F.struct(F.array(F.array(year)).alias("date-parts")).alias("issued"))
    return table(spark, sf_dir, "documents").where(k % 5 == 0).select(F.concat(F.lit("10.1/"), k).alias("doi_key"), k, work.alias("work"))


@query("""SELECT '10.1/' || doc_id AS doi_key, 'https://papers.ssrn.com/sol3/papers.cfm?abstract_id=' || doc_id AS u, 'ssrn' AS s, 'exact' AS kind FROM documents WHERE doc_id % 3 = 0""")
def title_search(spark, sf_dir):  # noqa: ANN001, ANN201
    """Kept replies of a title search: the first hit whose title, surnames and year agree; a hit by others is passed over.
    One shared name is enough only where a list has no more."""
    p = written(searched_papers(spark, sf_dir))
    replies = open_hits(spark, sf_dir).groupBy("doi_key", "doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "hit"))).alias("h"))
    replies = replies.select("doi_key", F.col("doc_id").alias("call"), F.to_json(F.struct(F.transform("h", lambda x: x["hit"]).alias("results"))).alias("body"))
    got = lookups.hits(replies, replies.select(F.col("call").alias("batch"), F.lit(True).alias("done"), "body"), "open")
    hits = got.select("doi_key", F.posexplode("hits").alias("ord", "h")).select("doi_key", "ord", F.from_json("h", SEARCH_HIT).alias("hit"))
    return matching.match_hits(p, hits)


@query("""SELECT '10.1/' || doc_id AS doi_key, 'https://papers.ssrn.com/sol3/papers.cfm?abstract_id=' || doc_id AS u, 'ssrn' AS s, 'exact' AS kind FROM documents WHERE doc_id % 5 = 0 AND doc_id % 10 <> 0""")
def registry_search(spark, sf_dir):  # noqa: ANN001, ANN201
    """Kept replies of the second engine: family names, links by DOI only, and a year after the paper's is too late."""
    p = written(searched_papers(spark, sf_dir))
    replies = registry_works(spark, sf_dir).select("doi_key", F.col("doc_id").alias("call"), F.to_json(F.struct(F.struct(F.array("work").alias("items")).alias("message"))).alias("body"))
    got = lookups.hits(replies, replies.select(F.col("call").alias("batch"), F.lit(True).alias("done"), "body"), "registry")
    works = got.select("doi_key", F.posexplode("hits").alias("ord", "h")).select("doi_key", "ord", F.from_json("h", WORK_HIT).alias("hit"))
    return matching.match_works(p, works)


LOW_L, LOW_R = "2010 + doc_id % 20", "2012 + doc_id % 7"


@query(f"""WITH x AS (SELECT doc_id AS k, doc_id // 24 AS t, [chr((97 + doc_id % 5)::INTEGER), chr((102 + doc_id % 3)::INTEGER)] AS two, doc_id % 7 = 0 AS lone, {LOW_L} AS ly, {LOW_R} AS ry FROM documents),
l AS (SELECT k, t, CASE WHEN lone THEN two[:1] ELSE two END AS n, ly AS y, k % 12 = 0 AS longer FROM x WHERE k % 2 = 0), r AS (SELECT k, t, CASE WHEN lone THEN two[:1] ELSE two END AS n, ry AS y FROM x WHERE k % 2 = 1),
m AS (SELECT l.k, r.k AS w, l.longer FROM l JOIN r ON l.t = r.t WHERE len(list_intersect(l.n, r.n)) >= least(2, len(l.n), len(r.n)) AND r.y BETWEEN l.y - CASE WHEN l.longer THEN 6 ELSE 12 END AND l.y + 1)
SELECT k AS id, min(w) AS work, CASE WHEN any_value(longer) THEN 'prefix' ELSE 'exact' END AS kind FROM m GROUP BY k""")
def corpus_match(spark, sf_dir):  # noqa: ANN001, ANN201
    """Papers against a whole corpus of works: titles by their first characters (some papers have a subtitle more), surnames by
    the rarer ones of each list, years in a window; of several works the first."""
    k = F.col("doc_id")
    letter = lambda a, n: F.concat(F.lit("Ann Lee"), F.chr((F.lit(a) + k % n).cast("int")))
    two = F.array(letter(97, 5), letter(102, 3))
    title = F.concat(F.lit("The order of things number "), F.floor(k / 24).cast("string"), F.lit(" explained"))
    d = table(spark, sf_dir, "documents").select(k.alias("id"), title.alias("t"), F.when(k % 7 == 0, F.slice(two, 1, 1)).otherwise(two).alias("authors"), (k % 20 + 2010).cast("string").alias("ly"), (k % 7 + 2012).cast("string").alias("ry"))
    papers = d.where("id % 2 = 0").select("id", F.when(F.col("id") % 12 == 0, F.concat("t", F.lit(": at length"))).otherwise(F.col("t")).alias("title"), F.col("ly").alias("year"), "authors")
    works = d.where("id % 2 = 1").select("id", F.col("id").alias("ord"), F.upper("t").alias("title"), F.col("ry").alias("year"), "authors")
    return matching.match_corpora(papers, works)


@query("""SELECT source AS jkey, '10.1/' || doc_id AS doi_key, (2000 + doc_id % 20)::INTEGER AS year, n_chars::BIGINT AS c FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY source) = 1""")
def ranged_documents(spark, sf_dir):  # noqa: ANN001, ANN201
    """Each source's works in one reply and all counts in one keyed document, both read by byte ranges."""
    k, base = F.col("doc_id"), folder(spark)
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").groupBy("doc_id").agg(F.min_by(F.struct("source", "n_chars"), "source").alias("x")).select("doc_id", "x.*")
    doi = F.concat(F.lit("10.1/"), k)
    author = F.array(F.struct(F.lit("Ann },{").alias("given"), F.lit("Lee").alias("family")), F.struct(F.lit('Bo "},"').alias("given"), F.lit("Roe").alias("family")))
    work = F.struct(doi.alias("DOI"), author.alias("author"), F.struct(F.array(F.array((k % 20 + 2000).cast("int"))).alias("date-parts")).alias("issued"))
    reply(d.select(F.col("source").alias("jkey"), k.alias("o"), work.alias("work")), base)
    document(keyed_document(d, doi, F.struct(F.col("n_chars").alias("c"), F.lit(1).alias("t"))), f"{base}/citations.json")
    works = json_docs.works_folder(spark, base, d.select(F.col("source").alias("key")).distinct())
    year = F.get(F.get("issued.date-parts", F.lit(0)), F.lit(0))
    return works.select("jkey", F.col("DOI").alias("doi_key"), year.alias("year")).join(json_docs.citation_cache(spark, f"{base}/citations.json").select("doi_key", "c"), "doi_key", "left").select("jkey", "doi_key", "year", "c")


FLAGS = "n % 2 = 0 AS editors, n % 3 = 0 AS se, n % 4 = 0 AS ae, n % 5 = 0 AS aia"


@query(f"""WITH j AS (SELECT source, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) AS n, count(*) AS c, min(CASE WHEN doc_id % 50 > 0 THEN 1950 + doc_id % 50 END) AS y FROM documents GROUP BY source), f AS (SELECT *, {FLAGS} FROM j)
SELECT source AS key, CASE WHEN n % 7 = 3 THEN 'https://shard' END AS base, CASE WHEN n % 7 <> 3 THEN c END::BIGINT AS count, CASE WHEN n % 7 <> 3 THEN y END::BIGINT AS first_year,
 CASE WHEN editors THEN TRUE END AS editors, CASE WHEN se THEN TRUE END AS se, CASE WHEN ae THEN TRUE END AS ae, CASE WHEN aia THEN TRUE END AS aia FROM f WHERE n <> 11""")
def manifest_entries(spark, sf_dir):  # noqa: ANN001, ANN201
    """The manifest of journals with flags, of which some live in another shard (a base, no counts) and one is retired."""
    n, none = F.regexp_extract("key", "[0-9]+", 0).cast("long"), F.lit(None)
    more = {c: none.cast("string") for c in ("short", "publisher", "abs", "url")} | {c: none.cast("boolean") for c in ("limitedCoverage", "notFT")}
    dims = journals_of(spark, sf_dir).withColumns(more | {"base": F.when(n % 7 == 3, "https://shard").when(n % 7 == 4, ""), "retired": n == 11})
    papers = table(spark, sf_dir, "documents").select(F.col("source").alias("jkey"), F.when(F.col("doc_id") % 50 > 0, (F.col("doc_id") % 50 + 1950).cast("string")).otherwise("").alias("year"))
    return publish.manifest(papers, dims).select("key", "base", "count", "first_year", "editors", F.col("seEditors").alias("se"), F.col("aeEditors").alias("ae"), "aia")


@query("""WITH o AS (SELECT source, doc_id AS k, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) AS n FROM documents), f AS (SELECT * FROM o WHERE NOT (n % 4 = 0 AND k % 3 > 0)),
c AS (SELECT source, count(*) AS committed, any_value(n) AS n FROM o GROUP BY source), s AS (SELECT source, count(*) AS fresh, count(CASE WHEN k % 7 = 0 THEN 1 END) AS more, count(CASE WHEN k % 5 = 0 THEN 1 END) AS moved FROM f GROUP BY source)
SELECT source, (coalesce(fresh, 0) + coalesce(more, 0))::BIGINT AS fresh, committed::BIGINT AS committed, coalesce(more, 0)::BIGINT AS added, (committed - coalesce(fresh, 0))::BIGINT AS gone, coalesce(moved, 0)::BIGINT AS changed,
 CASE WHEN 2 * (coalesce(fresh, 0) + coalesce(more, 0)) < committed THEN 'committed' ELSE 'fresh' END AS kept, (CASE WHEN 2 * (coalesce(fresh, 0) + coalesce(more, 0)) < committed THEN committed ELSE coalesce(fresh, 0) + coalesce(more, 0) END)::BIGINT AS rows FROM c LEFT JOIN s USING (source)""")
def fallback_provenance(spark, sf_dir):  # noqa: ANN001, ANN201
    """A pull against what is committed: keys added, gone and changed in each source, and which side was kept."""
    n = F.regexp_extract("source", "[0-9]+", 0).cast("long")
    old = table(spark, sf_dir, "documents").select("source", "doc_id", F.col("doc_id").cast("string").alias("key"), F.lit("t").alias("title"))
    new = old.where(~((n % 4 == 0) & (F.col("doc_id") % 3 > 0))).withColumn("title", F.when(F.col("doc_id") % 5 == 0, "T").otherwise("t"))
    new = new.unionByName(new.where("doc_id % 7 = 0").withColumn("key", F.concat("key", F.lit("+"))))
    kept, told = rows.fallback(new, old, "source", "key", ["title"])
    return told.join(kept.groupBy("source").agg(F.count("*").alias("rows")), "source", "left")


@query("""SELECT page_id, len(u)::BIGINT AS n, array_to_string(u, ' ') AS urls FROM (SELECT page_id, list_filter(list_concat(list_concat([url, ''], h), [h[1], url]), lambda x: coalesce(x, '') <> '') AS u FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]+)"', 1) AS h FROM pages))""")
def candidate_urls(spark, sf_dir):  # noqa: ANN001, ANN201
    """A hit's addresses in order, from hits made of each page's links."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    pair = lambda a, b: F.struct(a.alias("landing_page_url"), b.alias("pdf_url"))
    places = F.concat(F.array(pair(F.col("url"), F.lit(""))), F.transform(links, lambda u: pair(u, F.lit(None).cast("string"))))
    hit = F.struct(places.alias("locations"), pair(F.get(links, F.lit(0)), F.lit("")).alias("best_oa_location"), pair(F.lit(None).cast("string"), F.col("url")).alias("primary_location"))
    found = table(spark, sf_dir, "pages").select("page_id", hit.alias("hit")).select("page_id", matching.candidate_urls("hit").alias("l"))
    return found.select("page_id", F.size("l").cast("long").alias("n"), F.array_join("l", " ").alias("urls"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'https://papers.ssrn.com/sol3/papers.cfm?abstract_id=' || o_custkey WHEN 1 THEN 'https://arxiv.org/abs/' || o_custkey || '.1' WHEN 2 THEN 'https://doi.org/10.1101/2020.01.02.' || o_custkey
 WHEN 3 THEN 'https://www.nber.org/papers/w' || o_custkey WHEN 4 THEN 'https://osf.io/x_' || o_custkey END AS u, CASE o_orderkey % 6 WHEN 0 THEN 'ssrn' WHEN 1 THEN 'arxiv' WHEN 2 THEN 'cshl' WHEN 3 THEN 'nber' WHEN 4 THEN 'osf' END AS s, '0-' || o_custkey AS orcid,
 replace('a b&' || o_orderstatus, ' ', '%20')[:4] || '%20'[4:] || 'b%26' || o_orderstatus AS encoded FROM orders""".replace("replace('a b&' || o_orderstatus, ' ', '%20')[:4] || '%20'[4:] || 'b%26' || o_orderstatus", "'a%20b%26' || o_orderstatus"))
def identifiers(spark, sf_dir):  # noqa: ANN001, ANN201
    """Links from five DOI forms, ORCIDs without their address, encoded query text."""
    c = F.col("o_custkey").cast("string")
    forms = [F.concat(F.lit(a), c, F.lit(b)) for a, b in (("10.2139/SSRN.", ""), ("https://doi.org/10.48550/arXiv.", ".1v3"), ("10.1101/2020.01.02.", ""), ("10.3386/W", ""), ("10.31219/osf.io/x_", ""), ("10.1101/gr.", ""))]
    found = T.preprint_from_doi(F.element_at(F.array(*forms), (F.col("o_orderkey") % 6 + 1).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", found["u"].alias("u"), found["s"].alias("s"), T.orcid(F.concat(F.lit("https://orcid.org/0-"), c)).alias("orcid"), T.url_encoded(F.concat(F.lit("a b&"), "o_orderstatus")).alias("encoded"))


@query("""WITH x AS (SELECT doc_id, chr((65 + doc_id % 26)::INTEGER) AS l, doc_id % 6 AS m FROM documents)
SELECT doc_id, CASE m WHEN 0 THEN l || 'nn Gopal' WHEN 1 THEN l || 'nn Lee; Bo Chen' WHEN 2 THEN 'K. S' || lower(l) || 'dhir' WHEN 3 THEN l || 'da Moe' WHEN 4 THEN '' ELSE 'Jo Roe' END AS se,
 CASE m WHEN 0 THEN 'Hong Xu' WHEN 1 THEN 'Cy D' || lower(l) || 'az' WHEN 2 THEN 'Jo Roe' WHEN 5 THEN l || 'l Poe' ELSE '' END AS ae FROM x""")
def split_plausible_names(spark, sf_dir):  # noqa: ANN001, ANN201
    """Editors of a history note for each document: lists, labels, sentences, titles, and text that names nobody."""
    letter = F.chr((F.lit(65) + F.col("doc_id") % 26).cast("int"))
    low = F.lower(letter)
    notes = (
        F.concat(F.lit("History: Dr. "), letter, F.lit("nn Gopal, Senior Editor; Dr. Hong Xu, Associate Editor.")), F.concat(F.lit("Senior Editor: "), letter, F.lit("nn Lee and Bo Chen. Associate Editor: Cy D"), low, F.lit("az.")),
        F.concat(F.lit("It came in May. K. S"), low, F.lit("dhir served as the senior editor and Jo Roe served as associate editor.")), F.concat(F.lit("<b>Prof. "), letter, F.lit("da Moe</b> served as the senior editor.")),
        F.lit("The paper was received in May; the committee, Senior Editor."), F.concat(F.lit("Jo Roe, Senior Editor; Mr. "), letter, F.lit("l Poe, the Associate Editor; Jo Roe served as senior editor")),
    )
    note = F.element_at(F.array(*notes), (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", T.parse_editors(note).alias("e")).select("doc_id", "e.se", "e.ae")


@query("""WITH x AS (SELECT o_orderkey AS k, c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Ann Q. Cust' WHEN 1 THEN 'ANN Cust' ELSE 'Bo Z Cust' END || chr(((c_custkey // 3) % 20 + 97)::INTEGER) AS name, CASE WHEN c_custkey % 3 = 2 AND (c_custkey // 3) % 4 = 0 THEN '0-' || chr(((c_custkey // 3) % 20 + 97)::INTEGER) WHEN c_custkey % 3 = 1 AND (c_custkey // 3) % 4 = 0 THEN '0-' || chr(((c_custkey // 3) % 20 + 97)::INTEGER) ELSE '' END AS orcid
 FROM orders JOIN customer ON o_custkey = c_custkey), n AS (SELECT DISTINCT lower(name) AS name_key FROM x),
p AS (SELECT orcid, lower(name) AS name_key, count(*) AS n FROM x WHERE orcid <> '' GROUP BY ALL), g AS (SELECT * FROM p WHERE n >= 2 OR orcid IN (SELECT orcid FROM p GROUP BY orcid HAVING count(*) = 1)),
s AS (SELECT name_key, regexp_replace(name_key, ' [a-z]\\.? ', ' ') AS short FROM n), i AS (SELECT name_key AS a, short AS b FROM s WHERE short <> name_key AND short IN (SELECT name_key FROM n)),
e AS (SELECT 'n:' || name_key AS a, 'o:' || orcid AS b FROM g UNION SELECT 'n:' || a, 'n:' || b FROM i), y AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
one AS (SELECT a AS node, least(a, min(b)) AS l FROM y GROUP BY a), two AS (SELECT y.a AS node, least(min(one.l), any_value(o2.l)) AS l FROM y JOIN one ON y.b = one.node JOIN one o2 ON y.a = o2.node GROUP BY y.a),
three AS (SELECT y.a AS node, least(min(two.l), any_value(t2.l)) AS l FROM y JOIN two ON y.b = two.node JOIN two t2 ON y.a = t2.node GROUP BY y.a)
SELECT name_key, coalesce(l, 'n:' || name_key) AS root FROM n LEFT JOIN three ON node = 'n:' || name_key""".replace("\\\\", "\\"))
def author_identities(spark, sf_dir):  # noqa: ANN001, ANN201
    """Names that share an identifier, or differ by a middle initial from a name that exists itself."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    third, tail = F.col("c_custkey") % 3, F.chr((F.floor(F.col("c_custkey") / 3) % 20 + 97).cast("int"))
    name = F.concat(F.when(third == 0, "Ann Q. Cust").when(third == 1, "ANN Cust").otherwise("Bo Z Cust"), tail)
    marked = (third > 0) & (F.floor(F.col("c_custkey") / 3) % 4 == 0)
    return entities.identities(o.select(name.alias("name"), F.when(marked, F.concat(F.lit("0-"), tail)).otherwise("").alias("orcid")))


@query("""SELECT l_orderkey, min(struct_pack(a := l_linenumber, b := l_partkey)).b AS part FROM lineitem WHERE l_discount >= 0.05 GROUP BY l_orderkey""")
def first_acceptable(spark, sf_dir):  # noqa: ANN001, ANN201
    """Of each order's lines the first that is acceptable."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount").withColumn("o", F.struct("l_linenumber", "l_partkey"))
    return rows.first_acceptable(li, "l_orderkey", F.col("l_discount") >= 0.05, "o").select("l_orderkey", F.col("l_partkey").alias("part"))


@query("""WITH k AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS reg_key, event_type FROM events), r AS (SELECT CAST(user_id AS VARCHAR) AS reg_key FROM events WHERE event_type = 'purchase')
SELECT reg_key, min(event_type) AS src_ord FROM k WHERE reg_key NOT IN (SELECT reg_key FROM r) GROUP BY reg_key UNION ALL SELECT reg_key || '+', min(event_type) FROM k GROUP BY reg_key""")
def cross_source_claim(spark, sf_dir):  # noqa: ANN001, ANN201
    """Which source claims each new key, as the registry itself decides it."""
    from quire.operators import registry

    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("src_ord"), F.col("user_id").cast("string").alias("reg_key"))
    known = ev.where("src_ord = 'purchase'").select("reg_key")
    return registry.claims(ev, known).unionByName(registry.claims(ev.withColumn("reg_key", F.concat("reg_key", F.lit("+"))), known)).select("reg_key", "src_ord")


@query(f"""WITH {SEEN}, r AS (SELECT source AS jkey, '10.1/d' || k AS doi_key, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN k % 3 = 0 THEN 1999 ELSE 2000 + k % 20 END DESC, '10.1/d' || k) AS place FROM w)
SELECT jkey, doi_key, place::BIGINT AS place FROM r""")
def published_order(spark, sf_dir):  # noqa: ANN001, ANN201
    """The published folder of each journal: written in order and read back file by file."""
    path = folder(spark)
    publish.write_papers(built(spark, sf_dir).select(*PAPER_COLUMNS), path)
    back = spark.read.option("recursiveFileLookup", False).parquet(path).select("jkey", "doi_key", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    placed = back.groupBy("jkey").agg(F.array_sort(F.collect_list(F.struct("f", "i", "doi_key"))).alias("a"))
    return placed.select("jkey", F.posexplode("a").alias("p", "x")).select("jkey", F.col("x.doi_key").alias("doi_key"), (F.col("p") + 1).cast("long").alias("place"))


def dumps_of(spark, sf_dir):  # noqa: ANN001, ANN201
    """The services' dumps: a record of each document that is not divisible by 3, with its count and (odd ones) links; the
    works that title searches find; counts of the second source; the registry's works."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select(k).distinct()
    address = F.struct(F.concat(F.lit("https://papers.ssrn.com/x?id="), k).alias("landing_page_url"), F.concat(F.lit("https://arxiv.org/pdf/"), k, F.lit("v2.pdf")).alias("pdf_url"))
    record = F.struct(F.concat(F.lit("https://doi.org/10.1/"), k).alias("doi"), k.alias("cited_by_count"), F.when(k % 2 == 1, F.array(address)).alias("locations"))
    keyed = d.where(k % 3 > 0).select((3 * k).alias("ord"), F.to_json(record).alias("body"))
    found = open_hits(spark, sf_dir).dropDuplicates(["doc_id", "ord"]).select((3 * k + 1 + F.col("ord")).alias("ord"), F.to_json("hit").alias("body"))
    counts = d.where(k % 4 > 0).select(F.concat(F.lit("10.1/"), k).alias("doi_key"), (2 * k).alias("c"))
    registered = registry_works(spark, sf_dir).dropDuplicates(["doc_id"]).select(k.alias("ord"), F.to_json("work").alias("body"))
    return Dumps(written(keyed.unionByName(found)), counts, registered)


def dois(spark, sf_dir):  # noqa: ANN001, ANN201
    """Papers without a count or link, one a document."""
    p = searched_papers(spark, sf_dir)
    empty = spark.createDataFrame([], PAPER)
    return empty.unionByName(p, allowMissingColumns=True).withColumns({"jkey": F.lit("j"), "src_ord": F.lit(0).cast("long"), "ord": F.lit(0).cast("long"), "pub_rank": F.lit(0).cast("long")})


@query("""WITH x AS (SELECT doc_id AS k, CASE WHEN doc_id % 3 > 0 THEN doc_id ELSE 0 END AS a, CASE WHEN doc_id % 4 > 0 THEN 2 * doc_id ELSE 0 END AS b FROM documents)
SELECT '10.1/' || k AS doi_key, nullif(greatest(a, b), 0)::BIGINT AS cited_by, CASE WHEN greatest(a, b) > 0 THEN CASE WHEN b > a THEN 's2' ELSE 'oa' END END AS cited_src, (SELECT count(DISTINCT doc_id) FROM documents)::BIGINT AS total, 0::BIGINT AS stale FROM x""")
def citation_sweep(spark, sf_dir):  # noqa: ANN001, ANN201
    """The whole job: queue, two lookups, cache, papers rewritten, and what is still stale."""
    data = folder(spark)
    publish.write_papers(dois(spark, sf_dir), f"{data}/papers")
    left = jobs.citation_sweep(spark, data, 20_000, CONFIG, dumps_of(spark, sf_dir)).first()
    return spark.read.parquet(f"{data}/papers").select("doi_key", "cited_by", "cited_src", F.lit(left.total).alias("total"), F.lit(left.stale).alias("stale"))


@query("""SELECT '10.1/' || doc_id AS doi_key, CASE WHEN doc_id % 3 > 0 AND doc_id % 2 > 0 THEN 'https://arxiv.org/abs/' || doc_id WHEN doc_id % 3 = 0 OR (doc_id % 5 = 0 AND doc_id % 10 <> 0) THEN 'https://papers.ssrn.com/sol3/papers.cfm?abstract_id=' || doc_id END AS preprint,
 CASE WHEN doc_id % 3 > 0 AND doc_id % 2 > 0 THEN 'arxiv' WHEN doc_id % 3 = 0 OR (doc_id % 5 = 0 AND doc_id % 10 <> 0) THEN 'ssrn' END AS preprint_src, 0::BIGINT AS backlog FROM documents""")
def preprint_backfill(spark, sf_dir):  # noqa: ANN001, ANN201
    """The whole job: links by key, then two title searches for what is left, cache, papers rewritten, backlog."""
    data = folder(spark)
    publish.write_papers(dois(spark, sf_dir), f"{data}/papers")
    config = Config(search_cap=100_000)
    left = jobs.preprint_backfill(spark, data, config, dumps_of(spark, sf_dir)).first()
    return spark.read.parquet(f"{data}/papers").select("doi_key", "preprint", "preprint_src", F.lit(left.backlog).cast("long").alias("backlog"))
