"""The catalogue build as DataFrame plans: raw works -> papers -> overlays -> registry -> rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.config import Config
from quire.functions import text as T
from quire.functions.schemas import PAPER_COLUMNS
from quire.operators import entities, registry, rows
from quire.operators.rows import overlay, shrink_guard


def active(journals: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Journals in scope; a list of keys prunes further."""
    out = journals.where(~F.coalesce("retired", F.lit(False)))
    return out.where(F.col("key").isin(*only)) if only else out


def retired(journals: DataFrame) -> DataFrame:
    return journals.where(F.coalesce("retired", F.lit(False)))


def local(journals: DataFrame) -> DataFrame:
    """Journals whose papers are held here, not in another shard (a blank base is also here)."""
    return journals.where(T.or_blank(F.col("base")) == "")


def map_works(works: DataFrame, journals: DataFrame, config: Config, fixups: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """Raw works (jkey, ord, fields) as papers: one projection, with the journal dimension and sidecars joined by key.

    Rows of another type and rows without a title go; rows without a type stay.
    """
    flags = journals.select(F.col("key").alias("jkey"), F.col("name").alias("journal"), "src_ord", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("editors", "seEditors", "aeEditors")])
    w = works.where("type is null or type in ('', 'journal-article')").join(flags, "jkey")
    people = F.filter(F.transform("author", lambda a: F.struct(T.author_name(a["given"], a["family"], a["name"]).alias("name"), T.orcid(a["ORCID"]).alias("orcid"))), lambda p: p["name"] != "")
    places = F.array_distinct(F.filter(F.transform(F.flatten(F.transform("author", lambda a: F.coalesce(a["affiliation"], F.array()))), lambda x: T.squeeze(x["name"])), lambda s: s != ""))
    none = F.array().cast("array<string>")
    first = w.select(
        "jkey", "journal", "src_ord", "ord", "editors", "seEditors", "aeEditors", T.strip_markup(F.try_element_at("title", F.lit(1))).alias("title"),
        F.coalesce(F.transform(people, lambda p: p["name"]), none).alias("authors"), F.coalesce(F.transform(people, lambda p: p["orcid"]), none).alias("orcids"), F.coalesce(places, none).alias("affiliations"),
        T.doi_key(F.col("DOI")).alias("doi_key"), *[T.or_blank(F.col(c)).alias(c) for c in ("volume", "issue", "page")],
        T.year_of(*[F.col(f"`{c}`.`date-parts`") for c in ("issued", "published-print", "published-online", "created")]).alias("year"),
        T.text_prefix(T.strip_markup(F.col("abstract")), config.abstract_limit).alias("abstract"),
        T.first_or_scalar(F.col("group-title")).alias("group_title"), F.try_element_at("subject", F.lit(1)).alias("subject"), T.assertion_editor(F.col("assertion")).alias("by_assertion"), T.positive(F.col("is-referenced-by-count")).alias("cited_by"),
    ).where("title <> ''")
    if fixups is not None:
        first = overlay(first, fixups, "doi_key", fill=("volume", "issue", "page"), override=("year",))
    side = overrides if overrides is not None else first.select("doi_key").limit(0).select("doi_key", F.lit("").alias("editor"), F.lit("").alias("area"))
    given = F.concat(F.lit(T.ACCEPTED), F.regexp_replace(T.or_blank(F.col("editor")), r"\.+$", ""), F.lit("."))
    first = first.join(side.select("doi_key", given.alias("o_editor"), F.col("area").alias("o_area")), "doi_key", "left")
    found = first.withColumn("_a", T.acceptance(F.col("abstract"))).withColumn("_e", T.parse_editors(F.col("abstract")))
    status = T.forthcoming_status(F.col("volume"), F.col("issue"), F.col("year"), config.pull_year)
    out = found.withColumn("status", status).select(
        "jkey", "journal", "src_ord", "ord", "title", "authors", "orcids", "affiliations", "doi_key", "volume", "issue", "page", "year", "status", "abstract",
        F.when(F.col("editors"), T.first_given(F.col("_a.editor"), F.col("by_assertion"), F.col("o_editor"))).otherwise("").alias("editor"),
        F.when(F.col("editors"), F.coalesce(*[T.blank_to_null(T.norm_area(c)) for c in (F.col("_a.area"), F.col("o_area"), F.col("group_title"), F.col("subject"))], F.lit(""))).otherwise("").alias("area"),
        F.when(F.col("seEditors"), F.col("_e.se")).alias("senior_editor"), F.when(F.col("aeEditors"), F.col("_e.ae")).alias("associate_editor"),
        "cited_by", F.lit(None).cast("string").alias("cited_src"), F.lit(None).cast("string").alias("preprint"), F.lit(None).cast("string").alias("preprint_src"),
    )
    return with_rank(out)


def with_rank(papers: DataFrame) -> DataFrame:
    return papers.withColumn("pub_rank", T.pub_rank(F.col("year"), F.col("volume"), F.col("issue"), F.col("page"), F.col("status")))


def map_journals(works: DataFrame, journals: DataFrame, config: Config, **sidecars: DataFrame) -> DataFrame:
    """Papers of each journal, one for each DOI (the first), rows without a DOI all kept."""
    papers = map_works(works, journals, config, **sidecars)
    return rows.keep_first(papers.withColumn("_k", F.when(F.col("doi_key") != "", F.concat_ws("\x01", "jkey", "doi_key"))), "_k", ["ord"]).drop("_k")


def with_fallback(fresh: DataFrame, committed: DataFrame, config: Config) -> DataFrame:
    """Sources that failed (no rows), shrank by more than half or were not asked for keep their committed papers."""
    if config.only:
        asked = F.col("jkey").isin(*config.only)
        return shrink_guard(fresh.where(asked), committed.where(asked), "jkey", config.allow_shrink).unionByName(committed.where(~asked))
    return shrink_guard(fresh, committed, "jkey", config.allow_shrink)


def fallback_reasons(fresh: DataFrame, committed: DataFrame, config: Config) -> DataFrame:
    """For each source that was asked for: papers of the pull and committed ones, keys added, gone and changed, and which
    side with_fallback() keeps. Papers are keyed as in the registry."""
    asked = F.col("jkey").isin(*config.only) if config.only else F.lit(True)
    keyed = [d.where(asked).withColumn("_key", T.reg_key(F.col("doi_key"), F.col("title"), F.col("year"))) for d in (fresh, committed)]
    compared = [c for c in PAPER_COLUMNS if c not in ("jkey", "src_ord", "ord", "cited_by", "cited_src", "preprint", "preprint_src")]
    return rows.fallback(*keyed, "jkey", "_key", compared, config.allow_shrink)[1]


def apply_editors(papers: DataFrame, shared: DataFrame, own: DataFrame | None, journals: DataFrame) -> DataFrame:
    """Cached editors where the text had none, for journals that have the role; an own record hides a shared one."""
    cache = rows.overlay_all(shared, own, "doi_key") if own is not None else shared
    flags = journals.select(F.col("key").alias("jkey"), F.coalesce("seEditors", F.lit(False)).alias("_se"), (F.coalesce("seEditors", F.lit(False)) & F.coalesce("aeEditors", F.lit(False))).alias("_ae"))
    joined = papers.join(cache, "doi_key", "left").join(flags, "jkey", "left")
    filled = {c: F.when(F.col(flag), T.first_given(F.col(c), F.col(s))).otherwise(F.col(c)) for c, flag, s in (("senior_editor", "_se", "se"), ("associate_editor", "_ae", "ae"))}
    return joined.withColumns(filled).select(*papers.columns)


def append_supplement(papers: DataFrame, extra: DataFrame, journals: DataFrame, config: Config) -> DataFrame:
    """Advance papers from the supplement that no journal has yet, for journals that publish in advance."""
    dims = local(active(journals)).where(F.coalesce("aia", F.lit(False))).select(F.col("key").alias("jkey"), F.col("name").alias("journal"), "src_ord", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("seEditors", "aeEditors")])
    # of entries with one DOI the first in the file counts (by their columns, where a table has no place)
    rest = [c for c in extra.columns if c != "doi_key"]
    first = F.min_by(F.struct(*rest), F.struct(*(["pos"] if "pos" in rest else rest))).alias("r")
    named = extra.where("doi_key <> '' and coalesce(Title, '') <> ''").groupBy("doi_key").agg(first).select("doi_key", "r.*")
    new = named.join(papers.select("doi_key"), "doi_key", "left_anti").join(dims, "jkey")
    authors = T.list_split(F.col("Authors"), ",")
    blank = F.lit("")
    out = new.select(
        "jkey", "journal", "src_ord", F.lit(1 << 60).cast("long").alias("ord"), F.col("Title").alias("title"), authors.alias("authors"), F.transform(authors, lambda _: blank).alias("orcids"),
        T.list_split(F.col("Affiliations"), ";").alias("affiliations"), "doi_key", blank.alias("volume"), blank.alias("issue"), blank.alias("page"),
        T.first_given(F.col("Year"), F.lit(str(config.pull_year))).alias("year"), F.lit(T.ADVANCE).alias("status"), T.text_prefix(T.or_blank(F.col("Abstract")), config.abstract_limit).alias("abstract"), blank.alias("editor"), blank.alias("area"),
        F.when(F.col("seEditors"), blank).alias("senior_editor"), F.when(F.col("aeEditors"), blank).alias("associate_editor"),
        F.lit(None).cast("long").alias("cited_by"), *[F.lit(None).cast("string").alias(c) for c in ("cited_src", "preprint", "preprint_src")],
    )
    return papers.unionByName(with_rank(out))


def reg_keys(papers: DataFrame) -> DataFrame:
    return papers.withColumn("reg_key", T.reg_key(F.col("doi_key"), F.col("title"), F.col("year")))


def updated_registry(papers: DataFrame, known: DataFrame, first_run: bool, config: Config) -> DataFrame:
    """Known and new registry rows; places within a source follow its published order."""
    keyed = reg_keys(papers)
    place = F.struct((-F.col("pub_rank")).alias("r"), F.col("reg_key").alias("k"), F.col("ord"))
    new = registry.register(keyed.select("src_ord", "reg_key", place.alias("pos")), known, config.pull_date, first_run, config.influx, config.seed_per_source)
    return known.unionByName(new)


def recent_papers(papers: DataFrame, known: DataFrame, config: Config) -> DataFrame:
    seen = rows.recent(reg_keys(papers), known, "reg_key", "first_seen", config.pull_date, config.recent_days)
    return seen.orderBy(F.desc("first_seen"), F.desc("pub_rank"), "reg_key").limit(config.recent_limit)


def mentions(papers: DataFrame) -> DataFrame:
    """One row an author of a paper, with the paper's order: source, then published order."""
    paired = F.arrays_zip(F.col("authors").alias("n"), F.col("orcids").alias("o"))
    order = F.struct("src_ord", (-F.col("pub_rank")).alias("r"), "doi_key", "ord", F.col("i"))
    return papers.select("*", F.posexplode(paired).alias("i", "p")).select(order.alias("ord"), F.col("p.n").alias("name"), T.or_blank(F.col("p.o")).alias("orcid"), "area", "journal")


def authors(papers: DataFrame, config: Config) -> DataFrame:
    people = mentions(papers)
    rolled = entities.author_rollup(people, entities.identities(people))
    kept = rows.trim_or_top(rolled, "papers", [F.desc("papers"), F.col("author"), F.col("root")], "root", config.author_limit)
    return kept.orderBy(F.desc("papers"), "author", "root").drop("root")


def affiliations(papers: DataFrame, config: Config) -> DataFrame:
    """Names are re-split at ";", as the published list is."""
    order = F.struct("src_ord", (-F.col("pub_rank")).alias("r"), "doi_key", F.col("paper"), F.col("i"))
    paper = F.concat_ws("\x01", "jkey", "doi_key", F.col("ord").cast("string"))
    each = papers.withColumn("paper", paper).select("*", F.posexplode(T.list_split(F.array_join("affiliations", "; "), ";")).alias("i", "affiliation"))
    rolled = entities.facet_rollup(each.select("paper", "affiliation", "area", order.alias("o")), "paper", "affiliation", "area", "o")
    return rolled.orderBy(F.desc("papers"), "name", "facet_key").limit(config.affiliation_limit).drop("facet_key")
