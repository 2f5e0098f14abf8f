"""Published tables: the public view of papers, partitions by journal, manifest and meta."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.schemas import PAPER_COLUMNS
from quire.functions.text import blank_to_null, doi_key, list_split, prefix_int
from quire.plans.build import with_rank


def public(papers: DataFrame) -> DataFrame:
    """Papers without internal columns; lists are joined, ORCIDs only if there is one (empty places stay)."""
    orcids = F.when(F.exists("orcids", lambda o: F.coalesce(o, F.lit("")) != ""), F.array_join("orcids", "|", ""))
    return papers.select(
        F.col("title").alias("Title"), F.array_join("authors", ", ").alias("Authors"), F.array_join("affiliations", "; ").alias("Affiliations"),
        F.when(F.col("doi_key") != "", F.concat(F.lit("https://doi.org/"), "doi_key")).otherwise("").alias("DOI"),
        F.col("volume").alias("Volume"), F.col("issue").alias("Issue"), F.col("page").alias("Page"), F.col("year").alias("Year"), F.col("status").alias("Status"), F.col("abstract").alias("Abstract"),
        F.col("editor").alias("Accepting Editor"), F.col("area").alias("Area"), F.col("senior_editor").alias("Senior Editor"), F.col("associate_editor").alias("Associate Editor"),
        F.col("journal").alias("Journal"), F.col("jkey").alias("JKey"), F.col("cited_by").alias("CitedBy"), F.col("cited_src").alias("CitedBySrc"), F.col("preprint").alias("Preprint"), F.col("preprint_src").alias("PreprintSrc"), orcids.alias("Orcids"),
    )


def rehydrated(published: DataFrame, journals: DataFrame) -> DataFrame:
    """Papers from their public view: key from the DOI's address, lists split again, rank computed anew."""
    dims = journals.select(F.col("key").alias("JKey"), "src_ord")
    authors = list_split(F.col("Authors"), ",")
    orcids = F.coalesce(F.split("Orcids", r"\|"), F.transform(authors, lambda _: F.lit("")))
    names = {"title": "Title", "volume": "Volume", "issue": "Issue", "page": "Page", "year": "Year", "status": "Status", "abstract": "Abstract", "editor": "Accepting Editor", "area": "Area", "senior_editor": "Senior Editor", "associate_editor": "Associate Editor", "cited_by": "CitedBy", "cited_src": "CitedBySrc", "preprint": "Preprint", "preprint_src": "PreprintSrc", "jkey": "JKey", "journal": "Journal"}
    out = published.join(dims, "JKey", "left").select(*[F.col(f"`{v}`").alias(k) for k, v in names.items()], "src_ord", F.lit(0).cast("long").alias("ord"), authors.alias("authors"), orcids.alias("orcids"), list_split(F.col("Affiliations"), ";").alias("affiliations"), doi_key(F.col("DOI")).alias("doi_key"))
    return with_rank(out).select(*PAPER_COLUMNS)


def write_papers(papers: DataFrame, path: str) -> None:
    """One folder a journal, sorted as published; only the journals written are replaced. Rows are dealt by ranges of
    (journal, rank), so a large journal has several files, in order, and no task has to hold it."""
    order = ["jkey", F.desc("pub_rank"), "doi_key", "ord"]
    ordered = papers.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("jkey").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One minified JSON file; equal data give equal bytes. For bounded, ordered tables only."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", True).json(path)


def drop_retired(papers: DataFrame, journals: DataFrame) -> DataFrame:
    return papers.join(journals.where(F.coalesce("retired", F.lit(False))).select(F.col("key").alias("jkey")), "jkey", "left_anti")


def source_counts(papers: DataFrame, source: str, year: str) -> DataFrame:
    """count and first positive year of each source."""
    y = prefix_int(F.col(year))
    return papers.groupBy(source).agg(F.count("*").alias("count"), F.min(F.when(y != 0, y)).alias("first_year"))


def manifest(papers: DataFrame, journals: DataFrame) -> DataFrame:
    """One entry a journal; flags only if true, no count for journals of another shard."""
    counts = source_counts(papers, "jkey", "year")
    flags = [F.when(F.coalesce(c, F.lit(False)), True).alias(c) for c in ("aia", "editors", "seEditors", "aeEditors", "limitedCoverage", "notFT")]
    away = F.coalesce(blank_to_null(F.col("base")), F.lit("")) != ""
    dims = journals.where(~F.coalesce("retired", F.lit(False))).select("key", "name", "short", "publisher", "abs", "url", blank_to_null(F.col("base")).alias("base"), "src_ord", away.alias("_away"), *flags)
    joined = dims.join(counts.withColumnRenamed("jkey", "key"), "key", "left")
    return joined.withColumns({"count": F.when(~F.col("_away"), F.coalesce("count", F.lit(0))), "first_year": F.when(~F.col("_away"), F.col("first_year"))}).drop("_away").orderBy("src_ord").drop("src_ord")


def meta(papers: DataFrame, journals: DataFrame, pull_date: str) -> DataFrame:
    """One row: date, number of papers and journals, and a map of papers per source."""
    counts = manifest(papers, journals)
    held = F.filter(F.collect_list(F.struct("key", "count")), lambda e: e["count"].isNotNull())
    return counts.agg(F.lit(pull_date).alias("updated"), F.coalesce(F.sum("count"), F.lit(0)).alias("paper_count"), F.count("*").alias("journal_count"), F.map_from_entries(held).alias("per_source"))


def unconfirmed_titles(journals: DataFrame, registered: DataFrame) -> DataFrame:
    """Active journals with what the ISSN registry (key, title) says and whether that agrees; a warning, not an error."""
    from quire.operators.matching import title_agrees

    return journals.where(~F.coalesce("retired", F.lit(False))).join(registered, "key", "left").select("key", "name", "title", F.coalesce(title_agrees(F.col("name"), F.col("title")), F.lit(False)).alias("ok"))
