"""JSON sources: whole documents, sidecars keyed by identifier, search replies, API pages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.schemas import CITATIONS, COUNTS, EDITORS, ENVELOPE, FIXUPS, JOURNAL, OVERRIDES, PREPRINTS, SUPPLEMENT, WORK
from quire.sources import ranges


def json_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The document's rows; a missing or corrupt one gives none."""
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.option("wholetext", True).text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string")


def journals(spark: SparkSession, path: str) -> DataFrame:
    """The journal dimension with src_ord, its place in the file. A broken file is an error here."""
    rows = spark.read.option("wholetext", True).text(path)
    parsed = rows.select(F.from_json("value", f"array<struct<{JOURNAL}>>", {"mode": "FAILFAST"}).alias("a"))
    return parsed.select(F.posexplode("a").alias("src_ord", "j")).select(F.col("src_ord").cast("long").alias("src_ord"), "j.*")


def sidecar(spark: SparkSession, path: str, schema: str, key: str = "doi_key", place: bool = False) -> DataFrame:
    """An object of records by key as a table; a "map" member, if there is one, holds the records. place: with each
    record's place in the file (pos).

    A document in minified form is read by byte ranges, several tasks a file; others are read whole.
    """
    out = lambda df: df.select(F.lower("k").alias(key), *[F.col("pos").cast("long").alias("pos")] * place, "v.*")
    inner = F.coalesce(F.get_json_object("value", "$.map"), F.col("value"))
    whole = lambda text: text.select(F.posexplode(F.from_json(inner, f"map<string,struct<{schema}>>")).alias("pos", "k", "v"))
    ranged = ranges.members(spark, path, schema)
    if ranged is None:
        return out(whole(whole_text(spark, path)))
    each, odd = ranged
    if odd.isEmpty():
        return out(each)
    rest = whole_text(spark, path).select("value", F.col("_metadata.file_path").alias("file")).join(odd, "file", "left_semi")
    return out(each.select("pos", "k", "v").unionByName(whole(rest)))


def fixups(spark: SparkSession, path: str) -> DataFrame:
    return sidecar(spark, path, FIXUPS)


def supplement(spark: SparkSession, path: str) -> DataFrame:
    return sidecar(spark, path, SUPPLEMENT, place=True)


def editors_cache(spark: SparkSession, path: str) -> DataFrame:
    return sidecar(spark, path, EDITORS)


def overrides(spark: SparkSession, path: str) -> DataFrame:
    return sidecar(spark, path, OVERRIDES)


def preprint_cache(spark: SparkSession, path: str) -> DataFrame:
    return sidecar(spark, path, PREPRINTS).select("doi_key", F.col("u").alias("url"), F.col("s").alias("src"), (F.coalesce("none", F.lit(0)) == 1).alias("none"), "ts")


def citation_cache(spark: SparkSession, path: str) -> DataFrame:
    return sidecar(spark, path, CITATIONS).select("doi_key", "c", "t", (F.coalesce("s2", F.lit(0)) == 1).alias("s2"))


def registry(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """(reg_key, first_seen) and whether this is a first run: no readable registry. A blank date is known, not news."""
    parsed = whole_text(spark, path).select(F.from_json("value", "map<string,string>").alias("m")).where("m is not null")
    first = parsed.isEmpty()
    return parsed.select(F.explode("m").alias("reg_key", "d")).select("reg_key", F.col("d").try_cast("date").alias("first_seen")), first


def place_of(issn: Column, page: Column, item: Column) -> Column:
    return (issn.cast("long") * 10**12 + page.cast("long") * 10**6 + item).cast("long")


def listed(value: Column) -> Column:
    """The items of a reply {message: {items}} or of a bare array."""
    wrapped = F.from_json(value, ENVELOPE)["message"]["items"]
    return F.when(F.startswith(F.ltrim(value), F.lit("[")), F.from_json(value, f"array<struct<{WORK}>>")).otherwise(wrapped)


def works(spark: SparkSession, path: str, jkey: str, issn_ord: int = 0, page_ord: int = 0) -> DataFrame:
    """Items of one reply, in order."""
    items = whole_text(spark, path).select(F.posexplode(listed(F.col("value"))).alias("pos", "work"))
    return items.select(F.lit(jkey).alias("jkey"), place_of(F.lit(issn_ord), F.lit(page_ord), F.col("pos")).alias("ord"), "work.*")


#: works-<journal>.json, or a page of one of its ISSNs: works-<journal>.<issn>.<page>.json (places from 0).
WORKS_FILE = r"^works-(.+?)(?:\.(\d+)\.(\d+))?\.json$"


def works_folder(spark: SparkSession, folder: str, journals: DataFrame) -> DataFrame:
    """Items of all pulls of a folder in one scan, a large file in several tasks; the file's name gives journal, ISSN and page. Pulls of
    several ISSNs are one list in their order. Files of other journals are left out."""
    ranged = ranges.items(spark, folder, WORK, "works-*.json")
    if ranged is None:
        return spark.createDataFrame([], f"jkey string, ord long, {WORK}")
    items, odd = ranged
    items = items.select("file", "pos", F.col("item").alias("work"))
    if not odd.isEmpty():
        text = spark.read.option("wholetext", True).option("pathGlobFilter", "works-*.json").text(folder).select("value", F.col("_metadata.file_path").alias("file"))
        whole = text.join(odd, "file", "left_semi").select("file", F.posexplode(listed(F.col("value"))).alias("pos", "work"))
        items = items.unionByName(whole.withColumn("pos", F.col("pos").cast("long")))
    name = F.url_decode(F.regexp_extract("file", "[^/]*$", 0))
    number = lambda g: F.coalesce(F.regexp_extract(name, WORKS_FILE, g).try_cast("int"), F.lit(0))
    filed = items.select(F.regexp_extract(name, WORKS_FILE, 1).alias("jkey"), number(2).alias("issn"), number(3).alias("page"), "pos", "work")
    held = filed.join(journals.select(F.col("key").alias("jkey")), "jkey", "left_semi")
    return held.select("jkey", place_of(F.col("issn"), F.col("page"), F.col("pos")).alias("ord"), "work.*")


def pulled_works(raw: DataFrame) -> DataFrame:
    """The rows of the paged source (jkey, issn_ord, page_ord, item_ord, body: one record each) as works."""
    parsed = raw.select("jkey", place_of(F.col("issn_ord"), F.col("page_ord"), F.col("item_ord")).alias("ord"), F.from_json("body", WORK).alias("work"))
    return parsed.select("jkey", "ord", "work.*")


def page_items(pages: DataFrame) -> DataFrame:
    """Items (jkey, issn_ord, page_ord, item_ord, body) of pages (jkey, issn_ord, page_ord, done, body) kept from pulls by
    ISSN. A pull ends at its first empty or unanswered page. Unanswered pages of a journal's first ISSN are an error,
    of a later one they only end it."""
    read = pages.withColumn("_items", F.when(F.col("done"), F.coalesce(F.from_json("body", "message struct<items: array<string>>")["message"]["items"], F.array().cast("array<string>"))))
    ends = read.where("not done or size(_items) = 0").groupBy("jkey", "issn_ord").agg(F.min(F.struct("page_ord", "done")).alias("_end"))
    joined = read.join(ends, ["jkey", "issn_ord"], "left")
    broken = (F.col("issn_ord") == 0) & ~F.coalesce(F.col("_end.done"), F.lit(True))
    checked = joined.withColumn("_items", F.when(broken, F.raise_error(F.concat(F.lit("no reply for the first ISSN of "), "jkey")).cast("array<string>")).otherwise(F.col("_items")))
    kept = checked.where(F.col("page_ord") < F.coalesce("_end.page_ord", F.lit(1 << 30)))
    return kept.select("jkey", "issn_ord", "page_ord", F.posexplode("_items").alias("item_ord", "body"))


def positional_counts(spark: SparkSession, requested: list[str], reply: str) -> DataFrame:
    """A positional batch reply, one slot a requested key: (doi_key, answered count or null)."""
    row = spark.createDataFrame([(requested, reply)], "keys array<string>, reply string")
    slots = F.from_json("reply", f"array<struct<{COUNTS}>>")
    zipped = F.arrays_zip(F.col("keys").alias("k"), slots.alias("v"))
    return row.select(F.explode(zipped).alias("z")).where("z.k is not null").select(F.col("z.k").alias("doi_key"), F.col("z.v.citationCount").alias("c"))


def manifest_papers(spark: SparkSession, manifest: DataFrame, data_dir: str, schema: str, everywhere: bool = False) -> DataFrame:
    """Rows of all papers-<key>.json that a manifest names, in one scan; entries that live elsewhere (with a base) are
    left out unless `everywhere`."""
    try:
        files = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", "papers-*.json").json(data_dir)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    here = manifest if everywhere else manifest.where("base is null or base = ''")
    key = F.regexp_extract(F.url_decode("_metadata.file_name"), r"^papers-(.+)\.json$", 1)
    return files.withColumn("_key", key).join(here.select(F.col("key").alias("_key")), "_key", "left_semi").drop("_key")
