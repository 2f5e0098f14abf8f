"""Matching by title and authors, blocked so that no cross product is ever planned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import PREFIX_LENGTH, journal_norm, match_norm, pick_preprint, preprint_from_doi, surnames, titles_match
from quire.sources.shared import written

CELL = 1000  # rows of either side that meet in one group when equal titles are paired
PAIRS = 10_000_000  # pairs that a task makes, about
COPIES = 200_000  # rows that a task copies to the cells they meet in, about


def enough_shared(mine: Column, theirs: Column) -> Column:
    """Two shared surnames, or all of the shorter list; both must have one."""
    shared = F.size(F.array_intersect(mine, theirs))
    return (F.size(mine) > 0) & (F.size(theirs) > 0) & (shared >= F.least(F.lit(2), F.size(mine), F.size(theirs)))


def plausible_year(kind: Column, mine: Column, theirs: Column) -> Column:
    """At most 12 years before (6 for a prefix match) to one after; a missing year passes."""
    back = F.when(kind == "exact", 12).otherwise(6)
    return F.coalesce(F.nullif(mine, F.lit(0)).isNull() | F.nullif(theirs, F.lit(0)).isNull() | theirs.between(mine - back, mine + 1), F.lit(True))


def candidate_urls(hit: str, oa_url: bool = False) -> Column:
    """A hit's addresses in order: locations, best open location, then the primary one (or the open-access link)."""
    def both(x: Column) -> Column:
        return F.array(x["landing_page_url"], x["pdf_url"])

    listed = F.flatten(F.transform(F.coalesce(F.col(f"{hit}.locations"), F.array()), both))
    last = F.array(F.col(f"{hit}.open_access.oa_url")) if oa_url else both(F.col(f"{hit}.primary_location"))
    return F.filter(F.concat(listed, both(F.col(f"{hit}.best_oa_location")), last), lambda u: F.coalesce(u, F.lit("")) != "")


def match_hits(papers: DataFrame, hits: DataFrame, key: str = "doi_key") -> DataFrame:
    """(key, u, s, kind): for each paper (key, title, year, authors) the first of its search hits (key, ord, hit) that
    matches and has a usable address."""
    joined = papers.select(key, "title", "year", "authors").join(hits, key)
    kind = titles_match(match_norm(F.col("title")), match_norm(F.col("hit.title")))
    theirs = surnames(F.transform("hit.authorships", lambda a: a["author"]["display_name"]))
    link = F.coalesce(pick_preprint(candidate_urls("hit")), preprint_from_doi(F.col("hit.doi")))
    ready = joined.withColumns({"kind": kind, "_t": theirs, "_m": surnames(F.col("authors")), "_l": link})
    year = F.col("year").try_cast("int")
    ok = (F.col("kind") != "") & enough_shared(F.col("_m"), F.col("_t")) & plausible_year(F.col("kind"), year, F.col("hit.publication_year")) & F.col("_l").isNotNull()
    return ready.where(ok).groupBy(key).agg(F.min_by(F.struct("_l.u", "_l.s", "kind"), "ord").alias("r")).select(key, "r.*")


def match_works(papers: DataFrame, hits: DataFrame, key: str = "doi_key") -> DataFrame:
    """As match_hits() for hits of a registry search: struct(DOI, title array, author array, issued), link by DOI only."""
    joined = papers.select(key, "title", "year", "authors").join(hits, key)
    kind = titles_match(match_norm(F.col("title")), match_norm(F.try_element_at("hit.title", F.lit(1))))
    link = preprint_from_doi(F.col("hit.DOI"))
    ready = joined.withColumns({"kind": kind, "_t": surnames(F.transform("hit.author", lambda a: a["family"])), "_m": surnames(F.col("authors")), "_l": link})
    theirs = F.try_element_at(F.try_element_at("hit.issued.date-parts", F.lit(1)), F.lit(1))
    ok = (F.col("kind") != "") & enough_shared(F.col("_m"), F.col("_t")) & plausible_year(F.col("kind"), F.col("year").try_cast("int"), theirs) & F.col("_l").isNotNull()
    return ready.where(ok).groupBy(key).agg(F.min_by(F.struct("_l.u", "_l.s", "kind"), "ord").alias("r")).select(key, "r.*")


def begins(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """(t, p): for each different title of `longer` (t, block) those of `shorter` that it goes on from, as a prefix match.

    Only beginnings of a length that a title of the same block has on the other side are formed, and those meet whole titles by
    an equal-join. So a block that very many titles share is not compared pair by pair, and a title has fewer rows than characters.
    """
    held = shorter.select("t", "block").distinct().where(F.char_length("t") >= PREFIX_LENGTH)
    lengths = held.groupBy("block").agg(F.collect_set(F.char_length("t")).alias("_n"))
    each = longer.select("t", "block").distinct().join(lengths, "block")
    each = each.select("t", F.explode(F.filter("_n", lambda n: n < F.char_length("t"))).alias("_k"))
    met = each.select("t", F.substring("t", F.lit(1), F.col("_k")).alias("p")).join(held.select(F.col("t").alias("p")), "p")
    return met.where(titles_match(F.col("t"), F.col("p")) == "prefix").select("t", "p")


def match_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (l_id, r_id, kind) of two corpora (id, title) whose titles match.

    Different titles are matched first, each once: equal ones, and those that begin with another (see begins()). A title then has
    up to three meetings: of the rows that have it on either side, and of those that have it on one side with all that go on
    from it on the other. The rows of a meeting meet in cells of about CELL rows of either side, so one of very many rows is
    dealt over many groups, and the tasks grow in number with the pairs. Rows come to their meetings by title and salt, so
    that neither the rows of a title nor the titles that go on from one gather in a task.
    """
    def held(df: DataFrame) -> DataFrame:
        t = match_norm(F.col("title"))
        return written(df.select("id", t.alias("t"), F.substring(t, 1, PREFIX_LENGTH).alias("block")).where("block <> ''"))

    rows = {"l": held(left), "r": held(right)}
    each = {p: written(df.groupBy("t", "block").agg(F.count("*").alias("n"))) for p, df in rows.items()}
    same = each["l"].select("t").join(each["r"].select("t"), "t").select(F.lit("same").alias("way"), F.col("t").alias("l_t"), F.col("t").alias("r_t"))
    on = begins(each["l"], each["r"]).select(F.lit("on").alias("way"), F.col("t").alias("l_t"), F.col("p").alias("r_t"))
    back = begins(each["r"], each["l"]).select(F.lit("back").alias("way"), F.col("p").alias("l_t"), F.col("t").alias("r_t"))
    pairs = written(same.unionByName(on).unionByName(back)).withColumn("key", F.when(F.col("way") == "on", F.col("r_t")).otherwise(F.col("l_t")))

    def coming(p: str) -> DataFrame:
        """The titles of a side in each meeting, with their number of rows."""
        return pairs.select("way", "key", F.col(f"{p}_t").alias("t")).distinct().join(each[p].select("t", "n"), "t")

    sums = [coming(p).groupBy("way", "key").agg(F.sum("n").alias(f"{p}_n")) for p in ("l", "r")]
    meetings = written(sums[0].join(sums[1], ["way", "key"]).withColumn("meeting", F.monotonically_increasing_id()))

    def salts(n: str) -> Column:
        return F.ceil(F.col(n) / CELL)

    counted = (F.col("l_n") * F.col("r_n"), F.col("l_n") * salts("r_n"), F.col("r_n") * salts("l_n"))
    total, *copies = (int(n or 0) for n in meetings.agg(*map(F.sum, counted)).first())
    parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PAIRS))
    tasks = {p: -(-n // COPIES) for p, n in zip(("l", "r"), copies, strict=True)}
    cores = left.sparkSession.sparkContext.defaultParallelism

    def celled(p: str, other: str) -> DataFrame:
        """The rows of a side, each in its own row of cells of every meeting its title is in."""
        kind = F.when(F.col("way") == "same", "exact").otherwise("prefix").alias("kind")
        own = coming(p).join(meetings, ["way", "key"]).select("t", F.explode(F.sequence(F.lit(0).cast("long"), salts("n") - 1)).alias("salt"), "meeting", *[salts(f"{x}_n").alias(f"_{x}") for x in ("l", "r")], *([kind] if p == "l" else []))
        place = F.xxhash64(f"{p}_id")
        salted = rows[p].select(F.col("id").alias(f"{p}_id"), "t").join(each[p].select("t", "n"), "t").select(f"{p}_id", "t", F.pmod(place, salts("n")).alias("salt"))
        dealt = [df.repartition(tasks[p], "t", "salt") if tasks[p] > cores else df for df in (salted, own)]
        met = dealt[0].join(dealt[1], ["t", "salt"]).drop("t", "salt").withColumn(f"{p}_cell", F.pmod(place, f"_{p}"))
        met = met.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}") - 1)).alias(f"{other}_cell")).drop("_l", "_r")
        return met.repartition(parts, "meeting", "l_cell", "r_cell")

    return celled("l", "r").join(celled("r", "l"), ["meeting", "l_cell", "r_cell"]).select("l_id", "r_id", "kind")


def _by_rarity(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with their names (n) in one order, the rarest first."""
    each = [df.select("id", F.explode("n").alias("name")) for df in (left, right)]
    often = each[0].unionByName(each[1]).groupBy("name").agg(F.count("*").alias("often"))
    out = []
    for df, names in zip((left, right), each, strict=True):
        placed = names.join(often, "name").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("often", "name"))).alias("_o"))
        out.append(df.drop("n").join(placed, "id").withColumn("n", F.transform("_o", lambda x: x["name"])).drop("_o"))
    return out[0], out[1]


def match_corpora(papers: DataFrame, works: DataFrame) -> DataFrame:
    """(id, work, kind) for papers (id, title, year, authors) against a whole corpus of works (id, ord, title, year, authors):
    of the works that match a paper by title, surnames and year, the one with the least `ord`, then the least id.

    Titles meet where they are equal or one is a beginning of the other, see begins(), and then by a surname, so that a title
    thousands of works have or begin with is not compared with all of them. Two lists of several names must share two, so
    all but the most frequent name of each are enough to meet by (of two shared ones, one is among them on either side);
    a list of one name meets the others by any name. Nothing that matches is lost; the rules decide on what meets.
    """
    def ready(df: DataFrame, *more: str) -> DataFrame:
        t = match_norm(F.col("title"))
        held = df.select("id", *more, t.alias("t"), F.substring(t, 1, PREFIX_LENGTH).alias("block"), F.col("year").try_cast("int").alias("y"), surnames(F.col("authors")).alias("n"))
        return held.where("block <> '' and size(n) > 0")

    def meeting(df: DataFrame, alone: tuple[str, ...], together: tuple[str, ...], p: str) -> DataFrame:
        """A row for each way (way, name) to meet. `together`: for lists of several names the ways by all but the last
        name, and by any."""
        rare = F.transform(F.slice("n", F.lit(1), F.size("n") - 1), lambda x: F.struct(F.lit(together[0]).alias("way"), x.alias("name")))
        every = F.transform("n", lambda x: F.struct(F.lit(together[1]).alias("way"), x.alias("name")))
        one = F.array(*[F.struct(F.lit(w).alias("way"), F.get("n", F.lit(0)).alias("name")) for w in alone])
        ways = F.explode(F.when(F.size("n") == 1, one).otherwise(F.concat(rare, every))).alias("w")
        own = [c for c in df.columns if c not in ("key", "whole")]
        return df.select("key", "whole", *[F.col(c).alias(f"{p}_{c}") for c in own], ways).select("key", "whole", "w.way", "w.name", *[f"{p}_{c}" for c in own])

    def keyed(df: DataFrame, other: DataFrame, own: tuple[bool, ...], begun: bool) -> DataFrame:
        """A row for each title (key) to meet by: its own, and the other side's that it begins with. whole: the left title is met whole."""
        found = begins(df, other).groupBy("t").agg(F.collect_list("p").alias("_p"))
        as_key = lambda t, whole: F.struct(t.alias("key"), F.lit(whole).alias("whole"))
        ends = F.transform(F.coalesce("_p", F.array().cast("array<string>")), lambda p: as_key(p, begun))
        keys = F.explode(F.concat(F.array(*[as_key(F.col("t"), w) for w in own]), ends)).alias("_k")
        return df.join(found, "t", "left").select(*[c for c in df.columns if c != "block"], keys).select("*", "_k.*").drop("_k")

    left, right = (written(df) for df in _by_rarity(ready(papers), ready(works, "ord")))
    left, right = keyed(left, right, (True,), False), keyed(right, left, (True, False), True)
    # several-several: both by the rare names; a single name of the right meets any of the left ("s"), one of the left any of the right ("t")
    met = meeting(left, ("t",), ("m", "s"), "l").join(meeting(right, ("s", "t"), ("m", "t"), "r"), ["key", "whole", "way", "name"])
    kind = titles_match(F.col("l_t"), F.col("r_t"))
    fits = met.withColumn("kind", kind).where((F.col("kind") != "") & enough_shared(F.col("l_n"), F.col("r_n")) & plausible_year(F.col("kind"), F.col("l_y"), F.col("r_y")))
    first = fits.groupBy(F.col("l_id").alias("id")).agg(F.min(F.struct("r_ord", "r_id", "kind")).alias("m"))
    return first.select("id", F.col("m.r_id").alias("work"), F.col("m.kind").alias("kind"))


def title_agrees(given: Column, registered: Column) -> Column:
    """Journal titles are equal, or one holds the other (an empty registered title agrees)."""
    a, b = journal_norm(given), journal_norm(registered)
    return F.contains(a, b) | F.contains(b, a)
