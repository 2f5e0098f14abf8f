"""Large JSON documents read by byte ranges: several tasks on one file, cut at the edges of members or items.

Spark's text source splits a file at any separator of records. With `},"` for an object of flat records, and `},{` for an array
of records, most of its pieces are whole records; which ones are is decided exactly, and what isn't regular is read as a
whole document.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.sources.shared import written

LOW = (1 << 33) - 1  # of a row's number: its place in a partition


def pieces(spark: SparkSession, path: str, separator: str, pattern: str | None = None) -> DataFrame | None:
    """file, start (of the range), i (order within it), value; None if there is no such file."""
    source = spark.read.option("lineSep", separator)
    try:
        text = (source.option("pathGlobFilter", pattern) if pattern else source).text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("i"), "value")


def members(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame] | None:
    """The members (file, pos, k, v) of objects of flat records, and the files that are none: one row each (file).

    A piece is a member if it parses as one with the brackets that the cut took away put back: a cut within a string or a
    nested record leaves a piece before it that doesn't. The first piece opens the document, perhaps with a "map" member
    around the records. pos grows with the place in the file.
    """
    found = pieces(spark, path, '},"')
    if found is None:
        return None
    parsed = lambda text: F.from_json(text, f"map<string,struct<{schema}>>")
    closed = F.concat("value", F.lit("}}"))
    opening = F.regexp_replace(closed, r'^\s*\{\s*"map"\s*:\s*\{', "{")
    whole = F.coalesce(parsed(F.concat(F.lit('{"'), closed)), F.when(F.col("start") == 0, parsed(opening)))
    read = written(found.withColumn("m", whole))
    one = (F.size("m") == 1) & F.get(F.map_values("m"), F.lit(0)).isNotNull()
    odd = read.where(~F.coalesce(one, F.lit(False))).select("file").distinct()
    place = (F.col("start") + F.col("i").bitwiseAND(F.lit(LOW))).alias("pos")
    each = read.join(odd, "file", "left_anti").select("file", place, F.explode("m").alias("k", "v"))
    return each, odd


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def items(spark: SparkSession, path: str, schema: str, pattern: str | None = None) -> tuple[DataFrame, DataFrame] | None:
    """The items (file, pos, item) of replies {"message": {"items": [...]}} and bare arrays, and the files that are
    neither in a regular form (file).

    Whether a cut lies between two items follows from what stands before it in the file: the number of quotes (outside of a
    string or not) and of brackets (how deep). Both are counted in each piece by itself, for either state it may begin in,
    and added up over the pieces of a range and then over the ranges of a file. Pieces between two such cuts are put
    together again.
    """
    found = pieces(spark, path, "},{", pattern)
    if found is None:
        return None
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    depth = lambda text: (lambda t: _count(t, "{") - _count(t, "}"))(F.regexp_replace(text, r'"[^"]*("|$)', ""))
    counted = found.select("file", "start", "i", "value", _count(bare, '"').alias("quotes"), depth(bare).alias("d0"), depth(F.concat(F.lit('"'), bare)).alias("d1"))
    counted = written(counted)

    def so_far(rows: DataFrame, value: Column, name: str) -> DataFrame:
        """Adds the sum of a value over all pieces of the file before this one."""
        rows = rows.withColumn("_v", value)
        ranges = rows.groupBy("file", "start").agg(F.sum("_v").alias("_t"))
        before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        offsets = ranges.select("file", "start", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
        own = Window.partitionBy("file", "start").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("_w", F.coalesce(F.sum("_v").over(own), F.lit(0))).join(offsets, ["file", "start"]).withColumn(name, F.col("_w") + F.col("_o")).drop("_v", "_w", "_o")

    states = so_far(counted, F.col("quotes"), "q")
    states = states.withColumn("d", F.when(F.col("q") % 2 == 0, F.col("d0")).otherwise(F.col("d1")))
    states = so_far(states, F.col("d"), "deep")
    heads = counted.where("start = 0").groupBy("file").agg(F.min_by("value", "i").alias("head"))
    level = F.when(F.startswith(F.ltrim("head"), F.lit("[")), 1).otherwise(3)
    edge = ((F.col("q") + F.col("quotes")) % 2 == 0) & (F.col("deep") + F.col("d") == F.col("level"))
    marked = written(states.join(heads.select("file", level.alias("level")), "file").withColumn("edge", edge.cast("int")).select("file", "start", "i", "value", "level", "edge"))
    numbered = so_far(marked, F.col("edge"), "item")
    put = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "i", "value"))), lambda x: x["value"]), "},{")
    texts = numbered.groupBy("file", "level", F.col("item").alias("pos")).agg(put.alias("text"))
    last = numbered.groupBy("file").agg(F.max("item").alias("last"))
    opened = F.when(F.col("pos") > 0, F.concat(F.lit("{"), "text")).when(F.col("level") == 1, F.regexp_replace("text", r"^\s*\[\s*", "")).otherwise(F.regexp_extract("text", r'(?s)^.*?"items"\s*:\s*\[\s*(\{.*)$', 1))
    closed = F.when(F.col("pos") == F.col("last"), opened).otherwise(F.concat(opened, F.lit('},"end":1}')))
    told = F.from_json(F.concat(F.lit('{"item":'), closed), f"item struct<{schema}>, end int")
    ending = F.from_json(F.concat(F.lit('{"all":['), closed, F.lit("}")), f"all array<struct<{schema}>>")["all"]
    final = F.when(F.size(ending) == 1, F.get(ending, F.lit(0)))
    # an item in the middle must end where it was cut, and the array after the last one; what follows is not read
    before = F.concat(F.regexp_extract("text", r'(?s)^(.*?"items"\s*:\s*\[)', 1), F.lit("]}}"))
    starts = (F.col("pos") > 0) | (F.col("level") == 1) | (F.size(F.from_json(before, "message struct<items: array<string>>")["message"]["items"]) == 0)
    opens = F.startswith(opened, F.lit("{")) & F.coalesce(starts, F.lit(False))
    read = written(texts.join(last, "file").select("file", "pos", F.when(F.col("pos") == F.col("last"), final).otherwise(F.when(told["end"] == 1, told["item"])).alias("item"), opens.alias("opens")))
    odd = read.where("item is null or not opens").select("file").distinct()
    return read.join(odd, "file", "left_anti").select("file", "pos", "item"), odd
