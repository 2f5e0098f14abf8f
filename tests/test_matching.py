"""Titles that very many rows begin with or have: what meets, and how it is dealt."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import matching


def test_a_common_beginning_is_not_compared_pair_by_pair(spark, monkeypatch):
    """600 papers and works by the same two people whose titles begin alike: only those that match meet."""
    plain, compared = matching.titles_match, spark.sparkContext.accumulator(0)

    @F.udf
    def told(x, _):
        compared.add(1)
        return x

    monkeypatch.setattr(matching, "titles_match", lambda a, b: plain(told(a, b), b))
    people = F.array(F.lit("Ann Lee"), F.lit("Bo Chen"))
    title = F.concat(F.lit("The order of things number "), F.col("id").cast("string"), F.lit(" explained"))
    works = spark.range(600).select("id", F.col("id").alias("ord"), title.alias("title"), F.lit("2020").alias("year"), people.alias("authors"))
    longer = F.when(F.col("id") % 2 == 0, F.concat("title", F.lit(": at length"))).when(F.col("id") % 5 == 0, F.concat("title", F.lit(": a reply"))).otherwise(F.col("title"))
    got = matching.match_corpora(works.withColumn("title", longer).drop("ord"), works)
    rows = {r.id: (r.work, r.kind) for r in got.collect()}
    assert rows == {k: (k, "prefix" if k % 2 == 0 else "exact") for k in range(600) if k % 2 == 0 or k % 5}
    assert 0 < compared.value < 12_000


def test_titles_of_either_side_go_on_from_the_other(spark):
    base = "an order of things"
    left = spark.createDataFrame([(1, base), (2, base + " at length"), (3, "short"), (4, base + " a reply"), (5, "short title"), (6, None), (7, "")], "id long, title string")
    right = spark.createDataFrame([(1, base + " at length"), (2, base), (3, "short"), (4, "an order of thing"), (5, "!")], "id long, title string")
    got = sorted(map(tuple, matching.match_titles(left, right).collect()))
    assert got == [(1, 1, "prefix"), (1, 2, "exact"), (1, 4, "prefix"), (2, 1, "exact"), (2, 2, "prefix"), (2, 4, "prefix"), (3, 3, "exact")]


def test_a_title_of_many_rows_is_dealt(spark, monkeypatch):
    """One title 400 times on either side: its pairs come from many tasks."""
    monkeypatch.setattr(matching, "CELL", 20, raising=False)
    monkeypatch.setattr(matching, "PAIRS", 10_000, raising=False)
    rows = spark.range(400).select("id", F.lit("a title of many rows").alias("title"))
    got = matching.match_titles(rows, rows)
    parts = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 160_000 and max(parts) < 40_000
    assert got.distinct().count() == 160_000


def test_rows_that_come_to_meet_are_dealt(spark, monkeypatch):
    """400 rows of a title, and 400 titles of one row that go on from it: a row is copied for each cell, not for each title,
    and no task copies the rows of a title alone."""
    monkeypatch.setattr(matching, "CELL", 20)
    monkeypatch.setattr(matching, "COPIES", 1000, raising=False)
    short = spark.range(400).select("id", F.lit("a title of many rows").alias("title"))
    longer = spark.range(400).select("id", F.concat(F.lit("a title of many rows "), F.col("id").cast("string")).alias("title"))
    plain, met = type(short).repartition, []
    monkeypatch.setattr(type(short), "repartition", lambda self, *a: met.append(self) or plain(self, *a))
    assert matching.match_titles(short, longer).where("kind = 'prefix'").distinct().count() == 160_000
    assert matching.match_titles(longer, short).where("kind = 'prefix'").distinct().count() == 160_000
    for df in (df for df in met if "l_cell" in df.columns):
        parts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(parts) == 8_000 and max(parts) < 6_000
