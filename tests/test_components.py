"""Components against union-find: hubs, long paths, text nodes, awkward rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import components as C


def union_find(edges: list[tuple]) -> list[tuple]:
    up: dict = {}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        if a is None or b is None:
            continue
        for x in (a, b):
            up.setdefault(x, x)
        low, high = sorted((find(a), find(b)))
        up[high] = low
    return sorted((x, find(x)) for x in up)


def graphs() -> dict[str, list[tuple]]:
    rng = random.Random(1)
    walk = rng.sample(range(300), 40)
    return {
        "path": [(i + 1, i) for i in range(40)],
        "mixed path": list(zip(walk, walk[1:])),
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "hub above": [(1000, i) for i in range(200)] + [(i, i + 1) for i in range(2000, 2010)],
        "hubs meet": [(0, i) for i in range(1, 90)] + [(500, i) for i in range(60, 160)] + [(i, 500) for i in range(60, 160)],
        "awkward": [(None, 1), (2, None), (3, 3), (4, 5), (5, 4), (4, 5), (4, 4), (7, 6)],
        "none": [(None, None)],
    }


@pytest.mark.parametrize("name", graphs())
@pytest.mark.parametrize("hub", [C.HUB, 7])
def test_components(spark, name, hub):
    edges = graphs()[name]
    got = C.connected_components(spark.createDataFrame(edges, "a long, b long"), hub=hub).collect()
    assert sorted(map(tuple, got)) == union_find(edges)


def test_text_nodes_and_other_columns(spark):
    edges = [("n:b", "o:1"), ("n:a", "o:1"), ("n:c", "o:2"), ("é", "n:c")]
    frame = spark.createDataFrame([(*e, 0, 0, 0) for e in edges], "left string, right string, u long, v long, star long")
    assert sorted(map(tuple, C.connected_components(frame, "left", "right").collect())) == union_find(edges)


def test_a_hub_of_a_million_edges(spark, monkeypatch):
    """One vertex with a million edges beside small components: no group of rows that meet is much larger than the limit."""
    most = []
    plain = C.dealt

    def watched(rows, marks, key, spread, degrees, limit):
        hubs = degrees.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("s"))
        salted = rows.join(hubs, key, "left").groupBy(key, F.coalesce(F.pmod(F.xxhash64(spread), "s").cast("int"), F.lit(0)).alias("salt")).count()
        most.append((salted.agg(F.max("count")).first()[0] or 0, limit))
        out = plain(rows, marks, key, spread, degrees, limit)
        lines = [x.strip(" :+-") for x in out._jdf.queryExecution().executedPlan().toString().splitlines()]
        # what is dealt by a vertex alone has been added up before
        assert all("_salt" in x or below.startswith("HashAggregate") for x, below in zip(lines, lines[1:]) if "hashpartitioning" in x)
        return out

    monkeypatch.setattr(C, "dealt", watched)
    monkeypatch.setattr(C, "HUBS", 1000)
    star = spark.range(1, 1_000_001).select(F.lit(5_000_000).cast("long").alias("a"), F.col("id").alias("b"))
    pairs = spark.range(6_000_000, 6_001_000).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 10).alias("b"))
    out = C.connected_components(star.unionByName(pairs), hub=10_000)
    sizes = {r.component: r["count"] for r in out.groupBy("component").count().collect()}
    assert sizes[1] == 1_000_001 and len(sizes) == 101 and set(sizes.values()) == {1_000_001, 10}
    assert most and all(n <= 2 * limit for n, limit in most)


def test_settled_components_take_no_further_part(spark, monkeypatch):
    """A long path needs many rounds; the many small stars beside it are read in the first ones only."""
    rows = []
    plain = C.written
    monkeypatch.setattr(C, "written", lambda df: (lambda out: (rows.append(out.count()), out)[1])(plain(df)))
    stars = [(10_000 + 10 * k, 10_000 + 10 * k + j) for k in range(300) for j in range(1, 5)]
    path = [(i, i + 1) for i in range(32)]
    got = C.connected_components(spark.createDataFrame(stars + path, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == union_find(stars + path)
    assert rows[0] > 1200 and rows[4] < 200 and rows[-1] <= 64


def test_tasks_send_on_an_edge_a_vertex(spark, monkeypatch):
    """Edges within the trees of a task go no further: 20,000 edges among 200 vertices become 199 at most of each task."""
    rows = []
    plain = C.written
    monkeypatch.setattr(C, "written", lambda df: (lambda out: (rows.append(out.count()), out)[1])(plain(df)))
    edges = spark.range(20_000, numPartitions=4).select((F.col("id") % 199).alias("a"), (F.pmod(F.xxhash64("id"), F.lit(200))).alias("b"))
    assert {r.component for r in C.connected_components(edges).collect()} == {0}
    assert rows[0] <= 4 * 199


@pytest.mark.parametrize("limit", [3, 50])
def test_forests_of_any_size_keep_components(spark, monkeypatch, limit):
    monkeypatch.setattr(C, "FOREST", limit)
    rng = random.Random(limit)
    edges = [(f"n{rng.randrange(300)}", f"é{rng.randrange(300)}") for _ in range(400)]
    got = C.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert sorted(map(tuple, got)) == union_find(edges)
