"""Connected components by large-star and small-star alternation, with hubs dealt in bounded groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.sources.shared import written

HUB = 100_000  # edges of a vertex that go to one group
HUBS = 50_000  # vertices that may count as hubs: the list of them is broadcast
FOREST = 1_000_000  # edges that a task holds when it leaves out those within its own trees


def dealt(rows: DataFrame, marks: DataFrame, key: str, spread: Column, degrees: DataFrame, limit: int) -> DataFrame:
    """rows left-joined with marks (key, ...) on a vertex, where no group of more than about `limit` rows meets.

    degrees: (key, n). The rows of a vertex with more than `limit` edges are dealt over n / limit salts by `spread`, and its
    mark goes to each of them. As `limit` grows with the edges there are at most HUBS such vertices, so their list is
    broadcast within a known bound.
    """
    hubs = F.broadcast(degrees.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("_salts")))
    salted = rows.join(hubs, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(spread), "_salts").cast("int"), F.lit(0))).drop("_salts")
    each = marks.join(hubs, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(each, [key, "_salt"], "left").drop("_salt")


def joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least number of the component of each of n vertices under edges (a, b)."""
    least = np.arange(n)
    while len(a):
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := least[least], least):
            least = up
        a, b = least[a], least[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return least


def forest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) that join the same vertices, v the less: each task puts its edges together in groups of up to FOREST and
    sends on one edge a vertex, to the least one that it is joined with there. Groups in which edges run together are kept and
    take in more, so what a task sends follows the vertices it meets and not its edges."""
    most = FOREST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def settled() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ends = pa.concat_arrays([*table["u"].chunks, *table["v"].chunks]).dictionary_encode()
            order = pc.sort_indices(ends.dictionary)
            place = np.empty(len(order), np.int64)
            place[order.to_numpy()] = np.arange(len(order))
            at = place[ends.indices.to_numpy()]
            least = joined(at[: table.num_rows], at[table.num_rows :], len(order))
            u = np.flatnonzero(least != np.arange(len(order)))
            names = ends.dictionary.take(order)
            return pa.RecordBatch.from_arrays([names.take(pa.array(u)), names.take(pa.array(least[u]))], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= most:
                held = [settled()]
                size = held[0].num_rows
                if size > most // 2:
                    yield held[0]
                    held, size = [], 0
        if size:
            yield settled()

    return edges.select("u", "v").mapInArrow(run, edges.select("u", "v").schema)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", hub: int = HUB) -> DataFrame:
    """(node, component): the least node of each connected component, for every node with an edge.

    Edges stand once, as (u, v) with v the less. Large-star: each vertex hands its greater neighbours to its least one.
    Small-star: each vertex hands its smaller neighbours to the least of them. Both keep the components and turn each
    into a star about its least node. A component that is a star has settled: its edges are put by as results and
    take no part in later rounds. Edges meet vertices by dealt(), so the edges of a hub never gather; minima and degrees are
    added up before their shuffle. What goes from round to round is written, so lineage stays short. Before all rounds each
    task leaves out the edges within trees that it has (see forest()), so the rounds move about an edge a vertex and task.

    Rows with a null end have no edge; repeated edges count once; an edge from a node to itself makes it a node.
    """
    given = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    left = written(forest(given.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))).distinct())
    loops = given.where("x = y").select(F.col("x").alias("node"), F.col("y").alias("component"))
    done = [loops]
    while True:
        count = left.count()
        if not count:
            break
        limit = max(hub, 2 * count // HUBS)
        ends = left.select("u", "v").unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nodes = written(ends.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        leaves = nodes.where("n = 1 and m < u").groupBy(F.col("m").alias("u")).agg(F.count("*").alias("k"))
        stars = nodes.where("m > u").join(leaves, "u").where("k = n")
        marks = nodes.where("m < u").select(F.col("u").alias("v"), "m", F.lit(False).alias("star"))
        marks = marks.unionByName(stars.select(F.col("u").alias("v"), F.lit(None).cast(nodes.schema["m"].dataType).alias("m"), F.lit(True).alias("star")))
        large = written(dealt(left, marks, "v", F.col("u"), nodes.select(F.col("u").alias("v"), "n"), limit).select("u", F.coalesce("m", "v").alias("v"), F.coalesce("star", F.lit(False)).alias("star")).distinct())
        settled = large.where("star").select("u", "v")
        done += [settled.select(F.col("u").alias("node"), F.col("v").alias("component")), settled.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()]
        large = large.where("not star").select("u", "v")
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        handed = dealt(large, least.where("n > 1").select("u", "m"), "u", F.col("v"), least.select("u", "n"), limit).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        left = written(handed.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.groupBy("node").agg(F.min("component").alias("component"))
