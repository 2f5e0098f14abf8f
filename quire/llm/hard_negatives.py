"""Hard negatives of anchor vectors by dual-tree search over whole-number inner products.

Trees stand over anchors and over candidates. Their upper levels are shared: a tree of medians, fitted on at most SAMPLE rows,
routes every row to a cell, and blocks are cut from the rows in order of label and cell, so that a block is compact
whatever the size of a cell or label (equal vectors simply fill more blocks). The lower levels are built in the
tasks, over one block of anchors and one slice of candidate blocks. A node knows the least and greatest value of each
component, so a pair of nodes bounds all inner products between them from both sides. A pair is dropped, for
all anchors below it at once, if no product in it can be among any anchor's best (positives) or lie in any
anchor's window (negatives); pairs of leaves are scored exactly. Pairs of blocks are tested the same way in Spark before
anything is sent: for positives against the scores that each anchor already has within its own block, for negatives against
the windows that follow from the positives. Each task sends on the best of its slice, which the rank limit cuts
down before the last shuffle. Anchors against candidates is the work as stated: where vectors have no structure, nothing
can be dropped and every anchor is scored against every candidate, block by block.

Rows with a null label or vector, or a null or non-finite component, take no part. A row without an id is no anchor; as a
candidate it comes after the others of its score. Rows that share an id, repeated ones too, are rows of their own: each
is an anchor, and the others of them are candidates to it. Shorter vectors are filled up with zeros. Ties go to the smaller
id. An anchor without positives, or a positive without negatives, gives no rows. Products beyond 2**53 are computed with
unbounded whole numbers (and given as the nearest 64-bit number). An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import partitions, written

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
SAMPLE = 4096  # rows that the shared tree is fitted on
DEPTH = 9  # of the shared tree
BLOCK, SLICE = 1024, 32  # candidates in a block, blocks in a slice
ANCHORS = (256, 16_384)  # anchors in a block: an eighth of all of them, within these
LEAF = (64, 256)  # anchors and candidates in a leaf
LAST = (1 << 63) - 1  # stands for a missing id
EXACT = float(1 << 53)


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, q (256 times each component, rounded down) of the rows that take part; every seventh id has another label."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    got = rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & whole)
    label = F.col(label_col).cast("long")
    key = F.col(id_col).cast("long")
    return got.select(key.alias("id"), F.when(key % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.transform(x, lambda v: F.floor(256 * v)).alias("q"))


def matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of whole numbers, short ones filled up with zeros; at least one column."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


class Tree:
    """Medians along the widest component down to leaves of `size` rows; each node's box and labels. Rows are reordered."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, size: int):
        order, spans, kids, todo = np.arange(len(x)), [], [], [(0, len(x), -1, 0)]
        lo, hi = [], []
        while todo:
            a, b, above, side = todo.pop()
            if above >= 0:
                kids[above][side] = len(spans)
            own = x[order[a:b]]
            lo.append(own.min(0))
            hi.append(own.max(0))
            spans.append((a, b))
            kids.append([-1, -1])
            if b - a > size:
                middle = (b - a) // 2
                wide = int(np.argmax(hi[-1].astype(float) - lo[-1]))
                order[a:b] = order[a:b][np.argpartition(own[:, wide], middle)]
                here = len(spans) - 1
                todo += [(a, a + middle, here, 0), (a + middle, b, here, 1)]
        self.order, self.span, self.kids = order, np.array(spans), np.array(kids)
        self.lo, self.hi = np.array(lo, float), np.array(hi, float)
        own = labels[order]
        self.label_lo = np.array([own[a:b].min() for a, b in spans])
        self.label_hi = np.array([own[a:b].max() for a, b in spans])

    def bounds(self, i: np.ndarray, other: Tree, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that rows of each pair of nodes may have, with room for rounding."""
        corners = [x[i] * y[j] for x in (self.lo, self.hi) for y in (other.lo, other.hi)]
        room = 1e-9 * np.maximum.reduce([np.abs(c) for c in corners]).sum(1) + 1
        return np.minimum.reduce(corners).sum(1) - room, np.maximum.reduce(corners).sum(1) + room

    def leaf_pairs(self, other: Tree, wanted) -> Iterator[tuple[int, int, float, float]]:
        """Pairs of leaves that `wanted` lets through at every level, those of the greatest products first."""
        i = j = np.zeros(1, np.int64)
        found = []
        while len(i):
            low, high = self.bounds(i, other, j)
            keep = wanted(i, j, low, high)
            i, j, low, high = i[keep], j[keep], low[keep], high[keep]
            leaf, leaf2 = self.kids[i, 0] < 0, other.kids[j, 0] < 0
            ends = leaf & leaf2
            found.append(np.stack([i[ends], j[ends], low[ends], high[ends]]))
            size, size2 = np.diff(self.span[i]).ravel(), np.diff(other.span[j]).ravel()
            first = ~ends & ~leaf & (leaf2 | (size * LEAF[1] >= size2 * LEAF[0]))
            second = ~ends & ~first
            i, j = (
                np.concatenate([self.kids[i[first]].ravel(), np.repeat(i[second], 2)]),
                np.concatenate([np.repeat(j[first], 2), other.kids[j[second]].ravel()]),
            )
        all_found = np.concatenate(found, axis=1) if found else np.zeros((4, 0))
        for k in np.argsort(-all_found[3], kind="stable").tolist():
            yield int(all_found[0, k]), int(all_found[1, k]), float(all_found[2, k]), float(all_found[3, k])


class Best:
    """The k best (score, id) of each of n searches; equal ones by uid."""

    def __init__(self, n: int, k: int, kind: type):
        self.score = np.full((n, k), -np.inf, kind)
        self.ids, self.uids = np.full((n, k), LAST), np.full((n, k), LAST)

    def offer(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        hit = (score >= self.score[rows, -1:]) & (score > -np.inf)
        some = np.flatnonzero(hit.any(1))
        if not len(some):
            return
        cols = np.flatnonzero(hit[some].any(0))
        fresh = np.where(hit[np.ix_(some, cols)], score[np.ix_(some, cols)], -np.inf)
        at, k = rows[some], self.score.shape[1]
        every = [np.concatenate([old[at], new], axis=1) for old, new in ((self.score, fresh), (self.ids, np.broadcast_to(ids[cols], fresh.shape)), (self.uids, np.broadcast_to(uids[cols], fresh.shape)))]
        for key in (2, 1, 0):  # stable, the last key first
            order = np.argsort(-every[0] if key == 0 else every[key], axis=1, kind="stable")
            every = [np.take_along_axis(x, order, axis=1) for x in every]
        self.score[at], self.ids[at], self.uids[at] = (x[:, :k] for x in every)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: doubles where those are exact, else unbounded numbers."""
    return a @ b.T


def arithmetic(a: np.ndarray, b: np.ndarray) -> type:
    """The kind of number in which all products between two tables are exact, with room for a factor of 100."""
    most = [float(np.abs(x.astype(float)).max(initial=0)) for x in (a, b)]
    return np.float64 if 100 * most[0] * most[1] * a.shape[1] < EXACT else object


def as_longs(score: np.ndarray) -> np.ndarray:
    return np.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in score.tolist()], np.int64) if score.dtype == object else score.astype(np.int64)


def node_least(tree: Tree, x: np.ndarray, of=np.min) -> np.ndarray:
    """Of a value for each row (in the tree's order), the least below each node."""
    return np.array([of(x[a:b]) if b > a else np.inf for a, b in tree.span], float)


def positives_of(x: np.ndarray, labels: np.ndarray, uids: np.ndarray, least: np.ndarray, y: np.ndarray, y_labels: np.ndarray, y_ids: np.ndarray, y_uids: np.ndarray) -> Best:
    """The best others of each anchor's label. least: a score that each anchor's last positive has at least."""
    kind = arithmetic(x, y)
    ta, tc = Tree(x, labels, LEAF[0]), Tree(y, y_labels, LEAF[1])
    a, c = x[ta.order].astype(kind), y[tc.order].astype(kind)
    labels, uids, least, y_labels, y_ids, y_uids = labels[ta.order], uids[ta.order], least[ta.order], y_labels[tc.order], y_ids[tc.order], y_uids[tc.order]
    best, floor = Best(len(a), POSITIVES, kind), node_least(ta, least)

    def wanted(i, j, low, high):
        return (high >= floor[i]) & (ta.label_lo[i] <= tc.label_hi[j]) & (tc.label_lo[j] <= ta.label_hi[i])

    for i, j, _, high in ta.leaf_pairs(tc, wanted):
        (p, q), (r, s) = ta.span[i], tc.span[j]
        if high < float(np.maximum(best.score[p:q, -1].astype(float), least[p:q]).min()):
            continue
        fits = (labels[p:q, None] == y_labels[None, r:s]) & (uids[p:q, None] != y_uids[None, r:s])
        best.offer(np.arange(p, q), np.where(fits, products(a[p:q], c[r:s]), -np.inf), y_ids[r:s], y_uids[r:s])
    back = np.argsort(ta.order)
    best.score, best.ids, best.uids = best.score[back], best.ids[back], best.uids[back]
    return best


def negatives_of(x: np.ndarray, labels: np.ndarray, anchor: np.ndarray, low_end: np.ndarray, high_end: np.ndarray, y: np.ndarray, y_labels: np.ndarray, y_ids: np.ndarray, y_uids: np.ndarray) -> Best:
    """The best rows of other labels within each search's window. anchor: the row of x that a search belongs to (ascending)."""
    kind = arithmetic(x, y)
    ta, tc = Tree(x, labels, LEAF[0]), Tree(y, y_labels, LEAF[1])
    place = np.argsort(ta.order)[anchor]
    turn = np.argsort(place, kind="stable")  # the searches in the order of the anchors' tree
    place, low_end, high_end = place[turn], low_end[turn], high_end[turn]
    a, c = x[ta.order].astype(kind), y[tc.order].astype(kind)
    labels, y_labels, y_ids, y_uids = labels[ta.order], y_labels[tc.order], y_ids[tc.order], y_uids[tc.order]
    first = np.searchsorted(place, np.arange(len(a) + 1))  # of each anchor's searches
    best = Best(len(place), NEGATIVES, kind)
    span = first[ta.span]
    need = np.array([low_end[p:q].astype(float).min() if q > p else np.inf for p, q in span])
    most = np.array([high_end[p:q].astype(float).max() if q > p else -np.inf for p, q in span])

    def wanted(i, j, low, high):
        one = (ta.label_lo[i] == ta.label_hi[i]) & (ta.label_lo[i] == tc.label_lo[j]) & (tc.label_lo[j] == tc.label_hi[j])
        return (high >= need[i]) & (low <= most[i]) & ~one

    for i, j, _, high in ta.leaf_pairs(tc, wanted):
        (p, q), (r, s), (f, g) = ta.span[i], tc.span[j], span[i]
        if high < float(np.maximum(best.score[f:g, -1].astype(float), low_end[f:g].astype(float)).min()):
            continue
        score = np.where(labels[p:q, None] != y_labels[None, r:s], products(a[p:q], c[r:s]), -np.inf)[place[f:g] - p]
        inside = (score >= low_end[f:g, None]) & (score <= high_end[f:g, None])
        best.offer(np.arange(f, g), np.where(inside, score, -np.inf), y_ids[r:s], y_uids[r:s])
    back = np.argsort(turn)
    best.score, best.ids, best.uids = best.score[back], best.ids[back], best.uids[back]
    return best


def shared_tree(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Component and median of each inner node (heap order) of the upper levels, from at most SAMPLE rows."""
    mark = F.xxhash64("q", "uid")
    some = rows.where(F.pmod(mark, F.lit(max(1, rows.count() // (8 * SAMPLE)))) == 0)  # so that few rows are ranked
    few = some.select("q").orderBy(mark).limit(SAMPLE).toArrow()
    x = matrix(few["q"])
    wide, at = np.zeros((1 << DEPTH) - 1, np.int64), np.zeros((1 << DEPTH) - 1, np.int64)
    groups = [x]
    for level in range(DEPTH):
        below = []
        for k, g in enumerate(groups):
            node = (1 << level) - 1 + k
            if len(g):
                wide[node] = np.argmax(g.max(0).astype(float) - g.min(0))
                at[node] = np.sort(g[:, wide[node]])[len(g) // 2]
            left = g[:, wide[node]] < at[node]
            below += [g[left], g[~left]]
        groups = below
    return wide, at


def routed(rows: DataFrame, tree: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Adds the cell, by walking the shared tree."""
    wide, at = tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(batch.schema.get_field_index("q")))
            x = widened(x, max(x.shape[1], int(wide.max(initial=0)) + 1))
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), wide[node]] >= at[node])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node.astype(np.int32))], names=[*batch.schema.names, "cell"])

    return rows.mapInArrow(run, "id long, label long, q array<long>, uid long, cell int")


def in_blocks(ordered: DataFrame, size: int) -> DataFrame:
    """Adds `block`, of `size` rows each (the last may have fewer) in the order of `at`: a partition's number and a place in
    it. Partitions are counted first, a row for each, and each then starts where those before it end."""
    part = F.shiftright("at", 33)
    rows = ordered.withColumn("_part", part)
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("at")) - 1 + F.col("_off")
    return rows.join(F.broadcast(offsets), "_part").withColumn("block", F.floor(place / size).cast("long")).drop("_part", "_off", "at", "cell")


BOX = "block long, lo array<double>, hi array<double>, label_lo long, label_hi long, least double, most double"
PACKED = f"{BOX}, kind string, width int, ids binary, uids binary, labels binary, data binary, seeds array<struct<uid: long, least: double>>"


def columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """q, label, id, uid."""
    ids = pc.fill_null(table["id"], LAST).to_numpy()
    return matrix(table["q"]), table["label"].to_numpy(), ids, table["uid"].to_numpy()


def packed(rows: DataFrame, every: int) -> DataFrame:
    """A row for each block: its box, its vectors in the narrowest whole numbers, and for its anchors the score that
    the last of POSITIVES has within the block."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        x, label, ids, uids = columns(table)
        most = int(max(x.max(), -int(x.min()) - 1))
        kind = next(k for k in ("int8", "int16", "int32", "int64") if most <= np.iinfo(k).max)
        seeds = []
        own = np.flatnonzero((ids % every == 0) & (ids != LAST))
        if len(own):
            best = positives_of(x[own], label[own], uids[own], np.full(len(own), -np.inf), x, label, ids, uids)
            seeds = [{"uid": u, "least": float(s)} for u, s in zip(uids[own].tolist(), best.score[:, -1].tolist(), strict=True) if s > -np.inf]
        row = {"block": key[0].as_py(), "lo": x.min(0).astype(float).tolist(), "hi": x.max(0).astype(float).tolist(), "label_lo": int(label.min()), "label_hi": int(label.max()), "least": None, "most": None}
        row |= {"kind": kind, "width": x.shape[1], "ids": ids.tobytes(), "uids": uids.tobytes(), "labels": label.tobytes(), "data": x.astype(kind).tobytes(), "seeds": seeds}
        return pa.Table.from_pylist([row], schema)

    floats = pa.list_(pa.float64())
    schema = pa.schema([("block", pa.int64()), ("lo", floats), ("hi", floats), ("label_lo", pa.int64()), ("label_hi", pa.int64()), ("least", pa.float64()), ("most", pa.float64()), ("kind", pa.string()), ("width", pa.int32()), ("ids", pa.binary()), ("uids", pa.binary()), ("labels", pa.binary()), ("data", pa.binary()), ("seeds", pa.list_(pa.struct([("uid", pa.int64()), ("least", pa.float64())])))])
    return rows.groupBy("block").applyInArrow(pack, PACKED)


def boxes(rows: DataFrame) -> DataFrame:
    """The box of each block of anchors, the least score that any of them looks for, and the greatest."""

    def box(key: tuple, table: pa.Table) -> pa.Table:
        x, label = matrix(table["q"]), table["label"].to_numpy()
        low, high = pc.min(table["least"]).as_py(), pc.max(table["most"]).as_py()
        row = [key[0].as_py(), x.min(0).astype(float).tolist(), x.max(0).astype(float).tolist(), int(label.min()), int(label.max()), low, high]
        return pa.table([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

    names = [c.split(" ")[0] for c in BOX.split(", ")]
    types = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    return rows.groupBy("block").applyInArrow(box, BOX)


def opened(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, labels, ids and uids of packed blocks."""
    parts = table.select(["kind", "width", "labels", "ids", "uids", "data"]).to_pylist()
    width = max(p["width"] for p in parts)
    x = np.concatenate([widened(np.frombuffer(p["data"], p["kind"]).reshape(-1, p["width"]).astype(np.int64), width) for p in parts])
    return x, *(np.concatenate([np.frombuffer(p[c], np.int64) for p in parts]) for c in ("labels", "ids", "uids"))


def met(anchors: DataFrame, blocks: DataFrame, fits: str, search, out: str) -> DataFrame:
    """search(anchors, candidates) for each block of anchors and each slice of the candidate blocks that may hold what it looks for.

    anchors: rows with block, least, most; blocks: packed(). Pairs of blocks whose bounds on the inner product don't reach
    from `least` to `most`, or whose labels don't meet `fits`, are dropped before vectors are sent.
    """
    last = blocks.agg(F.max("block")).first()[0]
    slices = F.explode(F.sequence(F.lit(0), F.lit((last or 0) // SLICE))).alias("slice")
    theirs = boxes(anchors).select(F.col("block").alias("a"), F.col("lo").alias("al"), F.col("hi").alias("ah"), F.col("label_lo").alias("a_lo"), F.col("label_hi").alias("a_hi"), "least", "most", slices)
    mine = blocks.select(F.floor(F.col("block") / SLICE).cast("int").alias("slice"), F.col("block").alias("c"), "lo", "hi", "label_lo", "label_hi")
    zero = F.coalesce  # components that one side lacks are 0
    corners = F.arrays_zip("al", "ah", "lo", "hi")
    each = F.transform(corners, lambda z: F.array(*[zero(z[x], F.lit(0.0)) * zero(z[y], F.lit(0.0)) for x in ("al", "ah") for y in ("lo", "hi")]))
    total = lambda pick: F.aggregate("each", F.lit(0.0), lambda s, z: s + pick(z))
    room = F.aggregate("each", F.lit(1.0), lambda s, z: s + 1e-9 * F.greatest(F.abs(F.array_min(z)), F.abs(F.array_max(z))))
    pairs = theirs.join(mine, "slice").where(fits).withColumn("each", each)
    pairs = pairs.where((F.coalesce("least", F.lit(float("-inf"))) <= total(F.array_max) + room) & (F.coalesce("most", F.lit(float("inf"))) >= total(F.array_min) - room))
    pairs = written(pairs.select("a", "slice", "c"))
    left = anchors.join(pairs.select(F.col("a").alias("block"), F.col("slice").alias("part")).distinct(), "block")
    right = blocks.drop("seeds", "lo", "hi").withColumnRenamed("block", "c").join(pairs, "c").withColumnRenamed("a", "block").drop("least", "most")
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "slice")).applyInArrow(search, out)


def first_positives(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """uid, anchor_id, k, positive_id, positive_score: the first POSITIVES of each anchor."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        x, label, ids, uids = columns(left)
        y, *theirs = opened(right)
        width = max(x.shape[1], y.shape[1])
        least = pc.fill_null(left["least"], float("-inf")).to_numpy()
        y_label, y_ids, y_uids = theirs
        best = positives_of(widened(x, width), label, uids, least, widened(y, width), y_label, y_ids, y_uids)
        row, col = np.nonzero(best.score > -np.inf)
        return pa.table([uids[row], ids[row], best.ids[row, col], best.uids[row, col], as_longs(best.score[row, col])], names=["uid", "anchor_id", "positive_id", "positive_uid", "positive_score"])

    found = met(anchors, blocks, "a_lo <= label_hi and label_lo <= a_hi", search, "uid long, anchor_id long, positive_id long, positive_uid long, positive_score long")
    own = Window.partitionBy("uid").orderBy(F.col("positive_score").desc(), "positive_id", "positive_uid")
    return found.withColumn("k", F.row_number().over(own)).where(F.col("k") <= POSITIVES).drop("positive_uid")


def mined(rows: DataFrame, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors: ids divisible by `every`."""
    parts = partitions(rows.sparkSession)
    base = written(vectors(rows, id_col, vector_col, label_col).withColumn("uid", F.monotonically_increasing_id()))
    order = ["label", "cell", "id", "uid"]
    ordered = written(routed(base, shared_tree(base)).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    blocks = written(packed(in_blocks(ordered, BLOCK), every))
    queries = ordered.where(F.col("id") % every == 0)
    size = min(max(queries.count() // 8, ANCHORS[0]), ANCHORS[1])
    seeds = blocks.select(F.explode("seeds").alias("s")).select("s.*")
    anchors = written(in_blocks(queries, size).join(seeds, "uid", "left").withColumn("most", F.lit(None).cast("double")))

    positives = written(first_positives(anchors, blocks))
    windows = positives.groupBy("uid").agg(F.collect_list(F.struct("k", "positive_id", "positive_score")).alias("found"), F.max("positive_score").alias("top"), F.min("positive_score").alias("end"))
    # a window of a negative score is empty
    looking = anchors.drop("least", "most").join(windows.where("top >= 0"), "uid")
    looking = written(looking.withColumn("least", F.greatest("end", F.lit(0)) * (LOW / 100)).withColumn("most", F.col("top") * (HIGH / 100)).drop("end", "top"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        x, label, ids, uids = columns(left)
        y, y_label, y_ids, y_uids = opened(right)
        width = max(x.shape[1], y.shape[1])
        found = left["found"].combine_chunks()
        anchor = np.repeat(np.arange(len(x)), found.value_lengths().to_numpy(zero_copy_only=False))
        k, positive_id, score = (found.flatten().field(f) for f in range(3))
        scores = score.to_pylist()
        keep = np.flatnonzero(np.array(scores) >= 0)
        anchor = anchor[keep]
        kind = arithmetic(x, y)
        low = np.array([-(-LOW * scores[i] // 100) for i in keep], kind)
        high = np.array([HIGH * scores[i] // 100 for i in keep], kind)
        best = negatives_of(widened(x, width), label, anchor, low, high, widened(y, width), y_label, y_ids, y_uids)
        row, col = np.nonzero(best.score > -np.inf)
        of = pa.array(keep[row])
        return pa.table([pa.array(uids[anchor[row]]), pa.array(ids[anchor[row]]), k.take(of), positive_id.take(of), score.take(of), pa.array(best.ids[row, col]), pa.array(best.uids[row, col]), pa.array(as_longs(best.score[row, col]))], names=names)

    out = "uid long, anchor_id long, k int, positive_id long, positive_score long, negative_id long, negative_uid long, negative_score long"
    names = [c.split(" ")[0] for c in out.split(", ")]
    hard = met(looking, blocks, "not (a_lo = a_hi and label_lo = label_hi and a_lo = label_lo)", search, out)
    own = Window.partitionBy("uid", "k").orderBy(F.col("negative_score").desc(), "negative_id", "negative_uid")
    best = hard.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= NEGATIVES)
    known = lambda c: F.nullif(c, F.lit(LAST)).alias(c)
    return best.select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle() -> str:
    return f"""
WITH v AS (SELECT row_number() OVER () AS u, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT a.u, a.id AS anchor_id, a.label = b.label AS same, b.id, b.u AS bu, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.u <> b.u WHERE a.id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, id, bu) AS k FROM s WHERE same QUALIFY k <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.u, p.k ORDER BY s.score DESC, s.id, s.bu)::INT AS rank
    FROM p JOIN s ON s.u = p.u AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
