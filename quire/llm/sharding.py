"""Best-fit-decreasing packing of indivisible groups into fixed-capacity shards.

Groups (equal texts) of one size are interchangeable, so the packer works on a histogram of group sizes. Sizes below
EXACT bytes have an entry each, larger ones FINE entries for each doubling, packed as the greatest size in the entry:
at most EXACT + 50 * FINE entries (60,000) go to the driver whatever the corpus, and no shard is off by more than one part
in FINE of what its larger groups hold. Entries go in by decreasing size, each group into the bin with the tightest remaining
capacity that still holds it; an AVL tree ordered by (remaining, bin) finds that bin in O(log bins). Rows are then
numbered and joined to the packed runs without any single-task step; the rows of one huge group of copies are small
(no text) and are split by the adaptive skew join, and rows that are equal in all columns go as one with their number.

Nulls count as empty texts; empty texts form one group; ties in size are numbered by the group's digest, so the
result does not depend on the order or partitioning of the input. Repeated rows share their text's shard. An
empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import documents, partitions, running_index, written

OVERHEAD = 16
EXACT, FINE = 1 << 13, 1 << 10


class Bins:
    """Open bins in an AVL tree ordered by (remaining capacity, bin number)."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, left, right, height]

    @staticmethod
    def _fixed(t: list) -> list:
        def height(x: list | None) -> int:
            return x[3] if x else 0

        def turned(x: list, up: int) -> list:
            y, down = x[up], 3 - up
            x[up], y[down] = y[down], x
            for z in (x, y):
                z[3] = 1 + max(height(z[1]), height(z[2]))
            return y

        t[3] = 1 + max(height(t[1]), height(t[2]))
        lean = height(t[1]) - height(t[2])
        if abs(lean) < 2:
            return t
        side = 1 if lean > 0 else 2
        inner = t[side]
        if height(inner[3 - side]) > height(inner[side]):
            t[side] = turned(inner, 3 - side)
        return turned(t, side)

    def add(self, key: tuple[int, int]) -> None:
        def go(t: list | None) -> list:
            if t is None:
                return [key, None, None, 1]
            side = 1 if key < t[0] else 2
            t[side] = go(t[side])
            return self._fixed(t)

        self.root = go(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def go(t: list, key: tuple[int, int]) -> list | None:
            if key == t[0]:
                if t[1] is None or t[2] is None:
                    return t[1] or t[2]
                heir = t[2]
                while heir[1]:
                    heir = heir[1]
                t[0] = heir[0]
                t[2] = go(t[2], heir[0])
            else:
                side = 1 if key < t[0] else 2
                t[side] = go(t[side], key)
            return self._fixed(t)

        self.root = go(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least remaining capacity of `size` or more."""
        t, best = self.root, None
        while t:
            if t[0] >= (size, -1):
                best, t = t[0], t[1]
            else:
                t = t[2]
        return best


def best_fit_decreasing(histogram: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """Packs `count` groups of each `size`; returns runs (size, from, to, bin), or None if over `most` bins are needed.

    A group above the capacity gets a bin of its own. Equal groups that follow each other into the same tightest
    bin are placed as one run; that is what placing them one by one does.
    """
    bins, opened, runs = Bins(), 0, []
    for size, count in sorted(histogram, reverse=True):
        at = 0
        while at < count:
            room = bins.tightest(size)
            if room is None:
                if most is not None and opened == most:
                    return None
                room, opened = (max(capacity, size), opened), opened + 1
            else:
                bins.remove(room)
            n = min(count - at, room[0] // size)
            runs.append((size, at, at + n, room[1]))
            at += n
            if left := room[0] - n * size:
                bins.add((left, room[1]))
    return runs


def even_packing(histogram: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs for exactly `shards` bins of near equal size: the capacity is halved down to one byte between a value for which
    best fit needs more bins and the one that is taken.

    Groups larger than an even share go alone into the last bins; the others share what is left evenly.
    """
    rest, alone, left = dict(histogram), [], shards
    while rest and left > 1:
        size = max(rest)
        if size * left <= sum(s * n for s, n in rest.items()):
            break
        alone.append((size, len([x for x in alone if x[0] == size])))
        left -= 1
        rest[size] -= 1
        if not rest[size]:
            del rest[size]
    items = sorted(rest.items())
    runs: list = []
    if items:
        total = sum(s * n for s, n in items)
        low, high = max(-(-total // left), items[-1][0]) - 1, total
        step = max(1, low // 4096)
        while high - low > 1:  # first outwards in growing steps, then inwards by halves
            middle = min(low + step, (low + high) // 2) if high == total else (low + high) // 2
            if (found := best_fit_decreasing(items, middle, left)) is None:
                low, step = middle, step * 2
            else:
                runs, high = found, middle
        runs = runs or best_fit_decreasing(items, high, left) or []
    for k, (size, rank) in enumerate(alone):
        runs.append((size, rest.get(size, 0) + rank, rest.get(size, 0) + rank + 1, left + k))
    return runs


RUNS = T.StructType([T.StructField("gsize", T.LongType()), T.StructField("runs", T.ArrayType(T.StructType([T.StructField("upto", T.LongType()), T.StructField("shard", T.IntegerType())])))])


def pack(docs: DataFrame, shards: int = 40, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, group, shard, slot: whole groups of equal texts in `shards` even shards, or in as few
    shards of `capacity` bytes as best fit decreasing needs. Slots are gapless in each shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(F.col(id_col), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("group")))
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    # the leading bits of the size: all of a small one
    shift = F.greatest(F.lit(0), F.length(F.bin("bytes")) - FINE.bit_length())
    entry = F.when(F.col("bytes") < EXACT, F.col("bytes")).otherwise(F.expr("bytes") - F.pmod("bytes", F.pow(F.lit(2), shift).cast("long")))
    groups = written(groups.select("group", "bytes", entry.alias("entry")))
    top = groups.groupBy("entry").agg(F.max("bytes").alias("gsize"), F.count("*").alias("count"))
    histogram = [(r.gsize, r["count"]) for r in top.collect()]
    groups = groups.join(F.broadcast(top.select("entry", "gsize")), "entry").select("group", "gsize")
    packed = best_fit_decreasing(histogram, capacity) if capacity else even_packing(histogram, shards)
    by_size: dict[int, list] = {}
    for size, _, upto, shard in sorted(packed):
        by_size.setdefault(size, []).append((upto, shard))
    runs = spark.createDataFrame(list(by_size.items()), RUNS)
    parts = partitions(spark)
    ranked = running_index(groups, ["gsize"], ["group"], "rank", "group", parts)
    placed = ranked.join(runs, "gsize").select("group", F.filter("runs", lambda x: x["upto"] > F.col("rank"))[0]["shard"].alias("shard"))
    # equal rows are one row with a number until the end, so that no task gathers them
    same = rows.groupBy(*rows.columns).agg(F.count("*").alias("_same"))
    out = same.join(placed, "group").withColumn("_cell", F.pmod(F.xxhash64(F.struct(id_col, "text_crc32", "size")), F.lit(parts)).cast("int"))
    cells = out.groupBy("shard", "_cell").agg(F.sum("_same").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = Window.partitionBy("shard", "_cell").orderBy(id_col, "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed_rows = out.withColumn("_at", F.coalesce(F.sum("_same").over(own), F.lit(0))).join(offsets, ["shard", "_cell"])
    first = F.col("_off") + F.col("_at")
    return placed_rows.select(*rows.columns, "shard", F.explode(F.sequence(first, first + F.col("_same") - 1)).alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
