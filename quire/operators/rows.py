"""Row-level relational operators: keep-first, overlays by key, anti-append, merges of cached state, top-k.

All take column names, so the same operator serves papers and any other table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import blank_to_null, or_blank


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key by `order`; rows without a key (null or blank) all stay.

    An aggregate (min_by over a struct) rather than a window: rows combine before the shuffle, so a hot key does not
    gather in one task.
    """
    whole = F.struct(*df.columns)
    keyed = df.where(or_blank(F.col(key).cast("string")) != "")
    first = keyed.groupBy(F.col(key).alias("_key")).agg(F.min_by(whole, F.struct(*order)).alias("_row")).select("_row.*")
    return first.unionByName(df.where(or_blank(F.col(key).cast("string")) == ""))


def distinct_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """Different keys with the place of their first occurrence."""
    return df.where(or_blank(F.col(key).cast("string")) != "").groupBy(key).agg(F.min(order).alias(order))


def overlay(df: DataFrame, side: DataFrame, key: str, fill: Sequence[str] = (), override: Sequence[str] = (), small: bool = False) -> DataFrame:
    """Left join by key: `fill` columns only where df's are missing, `override` columns wherever the side has one.

    `small` marks a side whose size the caller has checked; else the planner decides by its statistics.
    """
    names = {c: f"_s_{c}" for c in (*fill, *override)}
    s = side.select(F.col(key), *[F.col(c).alias(n) for c, n in names.items()])
    joined = df.join(F.broadcast(s) if small else s, key, "left")
    text = {c: _missing(df, c) for c in fill}
    new = {c: F.coalesce(text[c], F.col(names[c]), F.col(c)) for c in fill}
    new |= {c: F.coalesce(_missing(side, c, names[c]), F.col(c)) for c in override}
    return joined.withColumns(new).drop(*names.values())


def _missing(df: DataFrame, column: str, name: str | None = None) -> Column:
    c = F.col(name or column)
    return blank_to_null(c) if dict(df.dtypes)[column] == "string" else c


def append_unseen(df: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """df and the rows of extra whose key df does not hold."""
    return df.unionByName(extra.join(df.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def unseen(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key), key, "left_anti")


def recent(df: DataFrame, registry: DataFrame, key: str, seen: str, pull_date: str, days: int) -> DataFrame:
    """Rows whose key was first seen within `days` before the pull date (inclusive, no upper bound)."""
    return df.join(registry, key).where(F.col(seen) >= F.date_sub(F.lit(pull_date).cast("date"), days))


def keep_old_unless_found(df: DataFrame, cache: DataFrame, key: str, column: str, found: str) -> DataFrame:
    """The cache's value where it has one; an old value survives a miss."""
    return df.join(cache.select(key, found), key, "left").withColumn(column, F.coalesce(blank_to_null(F.col(found)), F.col(column))).drop(found)


def lift_max(df: DataFrame, cache: DataFrame, key: str, column: str, source: str, count: str, label: Column) -> DataFrame:
    """Raises `column` to the cache's count; `source` is named only where the cache is strictly larger."""
    joined = df.join(cache, key, "left")
    wins = F.col(count) > F.coalesce(column, F.lit(0))
    return joined.withColumns({column: F.when(wins, F.col(count)).otherwise(F.col(column)), source: F.when(wins, label).otherwise(F.col(source))}).select(*df.columns)


def merge_recency(current: DataFrame, incoming: DataFrame, key: str, t: str, c: str) -> DataFrame:
    """One row a key: the later t, then the larger c; a full tie keeps the current row."""
    both = current.withColumn("_cur", F.lit(1)).unionByName(incoming.withColumn("_cur", F.lit(0)))
    best = F.struct(F.coalesce(t, F.lit(0)), F.coalesce(c, F.lit(0)), "_cur")
    return both.groupBy(key).agg(F.max_by(F.struct(*[x for x in current.columns if x != key]), best).alias("_r")).select(key, "_r.*").select(*current.columns)


def merge_found_wins(current: DataFrame, incoming: DataFrame, key: str, found: str) -> DataFrame:
    """One row a key: the current one if it has found something, else the incoming one if there is one."""
    rest = [x for x in current.columns if x != key]
    a, b = (d.select(key, F.struct(*rest).alias(n)) for d, n in ((current, "_a"), (incoming, "_b")))
    pick = F.when(blank_to_null(F.col(f"_a.{found}")).isNotNull(), F.col("_a")).otherwise(F.coalesce("_b", "_a"))
    return a.join(b, key, "full_outer").select(key, pick.alias("_r")).select(key, "_r.*").select(*current.columns)


def overlay_all(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Whole records by key, the incoming one on top."""
    rest = [x for x in current.columns if x != key]
    a, b = (d.select(key, F.struct(*rest).alias(n)) for d, n in ((current, "_a"), (incoming, "_b")))
    return a.join(b, key, "full_outer").select(key, F.coalesce("_b", "_a").alias("_r")).select(key, "_r.*").select(*current.columns)


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def trim_or_top(df: DataFrame, count: str, order: Sequence[Column], key: str, n: int, enough: int = 2) -> DataFrame:
    """Rows with `enough` or among the first n in order, without a window over all rows."""
    first = df.orderBy(*order).limit(n).select(key)
    return df.where(F.col(count) >= enough).unionByName(df.where(F.col(count) < enough).join(first, key, "left_semi"))


def first_acceptable(df: DataFrame, key: str, ok: Column, ord_col: str) -> DataFrame:
    """For each key the acceptable row that comes first."""
    return df.where(ok).groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c != key]), ord_col).alias("_r")).select(key, "_r.*")


def numbered_batches(df: DataFrame, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """Rows in batches of `size` in order. A range sort numbers rows by partition; only partition counts meet."""
    ordered = df.orderBy(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    from quire.sources.shared import written

    ordered = written(ordered)
    counts = ordered.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_m").alias("_m0"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = counts.select("_p", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.col("_m") - F.col("_m0") + F.col("_off")
    return ordered.join(F.broadcast(offsets), "_p").withColumn(name, F.floor(place / size).cast("long")).drop("_p", "_m", "_m0", "_off")


def shrink_guard(fresh: DataFrame, committed: DataFrame, source: str, allow: bool = False) -> DataFrame:
    """Fresh rows of each source, or its committed rows where the fresh ones are fewer than half of them."""
    n_new, n_old = (d.groupBy(source).agg(F.count("*").alias(c)) for d, c in ((fresh, "_new"), (committed, "_old")))
    counts = n_old.join(n_new, source, "full_outer")
    shrunk = F.lit(False) if allow else (F.coalesce("_old", F.lit(0)) > 0) & (F.coalesce("_new", F.lit(0)) * 2 < F.col("_old"))
    back = counts.where(F.coalesce(shrunk, F.lit(False))).select(source)
    return fresh.join(back, source, "left_anti").unionByName(committed.join(back, source, "left_semi"))


def changes(fresh: DataFrame, committed: DataFrame, source: str, key: str, compared: Sequence[str]) -> DataFrame:
    """(source, key, change): added, gone, changed (a compared column differs) or same, for each key of either side. Of rows
    of one key those with equal values are one; a key with several values differs unless both sides have the same ones."""
    def valued(df: DataFrame, name: str) -> DataFrame:
        value = F.xxhash64(*[F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in compared])
        return df.select(source, key, value.alias("_v")).distinct().groupBy(source, key).agg(F.bit_xor("_v").alias(name))

    both = valued(fresh, "_new").join(valued(committed, "_old"), [source, key], "full_outer")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "gone").when(F.col("_new") != F.col("_old"), "changed").otherwise("same")
    return both.select(source, key, change.alias("change"))


def fallback(fresh: DataFrame, committed: DataFrame, source: str, key: str, compared: Sequence[str], allow: bool = False) -> tuple[DataFrame, DataFrame]:
    """shrink_guard() with its reasons: the rows, and for each source how many rows either side has, how many keys
    were added, are gone or have changed, and which side was kept (`kept`: fresh or committed)."""
    sizes = [d.groupBy(source).agg(F.count("*").alias(c)) for d, c in ((fresh, "fresh"), (committed, "committed"))]
    zero = F.lit(0).cast("long")
    counts = changes(fresh, committed, source, key, compared).groupBy(source).agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "gone", "changed")])
    told = sizes[0].join(sizes[1], source, "full_outer").join(counts, source, "left")
    told = told.select(source, *[F.coalesce(c, zero).alias(c) for c in ("fresh", "committed", "added", "gone", "changed")])
    shrunk = F.lit(False) if allow else (F.col("committed") > 0) & (F.col("fresh") * 2 < F.col("committed"))
    told = told.withColumn("kept", F.when(shrunk, "committed").otherwise("fresh"))
    back = told.where("kept = 'committed'").select(source)
    return fresh.join(back, source, "left_anti").unionByName(committed.join(back, source, "left_semi")), told
