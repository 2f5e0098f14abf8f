from __future__ import annotations

import random
from pathlib import Path

from quire.operators import registry
from quire.plans.publication import Publication
from quire.streaming.incremental import follow_cache, follow_counts, follow_pull, follow_registry, registered


def test_registry_stream(spark, tmp_path):
    landing, table, mark = (str(tmp_path / x) for x in ("in", "reg", "mark"))
    spark.createDataFrame([(0, "a", 1), (0, "b", 2)], "src_ord long, reg_key string, pos long").write.parquet(landing)
    follow_registry(spark, landing, table, mark, "2026-01-01").awaitTermination()
    spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "src_ord long, reg_key string, pos long").write.mode("append").parquet(landing)
    follow_registry(spark, landing, table, mark, "2026-02-01").awaitTermination()
    got = sorted((r.reg_key, str(r.first_seen)) for r in spark.read.parquet(f"{table}/batch=*").collect())
    assert got == [("a", "2026-01-01"), ("b", "2026-01-01"), ("c", "2026-02-01")]


def test_count_stream(spark, tmp_path):
    landing, table, mark = (str(tmp_path / x) for x in ("in", "cnt", "mark"))
    ddl = "doi_key string, c long, t int"
    spark.createDataFrame([("a", 5, 1), ("a", 3, 2)], ddl).coalesce(1).write.parquet(landing)
    follow_counts(spark, landing, table, mark).awaitTermination()
    spark.createDataFrame([("a", 9, 1), ("b", 1, 1)], ddl).coalesce(1).write.mode("append").parquet(landing)
    follow_counts(spark, landing, table, mark).awaitTermination()
    assert sorted((r.doi_key, r.c, r.t) for r in spark.read.parquet(f"{table}/v2").collect()) == [("a", 3, 2), ("b", 1, 1)]


def repeated(mark: str, number: int) -> None:
    """Takes back the commit of a batch: the next run repeats it."""
    for name in (str(number), f".{number}.crc"):
        (Path(mark) / "commits" / name).unlink(missing_ok=True)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    landing, table, mark = (str(tmp_path / x) for x in ("in", "reg", "mark"))
    ddl = "src_ord long, reg_key string, pos long"
    spark.createDataFrame([(0, "a", 1), (0, "b", 2)], ddl).write.parquet(landing)
    kept = []
    for number in range(2):
        for again in range(2):
            follow_registry(spark, landing, table, mark, "2026-01-01", first_run=True).awaitTermination()
            kept.append(sorted(map(str, spark.read.parquet(f"{table}/batch=*").collect())))
            if not again:
                repeated(mark, number)
        spark.createDataFrame([(0, "b", 1), (1, "c", 2)], ddl).write.mode("append").parquet(landing)
    assert kept[0] == kept[1] and kept[2] == kept[3] and (len(kept[1]), len(kept[3])) == (2, 3)


def test_repeated_counts_change_nothing(spark, tmp_path):
    landing, table, mark = (str(tmp_path / x) for x in ("in", "cnt", "mark"))
    spark.createDataFrame([("a", 5, 1)], "doi_key string, c long, t int").coalesce(1).write.parquet(landing)
    for again in range(2):
        follow_counts(spark, landing, table, mark).awaitTermination()
        assert [tuple(r) for r in spark.read.parquet(f"{table}/v1").collect()] == [("a", 5, 1)]
        if not again:
            repeated(mark, 0)


def test_old_versions_go(spark, tmp_path):
    landing, table, mark = (str(tmp_path / x) for x in ("in", "cnt", "mark"))
    for n in range(3):
        spark.createDataFrame([("a", n, n)], "doi_key string, c long, t int").coalesce(1).write.mode("append").parquet(landing)
        follow_counts(spark, landing, table, mark).awaitTermination()
    assert sorted(p.name for p in Path(table).iterdir()) == ["v2", "v3"]
    assert [tuple(r) for r in spark.read.parquet(f"{table}/v3").collect()] == [("a", 2, 2)]


ROWS = "src_ord long, reg_key string, pos long"


def landed(spark, tmp_path, landings, repeat=False, **options):
    """The registry after landings that come one by one, each of them perhaps repeated."""
    base = tmp_path / f"pull{len(list(tmp_path.iterdir()))}"
    for number, rows in enumerate(landings):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{base}/in")
        for again in range(1 + repeat):
            follow_pull(spark, f"{base}/in", f"{base}/reg", f"{base}/mark", "2026-01-01", **options).awaitTermination()
            if repeat and not again:
                repeated(f"{base}/mark", number)
    return base, sorted((r.reg_key, r.src_ord, str(r.first_seen)) for r in registered(spark, f"{base}/reg").collect())


def test_influx_over_batches(spark, tmp_path):
    """A pull in parts ends as the same pull in one batch: also where an early batch has had its news taken back."""
    rng = random.Random(2)
    for k in range(3):
        rows = [(0, f"a{i}", rng.randint(0, 50)) for i in range(9)] + [(1, f"b{i}", 10 * i + k) for i in range(4)] + [(0, "a1", 99), (0, "a2", 0)]
        by_key: dict[int, list] = {0: [], 1: [], 2: []}
        place = {key: rng.randint(0, 2) for key in {r[1] for r in rows}}  # all rows of a key land together
        for r in rows:
            by_key[place[r[1]]].append(r)
        parts = [by_key[i] for i in range(3) if by_key[i]]
        known = spark.createDataFrame([], "reg_key string, first_seen date")
        whole = registry.register(spark.createDataFrame(rows, ROWS), known, "2026-01-01", influx=5, seeds=3)
        want = sorted((r.reg_key, str(r.first_seen)) for r in whole.collect())
        _, got = landed(spark, tmp_path, parts, repeat=k == 0, influx=5, seeds=3)
        assert [(a, d) for a, _, d in got] == want and sum(d != "None" for a, _, d in got if a[0] == "a") in (2, 3)


def test_pulls_follow_each_other(spark, tmp_path):
    """Another day's pull counts anew, and what an earlier one registered stays as it is."""
    base, got = landed(spark, tmp_path, [[(0, f"a{i}", i) for i in range(4)]], influx=3, seeds=1)
    assert [d for *_, d in got] == ["2026-01-01", "None", "None", "None"]
    spark.createDataFrame([(0, "a2", 0), (0, "new", 5), (1, "a3", 1)], ROWS).write.mode("append").parquet(f"{base}/in")
    follow_pull(spark, f"{base}/in", f"{base}/reg", f"{base}/mark", "2026-01-02", influx=3, seeds=1).awaitTermination()
    later = {r.reg_key: str(r.first_seen) for r in registered(spark, f"{base}/reg").collect()}
    assert later == {"a0": "2026-01-01", "a1": "None", "a2": "None", "a3": "None", "new": "2026-01-02"}
    _, first = landed(spark, tmp_path, [[(0, "x", 2), (0, "y", 1)], [(0, "z", 0)]], first_run=True, seeds=2)
    assert first == [("x", 0, "None"), ("y", 0, "2026-01-01"), ("z", 0, "2026-01-01")]


def test_cache_stream_writes_what_comes(spark, tmp_path):
    ddl, data = "doi_key string, c long, t int", str(tmp_path / "data")
    batches = [[(f"k{i}", i, 1) for i in range(50)], [("k1", 9, 2), ("k1", 8, 2)], [("k2", 0, 0)], [("k3", 30, 1), ("new", 1, 1)]]
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for again in range(2):
            follow_cache(spark, str(tmp_path / "in"), data, "counts", str(tmp_path / "mark")).awaitTermination()
            if not again:
                repeated(str(tmp_path / "mark"), number)
    pub = Publication(spark, data)
    assert {r.doi_key: (r.c, r.t) for r in pub.cache("counts", ddl).collect()} == {f"k{i}": (i, 1) for i in range(50)} | {"k1": (9, 2), "k3": (30, 1), "new": (1, 1)}
    assert sum(n for _, n in pub.parts("counts")) <= 50 + 1 + 1 + 2
