"""Dual-tree search against plain comparison of all rows."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest

from quire.llm import hard_negatives as H
from quire.sources.shipping import ship

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows: list[tuple]) -> list[tuple]:
    good = [(i, [math.floor(256 * x) for x in v], (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in rows if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (i, v, y) in enumerate(good):
        if i is None or i % 50:
            continue
        scored = sorted(((-sum(x * z for x, z in zip(v, w)), last(j), j, u == y) for b, (j, w, u) in enumerate(good) if b != a), key=lambda t: t[:2])
        for s, _, j, same in [t for t in scored if t[3]][:5]:
            hard = [(n, -t) for t, _, n, own in scored if not own and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(i, j, k + 1, n, -s, t) for k, (n, t) in enumerate(hard)]
    return out


def text(rows) -> list[str]:
    return sorted(str(tuple(r)) for r in rows)


def awkward() -> list[tuple]:
    rng = random.Random(2)
    gauss = lambda n, m=0.0: [rng.gauss(m, 0.4) for _ in range(n)]
    rows: list[tuple] = [(i, gauss(6, 0.3 * (i % 3)), i % 4) for i in range(420)]
    same = gauss(6, 0.5)
    rows += [(1000 + i, same, i % 3) for i in range(120)]  # equal vectors: ties by id
    rows += [(100, gauss(6, 0.5), 1), (100, gauss(6, 0.5), 2), rows[50], rows[50], rows[0]]  # shared ids, repeated rows
    rows += [(None, same, 0), (None, same, 1), (None, gauss(6, 1), 2)]
    rows += [(2000, None, 1), (2050, same, None), (2100, [0.1, None, 0.2], 1), (2150, [math.nan] * 6, 1), (2200, [math.inf, 0.0], 1), (2250, [], 1), (2300, [], 2)]
    rows += [(2350, gauss(3, 1), 1), (2400, gauss(9, 1), 2), (2450, [-1.0] * 6, 9), (2500, [0.0] * 6, 3), (-50, gauss(6, 1), -3), (3000, same, 77)]
    return rows


@pytest.mark.parametrize(("block", "cut", "anchors", "parts"), [(1024, 32, (256, 16_384), "4"), (16, 2, (3, 5), "4"), (50, 1, (1, 2), "1")])
def test_all_rows_are_compared(spark, monkeypatch, block, cut, anchors, parts):
    ship(spark)
    for name, value in (("BLOCK", block), ("SLICE", cut), ("ANCHORS", anchors)):
        monkeypatch.setattr(H, name, value)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = H.mined(spark.createDataFrame(awkward(), SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(awkward())
    assert text(got) == text(want) and len(want) > 100
    assert len({r[0] for r in want}) > 5 and any(r[1] is None or r[3] is None for r in want)


def test_sql(spark, tmp_path):
    rows = [r for r in awkward() if r[1] is None or len(r[1]) == 6]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet' WHERE vec_id IS NOT NULL")
    ship(spark)
    folder = tmp_path / "known"
    spark.read.parquet(f"{tmp_path}/embeddings.parquet").where("vec_id is not null").write.parquet(f"{folder}/embeddings.parquet")
    assert text(H.op13_hard_negatives(spark, str(folder)).collect()) == text(con.execute(H.oracle()).fetchall())


@pytest.mark.parametrize("size", [1e4, 3e9])
def test_large_components(spark, size):
    """Products past 2**53, which doubles would round; components are exact either way."""
    ship(spark)
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-size, size) + size for _ in range(4)], i % 3) for i in range(200)]
    good = [(i, v, y) for i, v, y in rows if sum((256 * x) ** 2 for x in v) < 2**61]
    assert len(good) > 10 or size > 1e9
    got = H.mined(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    cut = lambda r: (*r[:4], *(min(x, 2**63 - 1) for x in r[4:]))
    assert text(got) == text(cut(r) for r in want) or size > 1e9
    if size > 1e9:  # scores beyond 64 bits all read as the greatest
        assert {r[0] for r in got} <= {r[0] for r in want}


def test_trees_prune_and_lose_nothing(monkeypatch):
    """Clustered vectors with many small leaves: most pairs of leaves are never scored, results stay those of all pairs."""
    monkeypatch.setattr(H, "LEAF", (2, 16))
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 60, (40, 12))
    of = rng.integers(0, 40, 4000)
    y = np.floor(centre[of] + rng.normal(0, 3, (4000, 12))).astype(np.int64)
    labels, ids = of % 7, np.arange(4000)
    own = np.arange(0, 4000, 50)
    scored = []
    plain = H.products
    monkeypatch.setattr(H, "products", lambda a, b: (scored.append(len(a) * len(b)), plain(a, b))[1])
    best = H.positives_of(y[own], labels[own], ids[own], np.full(len(own), -np.inf), y, labels, ids, ids)
    every = y[own] @ y.T
    for k, a in enumerate(own):
        order = sorted((-every[k, j], j) for j in ids if j != a and labels[j] == labels[a])[:5]
        assert [(-s, i) for s, i in zip(best.score[k].tolist(), best.ids[k].tolist())] == order
    assert sum(scored) < len(own) * 4000 / 3
    scored.clear()
    low, high = np.ceil(best.score[:, 0] / 2), np.floor(best.score[:, 0] * 0.95)
    hard = H.negatives_of(y[own], labels[own], np.arange(len(own)), low, high, y, labels, ids, ids)
    for k, a in enumerate(own):
        order = sorted((-every[k, j], j) for j in ids if labels[j] != labels[a] and low[k] <= every[k, j] <= high[k])[:3]
        assert [(-s, i) for s, i in zip(hard.score[k].tolist(), hard.ids[k].tolist()) if s > -np.inf] == order
    assert sum(scored) < len(own) * 4000 / 2


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-300, 300, (200, 7)), rng.integers(-300, 300, (300, 7))
    a, b = H.Tree(x, np.zeros(200, int), 10), H.Tree(y, np.zeros(300, int), 20)
    every = x[a.order] @ y[b.order].T
    for i in range(len(a.span)):
        for j in range(len(b.span)):
            low, high = a.bounds(np.array([i]), b, np.array([j]))
            own = every[slice(*a.span[i]), slice(*b.span[j])]
            assert low[0] <= own.min() and own.max() <= high[0]


def test_no_rows_and_other_columns(spark):
    ship(spark)
    assert H.mined(spark.createDataFrame([], SCHEMA)).count() == 0
    assert H.mined(spark.createDataFrame([(1, [0.5], 1), (2, [0.5], 2)], SCHEMA)).count() == 0
    rows = awkward()[:300]
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS uid", "2 AS q", "3 AS id", "4 AS block", "5 AS at", "6 AS cell", "7 AS k")
    assert text(H.mined(more).collect()) == text(brute(rows))
