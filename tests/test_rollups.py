from __future__ import annotations

import random
from collections import Counter

import __spark_entry__ as entry


def find(up, x):
    while up[x] != x:
        x = up[x]
    return x


def test_whole_components_and_rollup(spark, tmp_path):
    rng = random.Random(3)
    # order 1 ties parts 1 and 2 by a line whose quantity is not 50
    lines = [(1, 1, 50), (1, 2, 7), (2, 2, 50)] + [(o, rng.randint(3, 40), rng.choice((1, 20, 50))) for o in range(3, 30) for _ in range(rng.randint(1, 2))]
    parts = [(p, f"name{p % 11}", f"type{p % 5}") for p in range(1, 41)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    up = {x: x for o, p, _ in lines for x in (f"o{o}", f"p{p}")}
    for o, p, _ in lines:
        a, b = sorted((find(up, f"o{o}"), find(up, f"p{p}")))
        up[b] = a
    queries = entry.queries()
    got = {r.node: r.component for r in queries["connected_components"](spark, str(tmp_path)).collect()}
    assert got == {x: find(up, x) for x in up} and got["p2"] == "o1"
    named = {p: (n, t) for p, n, t in parts}
    want = {}
    for root in set(got.values()):
        mine = [(named[p], o) for o, p, _ in lines if got[f"p{p}"] == root]
        n, first = Counter(x[0] for x, _ in mine), {}
        for (name, _), o in mine:
            first[name] = min(o, first.get(name, o))
        order = sorted(n, key=lambda x: (-n[x], first[x], x))
        want[root] = (order[0], len(mine), len({x[1] for x, _ in mine}), "|".join(order[1:]))
    rolled = queries["component_rollup"](spark, str(tmp_path)).collect()
    assert {r.component: (r.author, r.papers, r.areas, r.variants) for r in rolled} == want
    assert sum(r.papers for r in rolled) == len(lines)
