from __future__ import annotations

import hashlib
import random

import pytest

from quire.llm import sharding
from quire.sources.shipping import ship


def plain_packing(groups: list[tuple[int, bytes]], capacity: int) -> list[list[int]]:
    """Best fit decreasing, group by group over a list of bins: the sizes in each bin."""
    bins: list[list[int]] = []
    room: list[int] = []
    for size, _ in sorted(groups, key=lambda g: (-g[0], g[1])):
        fits = [(left, k) for k, left in enumerate(room) if left >= size]
        if fits:
            k = min(fits)[1]
            room[k] -= size
            bins[k].append(size)
        else:
            room.append(max(capacity, size) - size)
            bins.append([size])
    return bins


@pytest.mark.parametrize("capacity", [300, 1000])
def test_pack_against_plain(spark, capacity):
    """Whole groups of copies with nulls, empty texts and repeated rows, into as few bins of a capacity as best fit needs."""
    ship(spark)
    rng = random.Random(capacity)
    texts = ["x" * rng.randint(0, 150) + str(k % 7) for k in range(120)]
    data = [(k, rng.choice(texts)) for k in range(300)] + [(None, None), (5, ""), (5, ""), (6, texts[0])]
    got = sharding.pack(spark.createDataFrame(data, "doc_id long, text string"), capacity=capacity).collect()
    size: dict[bytes, int] = {}
    for _, t in data:
        key = hashlib.sha256((t or "").encode()).digest()
        size[key] = size.get(key, 0) + len((t or "").encode()) + 16
    want = plain_packing([(n, k) for k, n in size.items()], capacity)
    bins: dict[int, dict] = {}
    for r in got:
        bins.setdefault(r.shard, {})[bytes(r.group)] = size[bytes(r.group)]
    assert sorted(sorted(b.values()) for b in bins.values()) == sorted(sorted(b) for b in want)
    assert sum(len(b) for b in bins.values()) == len(size) and len(got) == len(data)


def test_entries_of_large_sizes_stay_close(spark):
    """Sizes above EXACT share entries; shards are even to one part in a thousand all the same."""
    ship(spark)
    rng = random.Random(2)
    data = [(k, chr(97 + k % 26) * rng.randint(9_000, 40_000) + str(k)) for k in range(400)]
    got = sharding.pack(spark.createDataFrame(data, "doc_id long, text string"), shards=5).groupBy("shard").sum("size").collect()
    loads = [r["sum(size)"] for r in got]
    assert len(loads) == 5 and max(loads) - min(loads) < 0.002 * max(loads)


def test_thousands_of_equal_rows(spark):
    """Equal rows, copies under other ids and rows without an id: every row has a slot of its own, however it is dealt."""
    ship(spark)
    data = [(7, "same text")] * 5000 + [(None, "same text")] * 300 + [(k, "same text") for k in range(100, 400)] + [(k, f"text {k % 90}") for k in range(500)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = [sorted(str((r.doc_id, r.text_crc32, r.size, r.shard, r.slot)) for r in sharding.pack(docs.repartition(n), shards=4).collect()) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == len(data)
    slots: dict[int, list] = {}
    for r in sharding.pack(docs, shards=4).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 4
