from __future__ import annotations

import random

import pytest

from quire.llm import decontamination as D
from quire.llm.common import Words
from quire.sources.shipping import ship
from tests.llm.helpers import frame, words


def plain_overlaps(doc: list[str], item: list[str]) -> set[tuple[int, int]]:
    """Runs of the document beside the item, by looking along every diagonal."""
    out, n = set(), len(item)
    if 0 < n < D.SHORTEST:
        return {(0, n)} if doc == item else set()
    for shift in range(-n + 1, len(doc)):
        lo, hi = max(0, -shift), min(n, len(doc) - shift)
        equal = [item[i] == doc[i + shift] for i in range(lo, hi)]
        cover = [False] * len(equal)
        for w, places in ((min(n, D.WINDOW), range(len(equal) - min(n, D.WINDOW) + 1)), (n, range(1 if hi - lo == n else 0))):
            for i in places:
                if 5 * sum(equal[i : i + w]) >= 4 * w and sum(equal[i : i + w]) >= D.SHORTEST:
                    cover[i : i + w] = [True] * w
        i = 0
        while i < len(cover):
            if not cover[i]:
                i += 1
                continue
            j = i
            while j < len(cover) and cover[j]:
                j += 1
            own = [k for k in range(i, j) if equal[k]]
            out.add((lo + own[0] + shift, lo + own[-1] + 1 + shift))
            i = j
    return out


@pytest.mark.parametrize("size", [D.SLICE, 3])
def test_overlaps_against_all_diagonals(monkeypatch, size):
    """Items of 1 to 40 words, cut, repeated and with substitutions, in small texts; and the same with slices of 3 hits."""
    monkeypatch.setattr(D, "SLICE", size)
    rng = random.Random(size)
    items = [[f"w{rng.randint(0, 60)}" for _ in range(n)] for n in (*range(1, 24), 30, 40)]
    items.append(items[20][:12] + items[24][:12])
    docs = []
    for _ in range(150 if size > 3 else 30):
        doc = [f"x{rng.randint(0, 9)}" for _ in range(rng.randint(0, 10))]
        for item in rng.sample(items, 2):
            a = rng.randint(0, len(item) // 3)
            own = item[a : len(item) - rng.randint(0, len(item) // 3)]
            doc += ["other" if rng.random() < 0.15 else w for w in own] * rng.randint(1, 2)
        docs.append(doc)
    docs += [*items[:5], [], ["w1"]]
    ids = [None, *range(1, len(items))]
    found = D.Seeds(ids, [" ".join(i).encode() for i in items]).overlaps(Words([" ".join(d).encode() for d in docs]))[1]
    want = {(t, i, a, b) for t, d in enumerate(docs) for i, item in zip(ids, items) for a, b in plain_overlaps(d, item)}
    assert set(found) == want and len(want) > 20


def test_all_runs_of_a_diagonal_count(spark):
    ship(spark)
    rng = random.Random(3)
    item = words(rng, 60).split()
    text = " ".join(item[:20] + ["other"] * 20 + item[40:])
    bench = spark.createDataFrame([(7, " ".join(item)), (7, " ".join(item)), (None, " ".join(item)), (-1, " ".join(item[:20]))], "item_id long, text string")
    got = D.contamination(frame(spark, [(1, text, "", "", 0)]), bench).first()
    assert got.matched_words == 40 and got["items"] == [None, -1, 7]
    assert got.spans == "null:0:20,null:40:60,-1:0:20,7:0:20,7:0:20,7:40:60,7:40:60"


def test_a_seed_in_many_items(spark):
    """Items that share one run of words, by the hundred, and a document that repeats it: all are found."""
    ship(spark)
    rng = random.Random(4)
    common = words(rng, 12)
    items = [(k, f"{common} {words(rng, 8)}") for k in range(300)]
    docs = frame(spark, [(1, " ".join([common] * 40), "", "", 0), (2, items[5][1], "", "", 0)])
    got = {r.doc_id: r for r in D.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), keep=["doc_id"]).collect()}
    assert got[1]["items"] == got[2]["items"] == list(range(300)) and got[1].matched_words == 480 and got[2].matched_words >= 20


def test_empty_tables(spark):
    ship(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    for b in (none, bench):
        assert D.contamination(frame(spark, []), b).count() == 0
    blank = D.contamination(frame(spark, [(None, None, None, None, None)]), none).first()
    assert (blank.n_hits, blank["items"], blank.spans, blank.contaminated) == (0, [], "", False)
