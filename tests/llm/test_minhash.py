from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from quire.llm import minhash
from quire.sources.shipping import ship
from tests.llm.helpers import words
from tests.llm.test_dedup import all_by_value, linked_rows


def fingerprint(text: str) -> str:
    """Of one text, value by value in whole numbers; shingles by the module's hash of them."""
    w = text.encode().split()
    if not w:
        return "ffff" * minhash.PERMS
    hashes, _ = minhash.shingle_hashes([text.encode()])
    out = []
    for j in range(minhash.PERMS):
        a, b = int(minhash.MULTIPLY[j]), int(minhash.ADD[j])
        out.append(min((int(h) * a + b) % (1 << 64) >> 32 for h in hashes) & 0xFFFF)
    return "".join(f"{v:04x}" for v in out)


@pytest.mark.parametrize("parts", ["1", "4", "13"])
def test_followers(spark, parts):
    """Missing ids, ids that hold many rows, repeated rows: each row is followed by the next one in the order."""
    ship(spark)
    rng = random.Random(int(parts))
    data = [(d, words(rng, rng.randint(0, 12))) for d in [*range(40), *[7] * 30, *[None] * 40, -3, -3]] + [(9, None), (9, ""), (3, "same"), (3, "same")]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = spark.createDataFrame(data, "doc_id long, text string")
        tie = {r.t: r.h for r in docs.selectExpr("coalesce(text, '') AS t", "xxhash64(coalesce(text, '')) AS h").collect()}
        got = minhash.edited_fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    order = sorted(((d, t or "") for d, t in data), key=lambda x: (x[0] is None, -(x[0] or 0), tie[x[1]], x[1]))
    marks = {t: fingerprint(t) for t in tie}
    like = lambda a, b: sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / minhash.PERMS
    want = []
    for k, (d, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        m = len(t) // 3
        e = t[: len(t) - m] + n[:m]
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), marks[t], fingerprint(e), like(marks[t], fingerprint(e)), like(marks[t], marks[n])))
    assert all_by_value(got) == all_by_value(want)


def test_lone_and_no_rows(spark):
    ship(spark)
    one = minhash.edited_fingerprints(spark.createDataFrame([(None, "a b c d e f", "x")], "doc_id int, text string, id string"))
    assert one.dtypes[0] == ("doc_id", "int")
    assert [(r.doc_id, r.near_next) for r in one.collect()] == [(None, 1.0)]


def test_near_duplicates_by_own_bands(spark):
    ship(spark)
    rng = random.Random(41)
    data = [(None, None), (1, "")]
    for k in range(40):
        base = words(rng, rng.randint(50, 120)).split()
        for j in range(4):
            own = list(base)
            for at in rng.sample(range(len(own)), j):
                own[at] = words(rng, 1)
            data.append((4 * k + j, " ".join(own)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got, want = all_by_value(minhash.near_duplicates(docs).collect()), all_by_value(linked_rows(data))
    assert sum(r[2] for r in want) > 100 and got == want


def test_signature_is_a_minimum_of_hashes():
    hashes, first = minhash.shingle_hashes([b"a b c d e f g", b"", b"x"])
    assert np.diff(first).tolist() == [3, 0, 1]
    assert minhash.hexed(minhash.signatures(hashes, first))[0] == fingerprint("a b c d e f g")
