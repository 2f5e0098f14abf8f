"""The audit against plain whole-number arithmetic and against its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from quire.llm import divergence
from quire.sources.shipping import ship
from tests.llm.helpers import frame, saved


def awkward() -> list[tuple]:
    rng = random.Random(3)
    common = ["the", "The", "été", "Été", "ÉTÉ", "straße", "naïve", "日本", "x", "\U0001f600", "ab", "zeta"]
    rows: list[tuple] = []
    for k in range(160):
        lang, source = rng.choice(["en", "en", "en", "fr", None]), rng.choice(["s0", "s0", "s1", "s2", None])
        rows.append((k, rng.choice([" ", "1", "\n", "_", "'"]).join(rng.choice(common) for _ in range(rng.randint(0, 30))), lang, source, 0))
    rows += [(None, None, "en", "empty", 0), (None, "", None, "", 0), (7, "12 34 -- \x00", "de", "digits", 0), (7, "rare words only", "es", "alone", 0), (8, "x " * 20_000, "en", "s0", 0)]
    return rows + rows[:5] + [(9, f"tie{c} " * 2, "tt", f"t{k % 3}", 0) for c in "abcdefghijklmnop" for k in range(12)]


def brute(rows: list[tuple]) -> list[tuple]:
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        counts[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= 10]

        def shares(key):
            total = sum(counts[key][t] for t in kept)
            return {t: 1 + 10**9 * (counts[key][t] + 2) // (total + 2 * len(kept)) for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        p, q = shares((lang, source)), shares(lang)
        pair = [(-sum(f(p[t], r[t]) for t in kept), other.encode(), other) for g, other in groups if g == lang and other != source for r in [shares((lang, other))]]
        term = [(-f(p[t], q[t]), t.encode(), t) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:10])):
            out += [(lang, source, part, item, -v, k + 1) for k, (v, _, item) in enumerate(items)]
    return sorted(out)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_audit(spark, tmp_path, parts):
    ship(spark)
    rows = awkward()
    folder = saved(spark, tmp_path, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted(map(tuple, divergence.op11_divergence(spark, folder).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(rows)
    assert got == want and {"pair", "term"} == {r[2] for r in want} and any(r[4] == 0 for r in want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert sorted(con.execute(divergence.oracle()).fetchall()) == want


def test_shares_are_exact(spark):
    """Long division against Python's whole numbers, up to counts of 9e15."""
    rng = random.Random(1)
    rows = [(c, d) for e in (1, 3, 6, 9, 12, 15) for _ in range(200) for d in [rng.randint(4, 9 * 10**e)] for c in [rng.randint(0, d - 2)]] + [(0, 2), (9 * 10**15 - 2, 9 * 10**15)]
    got = spark.createDataFrame(rows, "n long, d long").select("n", "d", divergence.share("n + 2", "d").alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 2) // r.d for r in got)


def test_no_rows_and_other_columns(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    docs = frame(spark, [(k, "one two", "en", f"s{k % 2}", 0) for k in range(30)])
    plain = sorted(map(tuple, divergence.audit(docs).collect()))
    more = docs.selectExpr("*", "1 AS term", "2 AS item", "3 AS n", "4 AS docs", "5 AS p", "6 AS salt", "7 AS value")
    assert sorted(map(tuple, divergence.audit(more).collect())) == plain and len(plain) == 2
