from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from quire.llm import ngram_jaccard, substring_dedup, suffix_array, suffix_dedup
from quire.sources.shipping import ship
from tests.llm.helpers import corpus, saved, words


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    ship(spark)
    return saved(spark, tmp_path_factory.mktemp("dedup"), rows)


def removed_bytes(texts: dict) -> dict:
    counts: dict[bytes, int] = {}
    data = {d: (t or "").encode() for d, t in texts.items()}
    for t in data.values():
        for i in range(len(t) - 199):
            counts[t[i : i + 200]] = counts.get(t[i : i + 200], 0) + 1
    out = {}
    for d, t in data.items():
        off = [False] * len(t)
        for i in range(len(t) - 199):
            if counts[t[i : i + 200]] > 1:
                off[i : i + 200] = [True] * 200
        kept = bytes(b for b, o in zip(t, off) if not o)
        spans = sum(o and (i == 0 or not off[i - 1]) for i, o in enumerate(off))
        out[d] = (len(t), sum(off), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("salt", [20_000, 1])
def test_suffix_array_dedup(spark, rows, folder, monkeypatch, salt):
    monkeypatch.setattr(suffix_dedup, "SALT_ROWS", salt)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op3_suffix_array_dedup(spark, folder).collect()]
    assert sorted(got) == sorted((d, *x) for d, x in removed_bytes({r[0]: r[1] for r in rows}).items())


def removed_words(texts: dict) -> dict:
    split = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in sorted(texts.items())}
    first: dict[tuple, int] = {}
    for d, w in split.items():
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), d)
    out = {}
    for d, w in split.items():
        keep = [True] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                keep[i : i + 50] = [False] * 50
        kept = [x for x, k in zip(w, keep) if k]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("salt", [20_000, 1])
def test_substring_dedup(spark, rows, folder, monkeypatch, salt):
    monkeypatch.setattr(substring_dedup, "SALT_ROWS", salt)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op4_substring_dedup(spark, folder).collect()]
    assert sorted(got) == sorted((d, *x) for d, x in removed_words({r[0]: r[1] for r in rows}).items())


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_merged_runs_hold_each_key_once(spark, parts):
    """The same words in each of four batches, counted as rows, whatever the number of partitions."""
    ship(spark)
    rng = random.Random(parts)
    passage, whole = words(rng, 90), words(rng, 70)
    data = [(k, whole if k % 3 == 0 else f"{words(rng, 5)} {passage} {words(rng, 60)}") for k in range(16)]
    docs = spark.createDataFrame(data, "doc long, text string")
    index, got = substring_dedup.Index(spark, f"quire_test_merge_{parts}"), []
    merges = 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        for k in range(0, 16, 4):
            known, stretches = index.match(docs.where(docs.doc.between(k, k + 3)))
            cut = {r.doc: r for r in substring_dedup.removed(docs, stretches).collect()}
            for r in known.collect():
                n = r.n_words if r.whole and r.n_words >= 50 else cut[r.doc].n_removed if r.doc in cut else 0
                got.append((r.doc, r.n_words, n))
            for kind, key in (("kinds", ["sha"]), ("windows", ["h", "w"])):
                before_merge = {t for _, t in index.runs[kind]}
                index.compact(kind, key[0])
                for n, merged in index.runs[kind]:
                    if merged not in before_merge:
                        run = spark.table(merged)
                        assert run.count() == run.select(*key).distinct().count() == n
                        merges += 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        index.drop()
    assert sorted(got) == sorted((d, *x[:2]) for d, x in removed_words(dict(data)).items())
    assert merges >= 4


def test_warehouse_must_be_named(spark):
    assert not substring_dedup.warehouse_is_default(spark)


def test_runs_without_a_named_warehouse_lie_in_the_shared_folder(spark, rows, folder, monkeypatch):
    monkeypatch.setattr(substring_dedup, "warehouse_is_default", lambda spark: True)
    placed, plain = set(), substring_dedup.Index._plain

    def seen(index, table):
        df = plain(index, table)
        placed.update(df.inputFiles())
        return df

    monkeypatch.setattr(substring_dedup.Index, "_plain", seen)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op4_substring_dedup(spark, folder).collect()}
    assert got == removed_words({r[0]: r[1] for r in rows})
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    assert placed and all(f"{shared}/{substring_dedup.RUNS}/" in f for f in placed)
    assert not spark.catalog.listTables(substring_dedup.RUNS)


def removed_words_of_rows(data: list[tuple]) -> list[tuple]:
    """As removed_words(), for rows that may share ids or have none (then before all others)."""
    rank = [(d is not None, d or 0) for d, _ in data]
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in data]
    first: dict[tuple, tuple] = {}
    for k in sorted(range(len(data)), key=rank.__getitem__):
        for i in range(len(split[k]) - 49):
            first.setdefault(tuple(split[k][i : i + 50]), rank[k])
    out = []
    for (d, _), r, w in zip(data, rank, split):
        keep = [True] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < r:
                keep[i : i + 50] = [False] * 50
        kept = [x for x, k in zip(w, keep) if k]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def by_id(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))


def thue_morse(n: int) -> tuple[str, str]:
    """Two different words that polynomial hashes modulo 2**64 can't tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def awkward_rows() -> list[tuple]:
    rng = random.Random(12)
    p, q, r = (words(rng, 80) for _ in range(3))
    one, two = thue_morse(4096)
    a, b = words(rng, 30), words(rng, 30)
    data = [(None, p), (None, q + " " + p), (1, p + " one"), (2, q + " two"), (3, r), (3, p), (-1, r + " x"), (4, r), (4, r), (4, r.replace(" ", "\n")), (None, None), (5, "")]
    data += [(10, f"{a} {one} {b}"), (11, f"{a} {two} {b}"), (12, f"{a} {one} {b} {a}")]
    return data


@pytest.mark.parametrize("bits", [substring_dedup.BITS, 1, 0])
def test_substring_dedup_compares_words(spark, tmp_path, bits):
    """Shared and missing ids, words that hash alike, and window hashes of so few bits that most candidates are false."""
    ship(spark)
    data = awkward_rows()
    docs = spark.createDataFrame([(d, t) for d, t in data], "doc_id long, text string")
    known, cut = substring_dedup.dedup(docs, bits=bits)
    rows = cut.collect()
    cut = {(r.doc, bytes(r.sha)): r for r in rows}
    assert len(cut) == len(rows)
    got = []
    for r in known.collect():
        c = cut.get((r.doc, bytes(r.sha)))
        d = None if r.doc == substring_dedup.NO_ID else r.doc
        if r.whole and r.n_words >= 50:
            got.append((d, r.n_words, r.n_words, hashlib.sha256(b"").hexdigest()))
        else:
            got.append((d, r.n_words, c.n_removed if c else 0, hashlib.sha256(c.kept.encode()).hexdigest() if c else r.sha.hex()))
    assert by_id(got) == by_id(removed_words_of_rows(data))
    if bits == substring_dedup.BITS:
        folder = saved(spark, tmp_path, [(d, t, "en", "s", 0) for d, t in data])
        assert by_id(substring_dedup.op4_substring_dedup(spark, folder).collect()) == by_id(removed_words_of_rows(data))


def test_substring_index_is_a_log(spark, rows):
    """Batches go in one by one, like runs are merged, and another Index of the name goes on from the same runs."""
    ship(spark)
    name = "quire_test_log"
    texts = {r[0]: r[1] for r in rows}
    docs = spark.createDataFrame(list(texts.items()), "doc long, text string")
    want, ids, sizes = removed_words(texts), sorted(texts), []
    for k in range(0, len(ids), 4):
        index = substring_dedup.Index(spark, name)
        batch = docs.where(docs.doc.isin(ids[k : k + 4]))
        known, stretches = index.match(batch)
        rows_cut = substring_dedup.removed(docs, stretches).collect()
        cut = {r.doc: r.n_removed for r in rows_cut}
        known = known.collect()
        assert len(cut) == len(rows_cut) and len(known) == len(ids[k : k + 4])
        for r in known:
            n = r.n_words if r.whole and r.n_words >= 50 else cut.get(r.doc, 0)
            assert (r.n_words, n) == want[r.doc][:2], r.doc
        sizes.append([n for n, _ in index.runs["windows"]])
    index = substring_dedup.Index(spark, name)
    assert [n for n, _ in index.runs["windows"]] == sizes[-1]
    index.compact("windows", "h")
    oldest = spark.table(index.runs["windows"][0][1])
    assert oldest.count() == oldest.select("h", "w").distinct().count() and len(index.runs["windows"]) < len(sizes)
    sizes.append([n for n, _ in index.runs["windows"]])
    assert all(a >= 2 * b for run in sizes for a, b in zip(run[:-1], run[1:-1])) and all(a >= 2 * b for a, b in zip(sizes[-1], sizes[-1][1:]))
    index.drop()
    assert not spark.catalog.listTables(pattern=name + "*")


def shingles(text: str | None) -> frozenset:
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("block", [1000, 2])
def test_jaccard_join(spark, rows, folder, monkeypatch, block):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    found = ngram_jaccard.op5_ngram_jaccard(spark, folder).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    first: dict[str, int] = {}
    for d, t, *_ in rows:
        first.setdefault(t or "", d)
    sets = {c: shingles(t) for t, c in first.items()}
    for d, t, *_ in rows:
        c = first[t or ""]
        links = [x for x, s in sets.items() if x != c and s and sets[c] and len(s & sets[c]) >= 0.8 * len(s | sets[c])]
        assert (got[d].class_id, got[d].n_links) == (c, len(links)), d
        others = sum((first[u or ""] in links or first[u or ""] == c) for e, u, *_ in rows if e != d)
        assert got[d].n_linked_docs == others
    assert got[3].group_id == got[7].group_id == got[8].group_id


def linked_rows(data: list[tuple]) -> list[tuple]:
    """Every row's class, links, linked rows and group, by comparing all texts."""
    kinds = sorted({t or "" for _, t in data})
    sets = {t: shingles(t) for t in kinds}
    ids = {t: min((d for d, u in data if (u or "") == t and d is not None), default=None) for t in kinds}
    copies = {t: sum((u or "") == t for _, u in data) for t in kinds}
    near = {t: {u for u in kinds if u != t and sets[t] and sets[u] and 10 * len(sets[t] & sets[u]) >= 8 * len(sets[t] | sets[u])} for t in kinds}
    group: dict[str, set] = {}
    for t in kinds:
        todo, own = [t], {t}
        while todo:
            fresh = near[todo.pop()] - own
            own |= fresh
            todo += fresh
        group[t] = own
    low = lambda ts: min((ids[t] for t in ts if ids[t] is not None), default=None)
    return [(d, ids[t or ""], len(near[t or ""]), sum(copies[u] for u in near[t or ""]) + copies[t or ""] - 1, low(group[t or ""])) for d, t in data]


def all_by_value(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda x: tuple((v is not None, v or 0) for v in x))


@pytest.mark.parametrize("block,size", [(1000, 1 << 21), (3, 1 << 21), (1000, 600)])
def test_jaccard_join_of_shared_and_missing_ids(spark, monkeypatch, block, size):
    """Rows under one id, without an id, words that hash alike, a chain of near copies in blocks small in texts or bytes."""
    ship(spark)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_BYTES", size)
    rng = random.Random(21)
    p, q = words(rng, 60), words(rng, 60)
    data = [(5, p), (5, q), (6, p + " x"), (None, q + " y"), (None, p), (None, None), (7, " "), (8, "one two"), (9, "one  two"), (9, "one  two"), *zip((10, 11), thue_morse(4096))]
    near = words(rng, 200).split()
    for k in range(12):
        near[16 * k] = f"w{k}"
        data.append((100 + k, " ".join(near)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert all_by_value(ngram_jaccard.jaccard_join(docs).collect()) == all_by_value(linked_rows(data))
    kept = [tuple(r) for r in ngram_jaccard.one_of_each(docs).collect()]
    assert all_by_value(kept) == all_by_value([(5, p), (5, q), (None, None), (7, " "), (8, "one two"), (10, data[10][1]), (11, data[11][1]), (100, data[12][1])])


def test_jaccard_join_finds_every_near_pair(spark):
    """Recall against all pairs of a table with many texts near the threshold, on both sides of it."""
    ship(spark)
    rng = random.Random(31)
    data = []
    for k in range(60):
        base = words(rng, rng.randint(60, 160)).split()
        data.append((10 * k, " ".join(base)))
        for j in range(1, 6):
            own = list(base)
            for at in rng.sample(range(len(own)), max(1, round(len(own) * 0.0075 * j))):
                own[at] = words(rng, 1)
            data.append((10 * k + j, " ".join(own)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got, want = all_by_value(ngram_jaccard.jaccard_join(docs).collect()), all_by_value(linked_rows(data))
    assert sum(r[2] for r in want) > 300 and got == want


def test_shingles_of_one_hash_are_told_apart(monkeypatch):
    texts = [b"a b c d e f", b"a b c d e g", b"h"]
    want = [set(), set(), set()]
    for k, t in enumerate(texts):
        want[k] = shingles(t.decode())
    monkeypatch.setattr(ngram_jaccard, "span_hash", lambda p, a, b: np.zeros(len(a), np.uint64))
    monkeypatch.setattr(ngram_jaccard.Words, "hashes", lambda self: np.zeros(len(self.start), np.uint64))
    ids, first, _ = ngram_jaccard.shingle_sets(texts)
    got = [set(ids[a:b].tolist()) for a, b in zip(first, first[1:])]
    assert [len(x) for x in got] == [len(x) for x in want]
    assert all(len(got[i] & got[j]) == len(want[i] & want[j]) for i in range(3) for j in range(3))


def test_posterior_bound():
    assert [ngram_jaccard.least_matches(n) for n in (16, 160)] == sorted(ngram_jaccard.least_matches(n) for n in (16, 160))
    # a pair at the threshold survives all steps with near certainty
    rng = np.random.default_rng(1)
    lost = sum(any((hits := rng.random(160) < 0.8)[:n].sum() < ngram_jaccard.least_matches(n) for n in range(16, 161, 16)) for _ in range(3000))
    assert lost == 0


@pytest.mark.parametrize("seed", [700, 2])
def test_suffix_array(seed):
    rng = random.Random(seed)
    for n in range(60):
        body = [rng.randint(1, 1 + n % 4) for _ in range(n)] if n % 3 else [1, 2, 1] * (n // 3)
        s = np.array([*body, 0])
        sa = suffix_array.suffix_array(s, 8)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        phi, plcp = suffix_array.common_prefixes(s, sa)
        for i, p in enumerate(phi.tolist()):
            if p >= 0:
                k = 0
                while max(i, p) + k < len(s) and s[i + k] == s[p + k]:
                    k += 1
                assert plcp[i] == k


def test_suffix_array_of_a_shard(monkeypatch):
    """Every level of a whole shard is induced: names by the thousand recurse, and no other sort of suffixes runs."""
    rng = random.Random(3)
    vocabulary = [words(rng, 1) for _ in range(20_000)]
    text = " ".join(rng.choice(vocabulary) for _ in range(130_000)).encode()[: suffix_dedup.SHARD_BYTES]
    s = np.append(np.frombuffer(text, np.uint8).astype(np.int64) + 1, 0)
    levels = []
    induce = suffix_array.suffix_array
    monkeypatch.setattr(suffix_array, "suffix_array", lambda s, k: levels.append(k) or induce(s, k))
    sa = suffix_array.suffix_array(s, 257)
    assert len(levels) > 2 and max(levels) > 10_000
    rank = np.empty(len(sa), np.int64)
    rank[sa] = np.arange(len(sa))
    a, b = sa[:-1], sa[1:]
    assert sorted(sa.tolist()) == list(range(len(s)))
    assert ((s[a] < s[b]) | ((s[a] == s[b]) & (rank[np.minimum(a + 1, len(s) - 1)] < rank[np.minimum(b + 1, len(s) - 1)]))).all()


def test_suffix_array_dedup_of_shared_and_missing_ids(spark, tmp_path):
    """Each row for itself: two texts without an id, two under one id, a real -1, one repeated row."""
    ship(spark)
    rng = random.Random(11)
    p, q, r = (words(rng, 80) for _ in range(3))
    data = [(None, p), (None, q), (1, p + " one"), (2, q + " two"), (3, r), (3, p), (-1, r + " x"), (4, r), (4, r), (None, None), (5, "")]
    folder = saved(spark, tmp_path, [(d, t, "en", "s", 0) for d, t in data])
    want = removed_bytes({k: t for k, (_, t) in enumerate(data)})
    got = suffix_dedup.op3_suffix_array_dedup(spark, folder).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted((tuple(x) for x in got), key=key) == sorted(((d, *want[k]) for k, (d, _) in enumerate(data)), key=key)


@pytest.mark.parametrize("salt", [2_000, 50])
def test_suffix_array_dedup_of_long_periodic_texts(spark, tmp_path, monkeypatch, salt):
    """Texts whose stretches are longer than a row may be: the period spans the places where they are split."""
    ship(spark)
    monkeypatch.setattr(suffix_dedup, "SALT_ROWS", salt)
    rng = random.Random(6)
    line, other = "0123456789abcdef\n", words(rng, 40)
    texts = [line * 12_000, "xyz" + line * 9_000 + words(rng, 300), "ab" * 70_000, words(rng, 2000), "q" * 199 + "r" * 70_300, (other + " ") * 400, "é" * 50_000]
    assert min(map(len, texts[:3])) > 2 * suffix_dedup.PIECE_BYTES
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op3_suffix_array_dedup(spark, saved(spark, tmp_path, rows)).collect()]
    assert sorted(got) == sorted((d, *x) for d, x in removed_bytes(dict(enumerate(texts))).items())


def test_common_prefixes_of_periods():
    """Long common prefixes are compared in doubled steps: the same lengths as symbol by symbol, and fast."""
    for raw in (b"ab" * 700, b"x" * 900 + b"y" + b"x" * 900, bytes(random.Random(2).choice(b"ab") for _ in range(300)) * 4):
        text = np.append(np.frombuffer(raw, np.uint8).astype(np.int64) + 1, 0)
        sa = suffix_array.suffix_array(text, 256)
        plcp = suffix_array.common_prefixes(text, sa)[1]
        for i, (a, b) in enumerate(zip(sa[:-1].tolist(), sa[1:].tolist()), 1):
            n = next((k for k in range(len(text) - max(a, b)) if text[a + k] != text[b + k]), len(text) - max(a, b))
            assert plcp[sa[i]] == n


def test_empty_tables(spark, tmp_path):
    ship(spark)
    folder = saved(spark, tmp_path, [])
    for op in (suffix_dedup.op3_suffix_array_dedup, substring_dedup.op4_substring_dedup, ngram_jaccard.op5_ngram_jaccard):
        assert op(spark, folder).count() == 0
