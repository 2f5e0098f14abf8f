from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.llm.helpers import corpus, saved, words

pipeline = pytest.importorskip("corpus_pipeline")


def test_pipeline_against_plain_steps(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    from quire.llm import bpe

    rng = random.Random(12)
    item = words(rng, 30)
    rows = [r for r in corpus(3)]
    rows += [(100, words(rng, 30) + " " + item, "en", "s", 0), (101, words(rng, 30) + '\ntoken = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ok', "en", "s", 0)]
    rows += [(200 + k, words(rng, 25) + (f". You are a stupid {rng.choice(('idiot', 'moron', 'clown'))}, you pathetic loser. " if k % 3 == 0 else ". ") + words(rng, 9), "en", "s", 0) for k in range(90)]
    labels = [(d, 1, int(d >= 200 and (d - 200) % 3 == 0)) for d, *_ in rows]
    folder = saved(spark, tmp_path, rows, benchmark=([(7, item)], "item_id long, text string"), labels=(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in pipeline.run(spark, folder).collect()}
    # plain steps: planted toxic rows go, one of each near-equal group stays, the leak goes, the secret is masked
    left = [(d, t) for (d, t, *_), (_, _, y) in zip(rows, labels) if not y]
    kept: list[tuple] = []
    groups: dict[int, int] = {}

    def shingles(t):
        w = (t or "").encode().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {d: shingles(t) for d, t in left}
    root = {d: d for d in sets}
    for d, t in left:
        for e, u in left:
            if e < d and ((t or "") == (u or "") or (sets[d] and sets[e] and len(sets[d] & sets[e]) >= 0.8 * len(sets[d] | sets[e]))):
                a, b = root[d], root[e]
                root = {x: min(a, b) if r in (a, b) else r for x, r in root.items()}
    kept = [(d, t) for d, t in left if root[d] == d and d != 100]
    groups |= root
    ref = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    want = {}
    for d, t in kept:
        if d == 101:
            t = t[: t.index("token =")] + "[SECRET]" + t[t.index("f962") + 4 :]
        else:
            t = re.sub("[0-9a-f]{32,}", "[SECRET]", t or "")
        ids = ref.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert got == want


def test_stages():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "secrets", "bpe"] and pipeline.ORACLE_SQL is None


def awkward(spark, rows):
    """documents with columns named as those that the operators make."""
    from pyspark.sql import functions as F

    from tests.llm.helpers import SCHEMA

    names = ("score", "Predicted", "n_matches", "n_hits", "found", "items", "spans", "kind", "first", "sha", "doc", "block", "group", "h", "n_tokens", "ids")
    return spark.createDataFrame(rows, SCHEMA).withColumns({n: F.concat(F.lit(f"{n} of "), F.coalesce("doc_id", F.lit(-1))) for n in names})


def test_stages_keep_awkward_rows_and_columns(spark, tmp_path):
    """Missing and shared ids, null, empty, repeated and very long texts, and columns of the operators' names."""
    from quire.sources.shipping import ship

    ship(spark)
    rng = random.Random(13)
    long = words(rng, 60_000)
    rows = [(None, None, None, None, None), (None, "some text here", None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "another text there", "en", "s", 5), (2, "a third one " * 9, "en", "s", 5), (3, long, "en", "s", 9), (4, long + " tail", "en", "s", 9)]
    docs = awkward(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "text some here or there in the item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = {"toxicity": len(rows), "ngram_jaccard": 5, "decontamination": len(rows), "secrets": len(rows), "bpe": len(rows)}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        got = out.collect()
        assert len(got) == want[name], name
        if name != "bpe":
            assert out.dtypes == docs.dtypes
            mine = {str(r.asDict() | {"n_chars": 0}) for r in docs.collect()}
            assert {str(r.asDict() | {"n_chars": 0}) for r in got} <= mine, name
    assert pipeline.run(spark, str(tmp_path)).count() == 5


def test_pipeline_of_empty_tables(spark, tmp_path):
    awkward(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
