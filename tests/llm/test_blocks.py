from __future__ import annotations

import random

from quire.llm import decontamination
from quire.sources.shipping import ship
from tests.llm.helpers import frame, words


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    ship(spark)
    rng = random.Random(6)
    one, two = words(rng, 30), words(rng, 25)
    texts = [(None, one + " " + two), (None, "x " + one), (None, None), (None, "other text"), (1, two), (1, two), (2, "")]
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in texts])
    items = [(7, one), (8, two), (9, " ".join(one.split()[10:])), (10, None), (None, two)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for keep in (["doc_id"], None):
        whole = decontamination.contamination(docs, bench, keep=keep)
        with monkeypatch.context() as m:
            m.setattr(decontamination, "BLOCK_WORDS", 1)
            parts = decontamination.contamination(docs, bench, keep=keep)
        assert parts.dtypes == whole.dtypes
        assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
        assert len(parts.collect()) == len(texts)
