"""Small tables with awkward rows, and plain-Python versions to hold the operators against."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus(seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, repeats inside a text, nulls, empty, blank and long texts."""
    rng = random.Random(seed)
    passage = words(rng, 70)
    base = [words(rng, n) for n in (3, 40, 120, 200, 60)]
    texts = [*base, base[2], base[2], base[3] + " tail", "x " + base[3], words(rng, 20) + " " + passage + " " + words(rng, 5), passage, words(rng, 9) + "\n" + passage, None, "", "   \n", "ab " * 300, "a" * 700, words(rng, 30) * 12, None, words(rng, 4000)]
    near = base[3].split()
    near[50] = "changed"
    texts += [" ".join(near), base[4] + " " + base[4] + " " + base[4]]
    return [(i, t, "en", f"s{i % 3}", len(t) if t else 0) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def saved(spark, tmp_path, rows, **tables) -> str:
    """A folder with documents and other tables."""
    frame(spark, rows).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
