from __future__ import annotations

import math
import random

from quire.llm import toxicity as T
from quire.sources.shipping import ship
from tests.llm.helpers import saved


def plain_features(text: str, weight: dict[str, float], harm: set[str]) -> list[float]:
    """Clause by clause, each transducer stepped by itself."""
    clauses: list[list[str]] = [[]]
    for token in T.words_of(text):
        if token == T.CLAUSE_END:
            clauses.append([])
        elif token:
            clauses[-1].append(token)
    tokens = len(T.words_of(text))

    def known(word: str) -> tuple[int, float]:
        keys = [word] if word in weight else [f"{word[:n]}*" for n in range(1, len(word)) if f"{word[:n]}*" in weight]
        best = max(keys, key=lambda k: weight[k], default=None)
        kind = T.SEEDS.get(word, (T.W_HARM if best in harm else T.W_INSULT) if best else T.OTHER)
        return kind, weight[best] if best else T.SEED_WEIGHT if kind in (T.W_INSULT, T.W_HARM) else 0.0

    matches, sums, worded = [], [], 0
    for clause in clauses:
        states, total = [0] * len(T.PARTS), 0.0
        worded += any(t != T.QUOTE for t in clause)
        for t in clause:
            kind, w = (T.W_QUOTE, 0.0) if t == T.QUOTE else known(t)
            out = set()
            for i, part in enumerate(T.PARTS):
                states[i], o = part.step(states[i], kind)
                out.add(o)
            if out & {"insult", "threat", "harm"}:
                w *= 0.5 if "harm" in out and "threat" not in out else 1.0
                for k, f in T.FACTOR.items():
                    w *= f if k in out else 1.0
                matches.append((t, w, out))
                total += w
        sums.append(total)
    if not any(known(t)[1] for c in clauses for t in c if t != T.QUOTE):
        return [0.0] * len(T.FEATURES)
    n = len(matches)
    log = math.log1p
    return [
        log(n), log(sum(w for _, w, _ in matches)), log(max(sums)), log(sum("target" in o for *_, o in matches)), log(sum(bool(o & {"negation", "report"}) for *_, o in matches)), log(sum("threat" in o for *_, o in matches)),
        sum(s > 0 for s in sums) / max(1, worded), min(1.0, 20 * n / tokens), log(sum(w >= T.CERTAIN for _, w, _ in matches)), log(len({t for t, *_ in matches})),
    ]


def test_features_against_single_transducers():
    rng = random.Random(2)
    words = ["you", "will", "kill", "idiot", "not", "said", "very", "zork", "zorkish", "the", "table", "frab", "never", "they", "gonna", "hurt"]
    marks = [". ", "! ", "!!! ", "... ", ' "', '" ', "; ", ", "]
    weight, harm = {"zork*": 2.5, "frab": 4.0, "table": 0.5}, frozenset({"frab"})
    lexicon = T.Lexicon(weight, harm)
    for _ in range(600):
        text = "".join(rng.choice(words) + (rng.choice(marks) if rng.random() < 0.35 else " ") for _ in range(rng.randint(0, 30)))
        got, want = T.features(text, lexicon), plain_features(text, weight, set(harm))
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got, want, strict=True)), (text, got, want)


def test_marks_open_no_clause():
    share = T.FEATURES.index("share")
    assert T.features("you idiot!!!", T.Lexicon({}))[share] == T.features("you idiot!", T.Lexicon({}))[share] == 1.0


def test_harmful_verbs_are_learned(spark, tmp_path):
    """An invented verb that follows intentions is a threat, an invented name is an insult."""
    ship(spark)
    rng = random.Random(3)
    data, labels = [], []
    for d in range(500):
        bad = d % 3 == 0
        words = " ".join("".join(rng.choice("klmno") for _ in range(5)) for _ in range(20))
        data.append((d, words + (rng.choice((". I will blorgify them. ", ". such a snarfel. ")) if bad else ". ") + words, "en", "s", 0))
        labels.append((d, 1, int(bad)))
    folder = saved(spark, tmp_path, data, labels=(labels, "doc_id long, quality int, toxic int"))
    model = T.train(spark.read.parquet(f"{folder}/documents.parquet"), T.labels_of(spark, folder))
    assert "blorgify" in model.harm and "snarfel" in model.learned and "snarfel" not in model.harm
    assert T.features("we will blorgify you", T.Lexicon(model.learned, model.harm))[T.FEATURES.index("threats")] > 0


def test_awkward_labels(spark, tmp_path):
    """Labels of no document, repeated or missing ids and null marks; an empty table."""
    ship(spark)
    rows = [(None, "text", "en", "s", 0), (1, None, "en", "s", 0), (1, None, "en", "s", 0)]
    folder = saved(spark, tmp_path, rows, labels=([(None, 1, 1), (1, None, None), (9, 0, 1), (9, 0, 1)], "doc_id long, quality int, toxic int"))
    assert T.op1_toxicity(spark, folder).count() == 3
    folder = saved(spark, tmp_path, [], labels=([], "doc_id long, quality int, toxic int"))
    assert T.op1_toxicity(spark, folder).count() == 0
