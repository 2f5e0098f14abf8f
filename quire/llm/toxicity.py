"""Toxicity by a weighted finite-state grammar over clauses.

Four transducers read a clause's words, each written as arcs (state, word class) -> (state, weight class):
  insult    an insulting word opens a match; intensifiers before it strengthen it
  threat    an intention followed by a harmful verb
  target    a person addressed or named in the clause
  negation  "not", "never" ... turn what follows within NEAR words
  report    verbs of saying and quotation marks: the match is someone else's
Their product is built once (reachable states only) and run over the classes of a clause's words. A match's weight is
the word's learned weight, turned by the factors of the state it is met in; a clause counts by its matches, never a
word without a clause. A document's features (sums and maxima of clause weights by kind, share of such clauses) go
through a logistic function.

Weights come from labels: of words and word beginnings in at most SAMPLE labelled rows (by hash order, so no property of
a row decides), and of the features on the same rows. Every word whose likelihood ratio is significant is kept; one that
in most of its toxic rows comes after a word of intention is a harmful verb, the others are insults. The factors of
target, negation, report and strength are fixed (FACTOR); how much they matter is learned with the features. Held-out rows (crc32 of the id's digits
divisible by five) never take part. The seed lists are English; other languages' words are learned.

Null and empty texts have no clause: their score is the intercept's. Repeated rows have equal scores; extra columns are
left out; with no labels the seed weights alone decide. Long texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, slices, written

#: Rows of label 0 and 1 that are learned from: a bound on what the driver holds.
SAMPLE = (12_000, 4_000)
LEAST_G = 30.0  # of the likelihood-ratio statistic for a learned word: chance words of a large vocabulary stay below
#: Seed words of the classes (fixed values).
INSULT = "idiot moron stupid loser scum trash clown pathetic worthless disgusting dumb fool jerk garbage filthy vermin imbecile coward liar creep".split()
INTENT = "will gonna shall going want should must".split()
HARM = "kill hurt beat destroy shoot stab burn crush attack strangle punish hunt".split()
TARGET = "you your yours youre he she him her they them their u du ihr dein tu vous ton votre usted tus".split()
NEGATION = "not no never isnt arent dont doesnt wasnt neither nor nicht kein nie ne pas jamais nunca".split()
REPORT = "said says claimed called wrote reported according quote quoted alleged sagte dit dijo".split()
STRONG = "very so such really complete absolute utter total fucking damn".split()
OTHER, W_INSULT, W_INTENT, W_HARM, W_TARGET, W_NEGATION, W_REPORT, W_STRONG, W_QUOTE = range(9)
SEEDS = {w: c for c, words in ((W_INSULT, INSULT), (W_INTENT, INTENT), (W_HARM, HARM), (W_TARGET, TARGET), (W_NEGATION, NEGATION), (W_REPORT, REPORT), (W_STRONG, STRONG)) for w in words}
NEAR = 4  # words that a negation or an intensifier reaches
SEED_WEIGHT = 3.0
CLAUSE_END, QUOTE = "\x01", "\x02"
#: Characters: clause ends, quotation marks, letters; what else stands between words.
_MARKS = {c: f" {CLAUSE_END} " for c in ".!?;:\n\r…"} | {c: f" {QUOTE} " for c in '"“”«»„'} | {c: "" for c in "'’"} | {c: " " for c in ",()[]{}<>|/\\*_#~-\t=+&%$@0123456789"}
_MARKED = frozenset(_MARKS)


class Transducer:
    """arcs: {(state, class): (state, output)}; a missing arc stays and puts out nothing."""

    def __init__(self, arcs: dict[tuple[int, int], tuple[int, str]]):
        self.arcs = arcs

    def step(self, state: int, symbol: int) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (state, ""))


def countdown(opens: int, reach: int, output: str) -> Transducer:
    """After a word of class `opens`, the next `reach` words are marked with `output`."""
    arcs = {}
    for s in range(reach + 1):
        for c in range(9):
            arcs[s, c] = (reach, "") if c == opens else (max(0, s - 1), output if s else "")
    return Transducer(arcs)


INSULTS = Transducer({(0, W_INSULT): (0, "insult")})
THREATS = Transducer({(0, W_INTENT): (1, ""), (1, W_HARM): (0, "threat"), (0, W_HARM): (0, "harm")})
TARGETS = Transducer({(0, W_TARGET): (1, ""), (1, W_INSULT): (1, "target"), (1, W_HARM): (1, "target")})
#: States: 0 own words, 1 after a verb of saying, 2 within quotation marks.
REPORTS = Transducer({(0, W_REPORT): (1, ""), (0, W_QUOTE): (2, ""), (1, W_QUOTE): (2, ""), (2, W_QUOTE): (0, "")} | {(s, c): (s, "report") for s in (1, 2) for c in (W_INSULT, W_HARM)})
PARTS = (INSULTS, THREATS, TARGETS, countdown(W_NEGATION, NEAR, "negation"), REPORTS, countdown(W_STRONG, 2, "strong"))


def composed() -> tuple[list[list[int]], list[list[frozenset[str]]]]:
    """The product of PARTS: next state and outputs by (state, class), over the states that can be reached."""
    start = (0,) * len(PARTS)
    number, queue, nexts, outs = {start: 0}, [start], [], []
    for state in queue:
        row, out = [], []
        for c in range(9):
            steps = [p.step(s, c) for p, s in zip(PARTS, state, strict=True)]
            to = tuple(s for s, _ in steps)
            if to not in number:
                number[to] = len(queue)
                queue.append(to)
            row.append(number[to])
            out.append(frozenset(o for _, o in steps if o))
        nexts.append(row)
        outs.append(out)
    return nexts, outs


NEXT, OUT = composed()
FACTOR = {"negation": 0.3, "report": 0.4, "target": 1.5, "strong": 1.3}
FEATURES = ("matches", "weight", "strongest", "targeted", "turned", "threats", "share", "dense", "certain", "different")
CERTAIN = 3.0  # weight of a word that alone tells much


class Lexicon(dict):
    """word -> (class, weight), with learned words and word beginnings (those in `harm` are harmful verbs, the others
    insults); remembers what it has looked up."""

    def __init__(self, learned: dict[str, float], harm: frozenset[str] = frozenset()):
        super().__init__()
        self.learned, self.harm = learned, harm
        self.sizes = sorted({len(k) - 1 for k in learned if k.endswith("*")})

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) > 400_000:
            self.clear()
        own = [word] if word in self.learned else [k for n in self.sizes if len(word) > n and (k := word[:n] + "*") in self.learned]
        best = max(own, key=self.learned.__getitem__, default=None)
        weight = self.learned[best] if best else 0.0
        kind = SEEDS.get(word, (W_HARM if best in self.harm else W_INSULT) if weight else OTHER)
        found = (kind, weight or (SEED_WEIGHT if kind in (W_INSULT, W_HARM) else 0.0))
        self[word] = found
        return found


def words_of(text: str) -> list[str]:
    text = text.lower()
    for c in _MARKED.intersection(text):  # only those that occur: a table for every character takes ten times as long
        text = text.replace(c, _MARKS[c])
    return text.split(" ")


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Of one document, in the order of FEATURES."""
    tokens = words_of(text)
    kinds = [lexicon[t] for t in tokens]
    if not any(k[1] for k in kinds):
        return [0.0] * len(FEATURES)
    clauses, matched = 0, 0
    worded = False  # whether the clause has any word: a row of marks opens none
    n = total = strongest = targeted = turned = threats = certain = 0.0
    different = set()
    state, clause = 0, 0.0
    for token, (kind, weight) in zip([*tokens, CLAUSE_END], [*kinds, (OTHER, 0.0)], strict=True):
        if token == CLAUSE_END:
            clauses += worded
            matched += clause > 0
            strongest = max(strongest, clause)
            state, clause, worded = 0, 0.0, False
            continue
        if not token:
            continue
        worded = worded or token != QUOTE
        symbol = W_QUOTE if token == QUOTE else kind
        out = OUT[state][symbol]
        state = NEXT[state][symbol]
        if "insult" in out or "threat" in out or "harm" in out:
            w = weight * (0.5 if "harm" in out and "threat" not in out else 1.0)
            for k, f in FACTOR.items():
                if k in out:
                    w *= f
            n += 1
            certain += w >= CERTAIN
            different.add(token)
            total += w
            clause += w
            targeted += "target" in out
            turned += "negation" in out or "report" in out
            threats += "threat" in out
    return [math.log1p(n), math.log1p(total), math.log1p(strongest), math.log1p(targeted), math.log1p(turned), math.log1p(threats), matched / max(1, clauses), min(1.0, 20 * n / len(tokens)), math.log1p(certain), math.log1p(len(different))]


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text and y of at most SAMPLE training rows of the labels; their ids (bounded) are broadcast.

    Of labels that differ for an id the greater counts; of documents that share an id one is read, that of the least hash.
    """
    train = labels.where(~held_out(id_col)).where(F.col("toxic").isin(0, 1)).groupBy(id_col).agg(F.max("toxic").alias("y"))
    picked = None
    for y in (0, 1):
        some = train.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE[y])
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(picked), id_col)
    one = F.min_by(F.struct("text", "y"), F.struct(F.xxhash64("text"), "text")).alias("r")
    return written(texts.groupBy(id_col).agg(one).select("r.text", "r.y"))


def after_intent(tokens: list[str]) -> set[str]:
    """The words that come right after a word of intention, or one word later."""
    words = [t for t in tokens if t and t not in (CLAUSE_END, QUOTE)]
    marked = [SEEDS.get(w) == W_INTENT for w in words]
    return {w for k, w in enumerate(words) if any(marked[max(0, k - 2) : k])}


def learn_words(sample: DataFrame) -> tuple[dict[str, float], frozenset[str]]:
    """Weights of words and beginnings ("abcd*") that mark toxic rows, by log odds of their document frequencies, and
    those of them that mostly follow a word of intention. As many as the rows of the bounded sample make significant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter, Counter] = (Counter(), Counter(), Counter())
        for batch in batches:
            for part, texts in slices(batch, "text"):
                for t, y in zip(texts, part.column(1).to_pylist(), strict=True):
                    tokens = words_of(t.decode("utf-8", "replace"))
                    parted = lambda ws: ws | {w[:n] + "*" for w in ws for n in (3, 4, 5, 6) if len(w) > n and w not in SEEDS}
                    seen[y].update(parted({w for w in tokens if len(w) >= 3}))
                    if y == 1:
                        seen[2].update(parted({w for w in after_intent(tokens) if len(w) >= 3}))
        for y in (0, 1, 2):
            if seen[y]:
                yield pa.RecordBatch.from_pydict({"w": list(seen[y]), "y": [y] * len(seen[y]), "n": list(seen[y].values())})

    size = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    if not size.get(0) or not size.get(1):
        return {}, frozenset()
    count = lambda y, name: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(name)
    df = sample.mapInArrow(run, "w string, y long, n long").groupBy("w").agg(count(1, "a"), count(0, "b"), count(2, "c"))
    odds = F.log(((F.col("a") + 0.5) / (size[1] + 1)) / ((F.col("b") + 0.5) / (size[0] + 1)))
    share = size[1] / (size[0] + size[1])
    both = F.col("a") + F.col("b")
    g = 2 * (F.col("a") * F.log(F.col("a") / (both * share)) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / (both * (1 - share)))).otherwise(0.0))
    rows = df.where("a > 0").withColumn("o", odds).where("o > 1.8").where(g > LEAST_G).collect()
    return {r.w: min(6.0, r.o) for r in rows}, frozenset(r.w for r in rows if 2 * r.c > r.a)


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, learned: dict[str, float], weights: np.ndarray, harm: frozenset[str] = frozenset()):
        self.learned, self.weights, self.harm = learned, weights, harm

    def score(self, found: list[float]) -> float:
        z = float(np.dot(self.weights[:-1], found) + self.weights[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


DEFAULT = np.array([0.5, 0.5, 0.5, 0.5, -1.0, 1.0, 1.0, 1.0, 1.0, 0.5, -3.0])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    sample = sampled(docs, labels, id_col, text_col)
    learned, harm = learn_words(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(learned, harm)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array([features(t.decode("utf-8", "replace"), lexicon) for t in texts], pa.list_(pa.float64())), part.column(1).cast(pa.int64())], names=["x", "y"])

    rows = sample.mapInArrow(run, "x array<double>, y long").collect()  # at most sum(SAMPLE) rows of ten numbers
    y = np.array([r.y for r in rows])
    if len(set(y.tolist())) < 2:
        return Model(learned, DEFAULT, harm)
    return Model(learned, fit(np.array([r.x for r in rows]), y), harm)


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) with score, n_matches and predicted."""
    keep = [c for c in keep or docs.columns if c.lower() not in ("score", "n_matches", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.learned, model.harm)
        for batch in batches:
            for part, texts in slices(batch, text_col):
                found = [features(t.decode("utf-8", "replace"), lexicon) for t in texts]
                score = [model.score(f) for f in found]
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                cols += [pa.array(score, pa.float64()), pa.array([round(math.expm1(f[0])) for f in found], pa.int64()), pa.array([int(s >= 0.5) for s in score], pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "score", "n_matches", "predicted"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", score double, n_matches long, predicted int"
    return docs.select(*keep, *([] if text_col in keep else [text_col])).mapInArrow(run, schema)


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = scored(docs, train(docs, labels_of(spark, sf_dir)), keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "n_matches")
