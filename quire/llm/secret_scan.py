"""Secrets: fixed patterns, and a randomness test battery over other long tokens.

Base kinds (always kept): assign, access, hex. Candidates of the battery are runs of 20 or more characters of
[A-Za-z0-9+/_-] with their = padding, so a value joined to its name by = is a candidate of its own. For each, the
encoding is inferred from the characters present (hex, base32, lower-case alphanumeric, base64 and base64url), which
fixes the alphabet that a random token would be drawn from. Three tests look for departures from randomness: chi-squared
uniformity over the alphabet, Wald-Wolfowitz runs about the alphabet's middle, and the lag-one serial correlation. A token
that one of them rejects at REJECT is ordinary. One that passes gets three p-values under the opposite hypothesis,
ordinary text: characters with the frequencies of prose and identifiers, the next one of the same class (letters of one
case, digits, marks) with a chance of STAY at least. They are the chances of a chi-squared value that small, of as many
runs of classes, and of a serial correlation that low. The three depend on each other; they are combined by their
Cauchy combination, whose tail holds under any dependence. Longer tokens can reach smaller values. Benjamini-Hochberg
control at FDR runs over the combined p-values in classes of length, each class weighted by the power its length
gives. The step-up needs counts only: a histogram of length class by p-value, of fixed size, gathered from all documents.

Null texts are empty; the empty text has no spans and the digest of an empty string. Texts are scanned whole. Spans
are in code points, end exclusive. The patterns do not overlap within a kind; a battery token that overlaps a base
span is left to it. Ties in start order by kind as listed. Repeated rows give repeated results, an empty table none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, slices

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # a run of 16 or more; a shorter one holds no longer one
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?")  # = as padding only: up to 6 of base32
HINTS = ("passw", "secret", "token", "api")
FDR, REJECT, STAY = 0.01, 1e-4, 0.8
LENGTHS = (20, 24, 32, 40, 48, 64, 96, 128, 1 << 60)  # upper edges of the length classes
STEPS = 200  # of the p-value histogram: steps of a quarter in -log10 p
ALPHABETS = (
    ("hex", "0123456789abcdef"), ("hex", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnum", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
#: Shares of letters in English text, in percent, a to z (fixed values).
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)


def ordinary(alphabet: str) -> list[float]:
    """Character shares of ordinary tokens within an alphabet: letters as in prose, capitals a tenth of them where there
    are both cases, one digit or mark in twelve."""
    both = any(c.islower() for c in alphabet)
    share = [LETTERS[ord(c.lower()) - 97] * (0.1 if both and c.isupper() else 1) if c.isalpha() else 0.8 for c in alphabet]
    return [s / sum(share) for s in share]


def class_of(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def persistence(alphabet: str, shares: list[float]) -> tuple[float, float]:
    """Of ordinary text: the chance that the next character is of another class, and the lag-one serial correlation of
    places in the alphabet (the part of their variance between classes, times how long classes last)."""
    of = [class_of(c) for c in alphabet]
    weight = [sum(q for q, k in zip(shares, of, strict=True) if k == c) for c in range(4)]
    alone = 1 - sum(w * w for w in weight)  # chance of a change of class among independent characters
    change = min(alone, 1 - STAY)
    if not alone:
        return 0.0, 0.0
    mean = sum(q * i for i, q in enumerate(shares))
    total = sum(q * (i - mean) ** 2 for i, q in enumerate(shares))
    centre = [sum(q * i for i, (q, k) in enumerate(zip(shares, of, strict=True)) if k == c) / weight[c] if weight[c] else mean for c in range(4)]
    return change, (1 - change / alone) * sum(w * (m - mean) ** 2 for w, m in zip(weight, centre, strict=True)) / total


MODELS = [(name, {c: i for i, c in enumerate(letters)}, ordinary(letters), persistence(letters, ordinary(letters))) for name, letters in ALPHABETS]


def normal_below(z: float) -> float:
    """The chance that a normal value is above z."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def combined(ps: list[float]) -> float:
    """The Cauchy combination of p-values, of whatever dependence."""
    t = sum(1 / (math.pi * p) if p < 1e-9 else math.tan((0.5 - min(p, 0.99)) * math.pi) for p in ps) / len(ps)
    return 1 / (math.pi * t) if t > 1e9 else 0.5 - math.atan(t) / math.pi


def battery(token: str) -> tuple[str, float] | None:
    """The inferred encoding and the combined p-value under ordinary text, or None where a test rejects randomness."""
    body = token.rstrip("=")
    n, present = len(body), set(body)
    name, places, shares, lasting = next((m for m in MODELS if present <= m[1].keys()), (None, None, None, None))
    if name is None or n < LENGTHS[0] or (not any(c.isdigit() for c in present) and len({c.isupper() for c in present if c.isalpha()}) < 2):
        return None  # one case of letters alone is a word in any language
    k, counts = len(places), Counter(body)
    # uniformity; the variance is that of the statistic itself, exact at any length
    chi = sum(c * c for c in counts.values()) * k / n - n
    if normal_below((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)) < REJECT:
        return None
    high = [places[c] * 2 >= k for c in body]
    up = sum(high)
    runs, down = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False)), n - up
    if not up or not down:
        return None
    mean = 1 + 2 * up * down / n
    spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    if 2 * normal_below(abs(runs - mean) / spread) < REJECT:
        return None
    x = [places[c] for c in body]
    centre = sum(x) / n
    var = sum((v - centre) ** 2 for v in x)
    serial = sum((a - centre) * (b - centre) for a, b in zip(x, x[1:], strict=False)) / var if var else 1.0
    if 2 * normal_below(abs(serial + 1 / n) * math.sqrt(n)) < REJECT:
        return None
    # under ordinary text: mean and variance of sum(c^2) k/n - n for multinomial shares
    two, three = sum(q * q for q in shares), sum(q**3 for q in shares)
    mean = k * (1 + (n - 1) * two) - n
    sd = k * math.sqrt(max(1e-9, 2 * (two - two * two) + 4 * (n - 1) * (three - two * two)) * (n - 1) / n)
    change, expected = lasting
    switches = sum(class_of(a) != class_of(b) for a, b in zip(body, body[1:], strict=False))
    ps = [normal_below((mean - chi) / sd)]
    if change:  # an alphabet of one class tells nothing by these two
        ps.append(normal_below((switches - 0.5 - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change))))
        ps.append(normal_below((expected - serial) * math.sqrt(n / (1 - expected * expected))))
    return name, max(1e-50, combined([max(p, 1e-60) for p in ps]))


def length_class(n: int) -> int:
    return next(i for i, edge in enumerate(LENGTHS[1:]) if n < edge)


def step(p: float) -> int:
    return min(STEPS - 1, int(-4 * math.log10(p)))


def candidates(text: str) -> Iterator[tuple[int, int, int, int]]:
    """start, end, length class and p-value step of the tokens that the battery takes for random."""
    for m in TOKEN.finditer(text):
        if (found := battery(m[0])) is not None:
            yield m.start(), m.end(), length_class(len(m[0])), step(found[1])


def discovery_steps(histogram: dict[tuple[int, int], int], tested: dict[int, int]) -> list[int]:
    """For each length class the least step that counts as a discovery: Benjamini-Hochberg at FDR within the class,
    at a share of the level that grows with the class's power (its length)."""
    out = []
    total = sum(range(1, len(LENGTHS)))
    for c in range(len(LENGTHS) - 1):
        level = FDR * (c + 1) * (len(LENGTHS) - 1) / total
        m, seen, least = max(1, tested.get(c, 0)), 0, STEPS
        for s in range(STEPS - 1, -1, -1):
            seen += histogram.get((c, s), 0)
            if seen and 10 ** (-s / 4) <= level * seen / m:  # all p-values in the step are at most this
                least = s
        out.append(least)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, kind, end."""
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(h in low for h in HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    return sorted(spans)


def all_spans(text: str, least: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those with the battery's."""
    base = base_spans(text)
    more = [(a, 3, b) for a, b, c, s in candidates(text) if s >= least[c] and not any(x < b and a < y for x, _, y in base)]
    return base, sorted(base + more)


def thresholds(docs: DataFrame, text_col: str = "text") -> list[int]:
    """The battery over every document, as counts of length class and step (at most 8 x 201 rows from all tasks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for _, texts in slices(batch, text_col):
                for t in texts:
                    for m in TOKEN.finditer(t.decode("utf-8", "replace")):
                        c = length_class(len(m[0]))
                        counts[c, -1] += 1
                        if (found := battery(m[0])) is not None:
                            counts[c, step(found[1])] += 1
        if counts:
            yield pa.RecordBatch.from_pydict({"c": [k[0] for k in counts], "s": [k[1] for k in counts], "n": list(counts.values())})

    rows = docs.select(text_col).mapInArrow(run, "c long, s long, n long").groupBy("c", "s").agg(F.sum("n").alias("n")).collect()
    return discovery_steps({(r.c, r.s): r.n for r in rows if r.s >= 0}, {r.c: r.n for r in rows if r.s < 0})


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, counts of the base kinds and of random tokens, digest of the base spans, all spans."""
    least = thresholds(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_col):
                found = [all_spans(t.decode("utf-8", "replace"), least) for t in texts]
                counts = [pa.array([sum(x[1] == k for x in f[1]) for f in found], pa.int64()) for k in range(4)]
                digest = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found])
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, digest, pa.array([joined(s) for _, s in found], pa.string())], names=names)

    names = [id_col, "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with each secret span replaced by [SECRET]; rows without one are unchanged, null texts stay null."""
    least = thresholds(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            out = []
            for t in batch.column(at).to_pylist():
                spans = all_spans(t, least)[1] if t else []
                out.append(masked(t, spans) if spans else t)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(out, batch.schema.field(at).type), *batch.columns[at + 1 :]], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
