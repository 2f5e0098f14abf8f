from __future__ import annotations

import math
import random

from quire.llm import secret_scan as S

HEX, B64, LOW = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789"


def ordinary_token(rng: random.Random, n: int) -> str:
    """Identifiers of words, capitals and numbers."""
    words = "get set user name value index count file path token list next last first order date time page view event build test data".split()
    out = ""
    while len(out) < n:
        w = rng.choice(words)
        out += rng.choice((w, w.capitalize(), w + str(rng.randint(1, 2030)), w.upper()))
    return out[:n]


def test_step_up_against_plain_benjamini_hochberg():
    """Thresholds from counts are those of the procedure over the list of p-values (rounded up to their steps)."""
    rng = random.Random(1)
    for _ in range(40):
        ps = {c: [10 ** -(rng.random() * rng.choice((0.5, 3, 12))) for _ in range(rng.randint(0, 40))] for c in range(8)}
        histogram: dict = {}
        for c, own in ps.items():
            for p in own:
                histogram[c, S.step(p)] = histogram.get((c, S.step(p)), 0) + 1
        got = S.discovery_steps(histogram, {c: len(own) for c, own in ps.items()})
        for c, own in ps.items():
            level = S.FDR * (c + 1) * 8 / 36
            rounded = sorted(10 ** (-S.step(p) / 4) for p in own)
            passing = [k for k, p in enumerate(rounded, 1) if p <= level * k / len(rounded)]
            want = {p for p in rounded[: max(passing, default=0)]}
            assert {10 ** (-S.step(p) / 4) for p in own if S.step(p) >= got[c]} == want


def test_combination():
    assert math.isclose(S.combined([0.3]), 0.3) and math.isclose(S.combined([0.02, 0.02, 0.02]), 0.02)
    assert 1e-40 < S.combined([1e-40, 0.5, 0.9999]) < 1e-38 and S.combined([0.9, 0.9, 0.9]) > 0.8


def test_false_discoveries_and_power():
    """Among many ordinary tokens the random ones are found, and few others."""
    rng = random.Random(5)
    random_ones = ["".join(rng.choice(a) for _ in range(n)) for a, n in ((HEX, 48), (B64, 40), (B64, 64), (LOW, 40)) for _ in range(100)]
    plain_ones = [ordinary_token(rng, rng.randint(20, 60)) for _ in range(4000)]
    histogram: dict = {}
    tested: dict = {}
    found = {}
    for t in random_ones + plain_ones:
        c = S.length_class(len(t))
        tested[c] = tested.get(c, 0) + 1
        if (b := S.battery(t)) is not None:
            found[t] = (c, S.step(b[1]))
            histogram[found[t]] = histogram.get(found[t], 0) + 1
    least = S.discovery_steps(histogram, tested)
    hit = {t for t, (c, s) in found.items() if s >= least[c]}
    assert len(hit & set(random_ones)) > 320 and len(hit & set(plain_ones)) <= 0.02 * len(hit)


def test_three_tests_count():
    """Of two tokens of the same characters, that whose classes change like a random one's has the smaller value."""
    body = "aB3dE5gH7jK9mN1pQ2sT4vW6yZ8"
    mixed, sorted_ = S.battery(body * 2), S.battery("".join(sorted(body * 2, key=lambda c: (S.class_of(c), c))))
    assert sorted_ is None or (mixed is not None and mixed[1] < sorted_[1])
