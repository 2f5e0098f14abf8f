from __future__ import annotations

import random
from itertools import combinations

import pytest

from quire.llm.common import Words
from quire.llm.decontamination import MIN_EQUAL, SHORTEST, Seeds

ITEM = [f"w{i}" for i in range(20)]


def missed(item, cases, before="x y z ", after=" u v"):
    """The cases (places with another word) in which the item isn't found."""
    texts = [(before + " ".join("other" if i in places else w for i, w in enumerate(item)) + after).encode() for places in cases]
    found = {t for t, *_ in Seeds([3], [" ".join(item).encode()]).overlaps(Words(texts))[1]}
    return [c for i, c in enumerate(cases) if i not in found]


@pytest.mark.parametrize("n", range(5, 15))
def test_short_items_with_substitutions(n):
    for k in range(4):
        cases = list(combinations(range(n), k))
        lost = missed(ITEM[:n], cases)
        if n - k >= max(MIN_EQUAL * n, SHORTEST):
            assert not lost
        elif n < 12:
            assert lost == cases


def test_fifteen_words():
    for k in (1, 2):
        assert not missed(ITEM[:15], list(combinations(range(15), k)))
    found = Seeds([3], [" ".join(ITEM[:15]).encode()]).overlaps(Words([b"x " + " ".join([*ITEM[:3], "other", *ITEM[4:15]]).encode()]))[1]
    assert found == [(0, 3, 1, 16)]


def test_chance_is_no_hit():
    rng = random.Random(1)
    seeds = Seeds([1], [b"one two three four five six"])
    text = " ".join(rng.choice(("one", "two", "three", "four", "five", "six")) + str(rng.randint(0, 3)) for _ in range(2000))
    assert seeds.overlaps(Words([text.encode()]))[1] == []
