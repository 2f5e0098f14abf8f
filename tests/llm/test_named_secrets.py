from __future__ import annotations

import random
import string

import pytest

from quire.llm import secret_scan

RNG = random.Random(12)
VALUE = "".join(RNG.choice(string.ascii_letters + string.digits) for _ in range(40))
BASE32 = "".join(RNG.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(26)) + "======"


@pytest.mark.parametrize("before", ["AWS_ACCESS_KEY_VALUE=", "https://h.example/a?sig=", "run --signature=", "a_very_long_variable_name=b=", ""])
@pytest.mark.parametrize("value", [VALUE, VALUE + "==", BASE32])
def test_value_is_tested_apart_from_its_name(before, value):
    spans = [s for s in secret_scan.all_spans(f"x {before}{value} y", [0] * 8)[1] if s[1] == 3]
    a = 2 + len(before)
    assert (a, 3, a + len(value)) in spans


def test_marks_are_no_padding():
    assert [m[0] for m in secret_scan.TOKEN.finditer(VALUE + "=" * 20 + " " + VALUE + "=x")] == [VALUE, VALUE]
