"""The grouping suffix array against sorted suffixes."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from milepost.llm.lyndon import suffix_array


def check(symbols):
    order = suffix_array(symbols)
    assert sorted(order) == list(range(len(symbols)))

    def key(i):
        end = symbols.index(0, i) if 0 in symbols[i:] else len(symbols)
        return symbols[i:end]

    keys = [key(i) for i in order]
    assert keys == sorted(keys)


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_one_text(symbols):
    check(symbols)
    check([*symbols, 0])


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_texts_with_separators(symbols):
    check(symbols)


def test_runs_and_periods():
    check([1] * 300)
    check([2, 1] * 100)
    check([1, 1, 2] * 70 + [0] + [1, 2] * 50)
    rng = random.Random(3)
    check([rng.randrange(300) for _ in range(2_000)])
