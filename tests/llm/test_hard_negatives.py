"""Hard negatives against plain sorting of all scores."""

from __future__ import annotations

import math
import random

import numpy as np

from milepost.llm import hard_negatives as module
from milepost.llm.hard_negatives import _Block, _bounds, hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, row string, dim int"


def brute(rows):
    part = []
    for k, (i, label, x) in enumerate(rows):
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        part.append((k, i, label, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = []
    for k, i, label, a in part:
        if i is None or i % 50:
            continue
        scored = [
            (-sum(p * q for p, q in zip(a, v)), math.inf if j is None else j, m == label)
            for n, j, m, v in part
            if n != k and len(v) == len(a)
        ]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(i, positive, r, s[1], -p, -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out)


def check(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    found = hard_negatives(table)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(tuple(math.inf if c is None else c for c in r) for r in found.collect())
    assert got == brute(rows)


def vectors(rng, n, dim=24, spread=0.6):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    return [(i, rng.randrange(10), [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


def test_against_all_scores(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE_CELLS", 24 * 64)
    monkeypatch.setattr(module, "BLOCK", 3)
    check(spark, vectors(random.Random(3), 600))


def test_hot_label_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE_CELLS", 256)
    rng = random.Random(4)
    rows = [(i, 3 if i % 3 else i % 10, [float(rng.randrange(-1, 2)) for _ in range(4)]) for i in range(300)]
    check(spark, rows + rows[:60])


def test_nulls_lengths_and_large_values(spark):
    rows = vectors(random.Random(5), 120, dim=3)
    rows += [(None, 1, [1.0, 2.0, 3.0]), (200, None, [1.0, 1.0, 1.0]), (250, 1, None), (300, 2, [1.0, None, 0.0])]
    rows += [(350, 2, [math.nan, 0.0, 0.0]), (400, 2, [math.inf, 0.0, 0.0]), (450, 2, []), (451, 2, []), (452, 3, [])]
    rows += [(500, 4, [1.0]), (501, 4, [2.0]), (502, 5, [1.5]), (503, 5, [-1.0])]
    rows += [(550, 6, [3e6] * 2), (551, 6, [2e6] * 2), (552, 7, [1.5e6] * 2), (553, 7, [1.4999e6] * 2)]
    rows += [(600, 8, [0.5] * 3000), (601, 8, [0.25] * 3000), (602, 9, [0.2] * 3000)]
    check(spark, rows)


def test_empty_table(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bounds_hold_and_narrow():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    v = rng.integers(-300, 300, (200, 50))
    table = pa.table({"row": range(200), "vec_id": range(200), "label": [0] * 200, "v": v.tolist()})
    block, rows = _Block(table, 50), np.arange(200)
    exact, width = v @ v[7], np.inf
    for level in range(len(block.levels)):
        low, high = _bounds(block, 7, block, rows, level)
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() < width
        width = (high - low).mean()
