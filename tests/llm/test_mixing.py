"""Mixing against a plain sorted version."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from milepost.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string, size int, target string"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows):
    held, docs = defaultdict(int), []
    for d, t, s, *_ in rows:
        place = int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16)
        docs.append((d, s, size(t), place))
        held[s] += size(t)
    order = sorted(held, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, free = sum(held.values()), {}, set(order)
    while free:
        rest = total - sum(target.values())
        level = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if level[s] >= 3 * held[s]}
        target |= {s: 3.0 * held[s] for s in over} if over else level
        free = free - over if over else set()
    taken = {}
    for s in order:
        times = int(target[s] // held[s]) if held[s] else 0
        rest, before, places = target[s] - times * held[s], 0, defaultdict(int)
        for _, x, n, p in docs:
            if x == s:
                places[p] += n
        for p in sorted(places):
            taken[s, p] = times + (2 * before + places[p] <= 2 * rest)
            before += places[p]
    return [(d, n, held[s], round(target[s], 6), n * taken[s, p]) for d, s, n, p in docs]


def check(spark, rows):
    found = mix(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    got = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in found]
    assert sorted(got) == sorted(brute(rows))
    assert all(t <= 3 * n for _, n, _, _, t in got)


def test_against_brute_force(spark):
    rows = [(i, "w " * (i * 7 % 50), f"s{i % 7 % 5}", 1, "x") for i in range(700)]
    rows += [(1000 + i, "v " * 9, None, 1, "x") for i in range(30)]
    rows += [(2000, None, "empty", 1, "x"), (2001, "", "Z", 1, "x"), (2002, "a b\n\tc", "Z", 1, "x")]
    check(spark, rows)


def test_hot_source_and_long_text(spark):
    rows = [(i, "w " * 5, "big", 1, "x") for i in range(400)] + [(900, "w " * 50_000, "long", 1, "x"), (901, "a b", "s", 1, "x")]
    check(spark, rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(3, "a b c", "s", 1, "x")] * 4 + [(None, "d", "s", 1, "x")] * 2
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and sum(r.taken for r in got) == 14
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
