"""Line deduplication against all pairs."""

from __future__ import annotations

import os
import random
import re
import time

from milepost.llm.line_dedup import _variants, dedup_lines
from milepost.plans.workspace import shared_root

SCHEMA = "doc_id long, text string, n_near_lines string, place string"


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, min_words=8):
    seen, out = [], {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept, exact, near = [], 0, 0
        for line in (text or "").split("\n"):
            w = re.findall(r"[^\x20\x09-\x0D]+", line)
            if not w:
                kept.append(line)
                continue
            if w in seen:
                exact += 1
            elif len(w) >= min_words and any(len(s) >= min_words and within_one(w, s) for s in seen):
                near += 1
            else:
                kept.append(line)
            seen.append(w)
        out[doc_id] = (text if text is None else "\n".join(kept), exact, near)
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, "clash", "x") for d, t in rows], SCHEMA).repartition(4)
    found = dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "place", "n_exact_lines", "n_near_lines"]
    got = {r.doc_id: (r.text, r.n_exact_lines, r.n_near_lines) for r in found.collect()}
    assert got == brute(rows)


def edited(rng, line, vocabulary):
    w, at = list(line), rng.randrange(len(line))
    kind = rng.randrange(4)
    if kind == 0:
        w[at] = rng.choice(vocabulary)
    elif kind == 1:
        del w[at]
    elif kind == 2:
        w.insert(at, rng.choice(vocabulary))
    return w


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "d"]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randrange(6, 14))] for _ in range(25)]
    rows = []
    for d in range(60):
        some = [edited(rng, rng.choice(pool), vocabulary) for _ in range(5)]
        rows.append((d, "\n".join(rng.choice([" ", "\t "]).join(w) for w in some)))
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, "short line"), (104, "short  line\nshort line\n\nend")]
    check(spark, rows)


def test_hot_line_and_long_text(spark):
    rows = [(d, f"common line in many texts of this small table\nown words {d}") for d in range(300)]
    rows += [(d, f"templated line number {d} with the same words around it here") for d in range(300, 600)]
    rows += [(700, "w " * 3_000), (701, "w " * 2_999), (702, "w " * 2_997)]
    check(spark, rows)


def test_repeated_rows_null_id_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "x y", "", ""), (1, "x y", "", ""), (1, "x y", "", "")], SCHEMA)
    assert sorted((r.doc_id or 0, r.text) for r in dedup_lines(docs).collect()) == [(0, "x y"), (1, ""), (1, "")]
    assert dedup_lines(docs.limit(0)).collect() == []


def test_a_very_long_line_with_a_near_copy(spark):
    """Time grows little faster than the length of a line: 200,000 words take seconds."""
    long = [f"w{i % 977}" for i in range(200_000)]
    near = [*long[:90_000], "other", *long[90_001:]]
    less = [*long[:150_000], *long[150_001:]]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(less)), (4, " ".join([*near, "more"]))]
    started = time.monotonic()
    docs = spark.createDataFrame([(d, t, "", "") for d, t in rows], SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_near_lines, r.text == dict(rows)[r.doc_id]) for r in dedup_lines(docs).collect()}
    assert got == {1: (0, True), 2: (1, False), 3: (1, False), 4: (1, False)}
    assert time.monotonic() - started < 60


def test_clashing_column_names(spark):
    names = ("gone_lines", "gone_id", "gone_key", "gone_exact", "__key", "doc", "doc_key", "place", "line_key", "w", "a.b")
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame([(d, "one line\nmore", *range(len(names))) for d in (1, 2)], schema)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_exact_lines", "n_near_lines"]
    assert sorted(tuple(r)[:2] for r in found.collect()) == [(1, "one line\nmore"), (2, "")]


def test_variants_are_those_of_the_shorter_lists(spark):
    def found(lists):
        rows = [(k, k, True, True, w) for k, w in enumerate(lists)]
        table = spark.createDataFrame(rows, "line_key int, place int, first boolean, last boolean, w array<string>")
        return {(r.place, r.at): tuple(r.variant) for r in _variants(table).collect()}

    for n in (8, 9, 40):
        w = [f"w{i % 5}" for i in range(n)]
        got, shorter = found([w]), found([w[:i] + w[i + 1 :] for i in range(n)])
        assert len(got) == n + 1
        assert [got[0, i] for i in range(n)] == [shorter[i, -1] for i in range(n)]


def test_only_two_tables_are_left(spark):
    docs = spark.createDataFrame([(d, f"{d} line of a few more words than eight in it", "", "") for d in range(20)], SCHEMA)
    root = shared_root(spark).removeprefix("file://")
    before = set(os.listdir(f"{root}/milepost"))
    dedup_lines(docs).collect()
    assert sorted(n.split("-")[0] for n in set(os.listdir(f"{root}/milepost")) - before) == ["line_fates", "lines"]
