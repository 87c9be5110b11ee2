"""Quality rules against plain loops."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from math import log2, sqrt

import pytest

from milepost.llm.quality import CLASSES, quality
from milepost.llm.quality import base as base_rows

SCHEMA = "doc_id long, text string, lang string, kept string, share int"
WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    w = re.findall(WORD, text or "")
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(WORD, line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def classes(text):
    n = {c: sum(map(len, re.findall(p, text))) for c, p in CLASSES.items()}
    chars = sum(map(len, re.findall(WORD, text)))
    return {**n, "plain": chars - sum(n.values()), "space": len(text) - chars}


def distance(p, q):
    total = 0.0
    for k in p.keys() | q.keys():
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        total += (a * log2(2 * a / (a + b)) if a else 0) + (b * log2(2 * b / (a + b)) if b else 0)
    return sqrt(max(total / 2, 0))


def brute(rows, vocabulary=50):
    shapes, tokens = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang in rows:
        if not base(text)[-1]:
            shapes[lang].update(classes(text))
        tokens[lang].update(w.lower() for w in re.findall(WORD, text or ""))
    out = []
    for doc_id, text, lang in rows:
        row, text = base(text), text or ""
        top = dict(sorted(tokens[lang].items(), key=lambda x: (-x[1], x[0]))[:vocabulary])
        total = sum(tokens[lang].values())
        q = {w: c / total for w, c in top.items()}
        q[None] = 1 - sum(q.values())
        own = Counter(w if w in top else None for w in (x.lower() for x in re.findall(WORD, text)))
        by_word = distance({w: c / row[0] for w, c in own.items()}, q) if row[0] else None
        shape, of = classes(text), shapes[lang]
        by_class = None
        if text and sum(of.values()):
            by_class = distance(
                {k: v / len(text) for k, v in shape.items()}, {k: v / sum(of.values()) for k, v in of.items()}
            )
        odd = (len(text) >= 200 and (by_class or 0) > 0.30) or (row[0] >= 50 and (by_word or 0) > 0.48)
        out.append((doc_id, *row, not row[-1] and not odd, by_class, by_word))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in quality(docs).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [r[:8] for r in got] == [r[:8] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[8:] == pytest.approx(w[8:], abs=1e-9)
    return {r[0]: r[7] for r in got}


def test_prose_junk_and_edges(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "the of and to in is was with".split() for b in ("", "", "er", "tion")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    rows = [(i, "\n".join(prose(rng.randrange(20, 60)) for _ in range(4)), "en") for i in range(60)]
    rows += [(100, " ".join(w + "***" for w in prose(120).split()), "en"), (101, " | ".join(prose(120).split()), "en")]
    rows += [(102, "one two three " * 40, "en"), (103, None, "en"), (104, "", None), (105, " \t\n", "xx")]
    rows += [(106, prose(49), "en"), (107, prose(60) + "\nsame\nsame\n\n \n", None), (108, "É日本 " * 70, "fr")]
    rows += [(109, prose(20_000), "en"), (110, "a b", "lonely")]
    kept = check(spark, rows)
    assert kept[0] and not kept[100] and not kept[102] and not kept[103]


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "the quick brown fox jumps over the lazy dog and runs on " * 2 + " ".join(f"w{i}" for i in range(60))
    check(spark, [(7, text, "en")] * 3 + [(None, text, "en"), (7, "other " + text, "en"), (8, None, None)])
    assert quality(spark.createDataFrame([], SCHEMA)).collect() == []


def test_only_what_has_a_class_is_gone_through_for_each(spark):
    """Every class went through the whole text, and every text's windows were sorted."""
    rows = [(1, "plain words only " * 3, "en"), (2, "A1é#! \x0b~b\x00\x1cÀ" * 2, "en")]
    plan = base_rows(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(text#") == 1 and plan.count("array_distinct(") == 2  # of lines, of windows
    check(spark, rows)


def test_a_text_alone_in_its_language_has_no_distance(spark):
    """Sums of shares in another order than their total's left 8e-9."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(90 + i)), f"l{i}") for i in range(40)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    assert {r.word_distance for r in quality(docs).collect()} == {0.0}
