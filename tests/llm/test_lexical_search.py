"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from milepost.llm import lexical_search as module
from milepost.llm.lexical_search import Chunk, ranked_search, term_counts

DOCS, ITEMS = "doc_id long, text string, item_id string, term int", "item_id long, text string, doc_id int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def brute(docs, items):
    counted = [(i, Counter(terms(text))) for i, text in docs]
    n_docs = sum(bool(c) for _, c in counted)
    total = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 90 + (90 * c.total() * n_docs) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:10], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, **how):
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], DOCS).repartition(4)
    i = spark.createDataFrame([(*r, 1) for r in items], ITEMS)
    found = ranked_search(d, i, **how)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items)


def corpus(rng, n):
    words = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for i in range(n)], words


def test_against_all_documents(spark, monkeypatch):
    rng = random.Random(2)
    docs, words = corpus(rng, 500)
    items = [(i, " ".join(rng.sample(words, rng.randrange(1, 30)))) for i in range(25)]
    check(spark, docs, items)
    monkeypatch.setattr(module, "CHUNK_POSTINGS", 300)
    check(spark, docs, items, block_terms=40)


def test_ties_hot_terms_repeated_rows_and_null_ids(spark):
    docs = [(i, "the same words") for i in range(40)] + [(7, "the same words"), (None, "the same words"), (None, None)]
    docs += [(50, ""), (51, None), (52, "!!! \x7f\n"), (53, "Ärger über Öl, ÜBER x2"), (54, "über")]
    docs += [(i, f"filler{i}") for i in range(60, 160)]
    items = [(1, "the same words"), (1, "the same words"), (2, None), (3, "unknown"), (4, "Über über ärger X2"), (None, "SAME")]
    check(spark, docs, items)


def test_long_text(spark, monkeypatch):
    monkeypatch.setattr(module, "PIECE", 100)
    long = " ".join(f"w{i % 300}" for i in range(50_000)) + " " + "x" * 1_000
    assert term_counts(long) == Counter(w.encode() for w in terms(long))
    check(spark, [(1, long), (2, "w1 w2"), (3, "none")], [(1, "w1 w2 w299"), (2, "x" * 1_000)])


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "a", "", 1)], DOCS)
    assert ranked_search(docs, items).collect() == []
    assert ranked_search(one, items).collect() == []
    assert ranked_search(docs, spark.createDataFrame([(1, "a", 1)], ITEMS)).collect() == []


def test_accumulators_stop():
    """A rare term that ten documents hold leaves no room for those that hold only the common one."""
    n = np.full(1_000, 50)
    terms_of = [[0, 1] if i < 12 else [1] for i in range(1_000)]
    flat = np.array([t for own in terms_of for t in own])
    chunk = Chunk(
        np.arange(1_000), np.zeros(1_000, bool), n, np.array([len(o) for o in terms_of]), flat, np.ones(len(flat), np.int64),
        np.array([4_000, 10]), 1_000, 50_000,
    )
    docs, scores, made = chunk.search(np.array([0, 1]), 10)
    assert made == 12 and docs.tolist() == list(range(10)) and len(set(scores)) == 1
    assert chunk.search(np.array([1]), 10)[2] == 1_000
