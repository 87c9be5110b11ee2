"""Held-out accuracy, defined results for edge cases, and what must not be learned from."""

from __future__ import annotations

import random
import zlib

import pytest

from milepost.llm.toxicity import Meter, fit_rows, toxicity

SCHEMA = "doc_id long, text string, lang string, score string, held_out int"
SYLLABLES = "an er in on the tion re st en ha".split()
BAD = ["vexgrunt", "zulbraff", "quomptig"]


def text(rng, toxic):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(40, 160))]
    if toxic:
        for _ in range(rng.randrange(1, 5)):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
    return " ".join(words)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    toxic = {i: int(rng.random() < 0.25) for i in range(1200)}
    rows = [(i, text(rng, t), "xx", "clash", 1) for i, t in toxic.items()]
    rows += [(5000, None, None, "", 1), (5001, "", None, "", 1), (5002, "the an " * 60_000, None, "", 1)]
    rows += [(5003, "x", "", "", 1)] * 2 + [(None, "y", "", "", 1)]
    labels = [(i, t) for i, t in toxic.items()] + [(None, 1), (7, None), (99_999, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int"), toxic


def test_held_out_accuracy_and_edges(tables):
    docs, labels, toxic = tables
    got = toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 4 == 2)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    hits = [r.predicted for r in held if toxic[r.doc_id]]
    alarms = [r.predicted for r in held if not toxic[r.doc_id]]
    assert sum(hits) >= 0.9 * len(hits) and sum(alarms) <= 0.05 * len(alarms)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[5000] == by_id[5001]


def test_held_out_labels_change_nothing(tables):
    from pyspark.sql import functions as F

    docs, labels, _ = tables
    flipped = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    some = docs.where("doc_id < 60")
    scores = [{r.doc_id: r.score for r in toxicity(docs, x).where("doc_id < 60").collect()} for x in (labels, flipped)]
    assert scores[0] == scores[1] and len(scores[0]) == some.count()


def test_without_labels_or_documents(tables):
    docs, labels, _ = tables
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity(docs.limit(0), labels).collect() == []


def test_windows_are_cut_anywhere_without_spaces():
    meter = Meter(b"ordinary text " * 10, b"vexgrunt zulbraff ")
    assert len(meter.features("x" * 10_000)) == len(meter.features("")) == 10
    assert fit_rows([], ["a"] * 9, 0.0).prior == 0.0
