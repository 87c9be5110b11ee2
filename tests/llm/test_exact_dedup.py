"""Exact duplicates against brute force, and a planted hash collision."""

from __future__ import annotations

import hashlib
import time
from collections import defaultdict

from pyspark.sql import functions as F

from milepost.llm import exact_dedup
from milepost.llm.exact_dedup import exact_duplicates

WHITE = str.maketrans("", "", " \t\n\x0b\x0c\r")
SCHEMA = "doc_id long, text string, kept string, key int"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(WHITE)].append((-len(text or ""), doc_id))
    out = set()
    for body, members in groups.items():
        keep = min(members)[1]
        sha = hashlib.sha256(body.encode()).hexdigest()
        out |= {(d, keep, len(members), d == keep, sha) for _, d in members}
    return out


def test_against_brute_force(spark):
    texts = [None, "", "\n \t", "a b", "ab", " a  b ", "a b", "é́", "É", "x" * 200_000, "x " * 200_000, "ab"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA).repartition(3)
    assert {tuple(r) for r in exact_duplicates(docs).collect()} == brute(rows)
    assert exact_duplicates(docs.limit(0)).collect() == []


def test_repeated_rows_keep_one(spark):
    rows = [(5, "a", "", 1)] * 3 + [(None, "b", "", 1), (None, "b", "", 1), (6, "a", "", 1)]
    got = exact_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and sum(r.kept for r in got) == 2
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(5, 5, 4), (6, 5, 4), (None, None, 2)}


def test_rows_of_one_id_cost_no_more_than_others(spark):
    """100,000 rows without an id, half of them copies."""
    rows = spark.range(100_000).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 50_000).cast("string")).alias("text")
    )
    started = time.monotonic()
    found = exact_duplicates(rows).agg(F.count("*"), F.count_if("kept"), F.min("group_size"), F.max("group_size")).first()
    assert tuple(found) == (100_000, 50_000, 2, 2)
    assert time.monotonic() - started < 60


def test_collisions_are_told_apart(spark, monkeypatch):
    """All texts get one key: only the comparison of bytes can separate them."""
    whole = exact_dedup._digest

    def same_key(batches):
        import pyarrow as pa

        for batch in whole(batches):
            columns = batch.columns
            columns[2] = pa.array([b"k" * 16] * batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    monkeypatch.setattr(exact_dedup, "_digest", same_key)
    monkeypatch.setattr(exact_dedup.F, "md5", lambda column: exact_dedup.F.lit("6b" * 16))
    rows = [(1, "a"), (2, "a "), (3, "b"), (4, "b"), (5, "c")]
    docs = spark.createDataFrame([(d, t, "", 1) for d, t in rows], SCHEMA)
    assert {tuple(r) for r in exact_duplicates(docs).collect()} == brute(rows)
