"""Exact duplicates by a 128-bit content hash, with a byte check inside groups."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import SPACE, saved

_WHITE = b" \t\n\x0b\x0c\r"
_DIGESTS = "doc_id long, n_points long, key binary, text_sha256 string"


def _digest(batches):
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        keys, shas = [], []
        for value in texts.cast(pa.large_binary()):
            kept = value.as_py().translate(None, _WHITE)
            keys.append(hashlib.md5(kept, usedforsecurity=False).digest())
            shas.append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pc.utf8_length(texts).cast(pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(shas, pa.string()),
            ],
            ["doc_id", "n_points", "key", "text_sha256"],
        )


def _groups(rows: DataFrame, *keys: str) -> DataFrame:
    """Size of each group and its row that stays: most code points, then smallest id."""
    best = F.min(F.struct(-F.col("n_points"), F.col("doc_id"), F.col("row")))
    return rows.groupBy(*keys).agg(best.alias("best"), F.count("*").alias("group_size"))


def _decide(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    return rows.join(groups, list(keys)).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if identical after deleting white space; a null text counts as empty, and
    all empty texts form one group. Of a group the row with the most code points in the
    original text stays, then the one with the smallest ``doc_id`` (null first); of fully
    repeated rows exactly one. An empty table gives no rows; other columns are ignored.

    Rows are grouped by the MD5 of the remaining bytes; only the digests are shuffled for that,
    and each task sends one row per hash. Then the bytes of texts that share a hash are compared.
    Rows whose hash stands for several texts are grouped again, by the SHA-256 of each text, so a
    collision never merges different texts. No rows meet by their ``doc_id``: many rows of one
    id, null too, cost no more than others.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = saved(
        texts.mapInArrow(_digest, _DIGESTS).withColumn("row", F.monotonically_increasing_id()), "digests"
    )
    copied = _groups(rows, "key").where("group_size > 1").select("key")
    # The texts of copies only, found by their hash: how many different ones does a hash stand for? A
    # task hands on one body of each, so many copies of a text are few rows.
    kept = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, "")
    bodies = texts.select(kept.alias("body")).select(
        F.unhex(F.md5(F.col("body").cast("binary"))).alias("key"), F.sha2("body", 256).alias("text_sha256"), "body"
    )
    different = bodies.join(copied, "key", "left_semi").groupBy("key", "text_sha256", "body").agg(F.count("*").alias("n"))
    collided = saved(different.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "collisions")
    even, odd = (rows.join(collided, "key", how) for how in ("left_anti", "left_semi"))
    return _decide(even, _groups(even, "key"), "key").unionByName(
        _decide(odd, _groups(odd, "key", "text_sha256"), "key", "text_sha256")
    )
