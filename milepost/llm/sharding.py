"""Shards on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.llm.common import saved

#: The ring is cut into this many arcs; keys of one arc move together.
ARC_BITS = 16
ARCS = 1 << ARC_BITS
#: Points per shard, and how far a shard may exceed the mean load.
VIRTUAL_NODES, SLACK = 512, 0.002


def _place(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """The points ``(place, shard)`` of all virtual nodes, clockwise."""
    points = (
        (int(hashlib.md5(f"shard {s} node {v}".encode(), usedforsecurity=False).hexdigest()[:15], 16), s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )
    return sorted(points)


def walk(loads: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES, slack: float = SLACK) -> list[int]:
    """The shard of every arc of the ring, given the bytes of each.

    An arc belongs to the next point clockwise. If its bytes would lift that point's shard
    above the bound, it goes on to the next point whose shard has room. If no shard has room
    (an arc may be large where there are few keys), the least loaded one takes it.
    """
    total = sum(loads.values())
    bound = -(-total // shards) + int(total * slack / shards)
    points, held, owner = ring(shards, virtual_nodes), [0] * shards, [0] * ARCS
    at = 0
    for arc in range(ARCS):
        while at < len(points) and points[at][0] >> (60 - ARC_BITS) < arc:
            at += 1
        load, tried, step = loads.get(arc, 0), set(), at
        while len(tried) < shards:
            shard = points[step % len(points)][1]
            if held[shard] + load <= bound:
                break
            tried.add(shard)
            step += 1
        else:
            shard = min(range(shards), key=lambda s: (held[s], s))
        owner[arc] = shard
        held[shard] += load
    return owner


def shard_documents(
    docs: DataFrame, shards: int = 24, virtual_nodes: int = VIRTUAL_NODES, slack: float = SLACK
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 8, a null text has none and the checksum of the
    empty text. The law is ``bytes``: no shard holds more than the mean, ``slack`` and one arc.
    A document's place on the ring is a hash of its ``doc_id`` (null is one id; rows of one id
    stay together). What the ring walk sees is a histogram of 65,536 arcs, however large the
    table; its result is as small and is broadcast. ``slot`` numbers a shard's rows from 0:
    rows are counted within their arc, and arcs are offset by a running sum, so no task holds
    a whole shard. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            _place(F.col("doc_id")).alias("place"),
        ).withColumn("arc", F.shiftright("place", 60 - ARC_BITS).cast("int")),
        "ring_rows",
    )
    loads = saved(rows.groupBy("arc").agg(F.sum("size").alias("load"), F.count("*").alias("n")), "ring_loads")
    found = {arc: load for arc, load in loads.select("arc", "load").toLocalIterator()}
    owner = walk(found, shards, virtual_nodes, slack)
    # As one literal: a shard number for each arc, in order.
    shard = F.get(F.split(F.lit(",".join(map(str, owner))), ","), F.col("arc")).cast("int")
    before = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        loads.select("arc", "n", shard.alias("shard"))
        .withColumn("first_slot", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("arc", "shard", "first_slot")
    )
    within = Window.partitionBy("arc").orderBy("place", "doc_id", "text_crc32", "size")
    return (
        rows.withColumn("in_arc", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), "arc")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first_slot") + F.col("in_arc")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
