"""Ranked lexical search: a term at a time, rarest first, with a limit on new accumulators."""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from milepost.llm.common import saved

# Tasks get the functions below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 10
#: Distinct terms of the items that are searched together; a table of more items is searched in several passes.
BLOCK_TERMS = 1 << 20
#: Postings that a task holds at a time, and bytes of a text that are split at a time.
CHUNK_POSTINGS, PIECE = 1 << 21, 1 << 20

_POSTINGS = "doc_id long, n long, terms array<int>, counts array<long>"


def _table() -> bytes:
    """Terms are letters, digits and everything beyond ASCII; only A-Z are lower-cased."""
    kept = [c if c >= 128 or bytes([c]).isalnum() else 32 for c in range(256)]
    return bytes(c + 32 if 65 <= c <= 90 else c for c in kept)


def term_counts(text: str | None) -> Counter[bytes]:
    """Terms of a text with their numbers; long texts are split piece by piece, between terms."""
    data, found, table, at = (text or "").encode("utf-8", "surrogatepass"), Counter(), _table(), 0
    while at < len(data):
        end = at + PIECE
        piece = data[at:end].translate(table)
        while end < len(data) and not piece.endswith(b" "):
            more = data[end : end + PIECE].translate(table)
            cut = more.find(b" ") + 1 or len(more)
            piece, end = piece + more[:cut], end + cut
        found.update(piece.split())
        at = end
    return found


def _items(batches):
    import pyarrow as pa

    for batch in batches:
        terms = [sorted(term_counts(text.as_py())) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"]
        )


def _postings(ids: dict[bytes, int]):
    """A row per document: its length, and the wanted terms that it holds."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            lengths, terms, counts = [], [], []
            for text in batch.column("text"):
                found = term_counts(text.as_py())
                held = [(ids[term], n) for term, n in found.items() if term in ids]
                lengths.append(found.total())
                terms.append([t for t, _ in held])
                counts.append([n for _, n in held])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return read


class Chunk:
    """Postings of some documents, grouped by term, with the exact value of each."""

    def __init__(self, doc_id, no_id, n, sizes, terms, counts, weights, documents: int, total: int) -> None:
        self.doc_id, self.no_id = doc_id, no_id
        m = 100 - 90 + (90 * n * documents) // max(total, 1)
        doc = np.repeat(np.arange(len(n)), sizes)
        value = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[doc]))
        order = np.argsort(terms, kind="stable")
        self.doc, self.value, terms = doc[order], value[order], terms[order]
        self.term, self.start = np.unique(terms, return_index=True)
        self.end = np.append(self.start[1:], len(terms))
        self.most = np.maximum.reduceat(self.value, self.start) if len(terms) else np.array([], np.int64)
        self.sums = np.zeros(len(n), dtype=np.int64)

    def search(self, terms: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the best documents for ``terms`` (rarest first), and how many accumulators there were.

        ``least`` is a score that ``k`` documents have elsewhere. A document that no earlier term
        has met can gain no more than the bounds of the terms to come: once the ``k``-th partial
        score exceeds these, no accumulator is made, and those there are get all their terms.
        """
        at = np.searchsorted(self.term, terms)
        at = at[at < len(self.term)][np.isin(terms, self.term, assume_unique=True)[at < len(self.term)]]
        left = np.cumsum(self.most[at][::-1])[::-1]
        sums, met, growing = self.sums, [], True
        for place, bound in zip(at, left):
            doc, value = self.doc[self.start[place] : self.end[place]], self.value[self.start[place] : self.end[place]]
            if growing:
                partial = sums[np.concatenate(met)] if met else sums[:0]
                limit = max(least, np.partition(partial, len(partial) - k)[len(partial) - k] if len(partial) >= k else 0)
                growing = limit <= bound
            if growing:
                met.append(doc[(sums[doc] == 0) & (value > 0)])
            else:
                held = sums[doc] > 0
                doc, value = doc[held], value[held]
            sums[doc] += value
        docs = np.concatenate(met) if met else np.array([], np.int64)
        scores = sums[docs]
        sums[docs] = 0
        if len(docs) > k:
            near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            best, scores = docs[near], scores[near]
        else:
            best = docs
        first = np.lexsort((self.doc_id[best], self.no_id[best], -scores))[:k]
        return best[first], scores[first], len(docs)


def _chunks(batches, weights: np.ndarray, documents: int, total: int) -> Iterator[Chunk]:
    import pyarrow as pa

    def built(held: list) -> Chunk:
        rows = pa.Table.from_batches(held).combine_chunks()
        column = lambda name: rows[name].combine_chunks()
        ids, terms, counts = column("doc_id"), column("terms"), column("counts")
        return Chunk(
            ids.fill_null(0).to_numpy(),
            ids.is_null().to_numpy(zero_copy_only=False),
            column("n").to_numpy(),
            terms.value_lengths().to_numpy(),
            terms.flatten().to_numpy(),
            counts.flatten().to_numpy(),
            weights,
            documents,
            total,
        )

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten()) + batch.num_rows
        if size >= CHUNK_POSTINGS:
            yield built(held)
            held, size = [], 0
    if held:
        yield built(held)


def _search(items: Sequence[np.ndarray], weights: np.ndarray, documents: int, total: int, k: int):
    """The best documents of a task for every item."""

    def run(batches):
        import pyarrow as pa

        best: list[list[tuple[int, bool, int]]] = [[] for _ in items]
        for chunk in _chunks(batches, weights, documents, total):
            for item, terms in enumerate(items):
                so_far = best[item]
                least = -so_far[-1][0] if len(so_far) == k else 0
                docs, scores, _ = chunk.search(terms, k, least)
                rows = zip((-scores).tolist(), chunk.no_id[docs].tolist(), chunk.doc_id[docs].tolist())
                best[item] = sorted([*so_far, *rows])[:k]
        rows = [(item, None if no_id else doc_id, -score) for item, found in enumerate(best) for score, no_id, doc_id in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[c] for r in rows], pa.int64()) for c in (1, 2))],
            ["item", "doc_id", "score"],
        )

    return run


def _blocks(items: DataFrame, block_terms: int) -> Iterator[list]:
    """Items in blocks of a bounded number of terms; the driver holds one block."""
    block, terms = [], 0
    for item in items.toLocalIterator(prefetchPartitions=False):
        block.append(item)
        terms += len(item.terms)
        if terms >= block_terms:
            yield block
            block, terms = [], 0
    if block:
        yield block


def _ranked(spark: SparkSession, docs: DataFrame, block: list, k: int) -> DataFrame:
    ids = {term: i for i, term in enumerate(sorted({bytes(t) for item in block for t in item.terms}))}
    wanted = spark.sparkContext.broadcast(ids)
    postings = saved(docs.mapInArrow(lambda batches: _postings(wanted.value)(batches), _POSTINGS), "postings")
    documents, total = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights, df = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
    for term, n in postings.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[term], weights[term] = n, math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    items = []
    for item in block:
        terms = np.array([ids[bytes(t)] for t in item.terms], dtype=np.int64)
        items.append(terms[np.lexsort((terms, df[terms]))])
    query = spark.sparkContext.broadcast((items, weights, documents, total, k))
    found = postings.where(F.size("terms") > 0).select("doc_id", "n", "terms", "counts").mapInArrow(
        lambda batches: _search(*query.value)(batches), "item int, doc_id long, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame([(i, item.item_id) for i, item in enumerate(block)], "item int, item_id long")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .join(names, "item")
        .select("item_id", "rank", "doc_id", "score")
    )


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents for each item's text.

    Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Weights and
    lengths are counted over all documents, and scores are whole numbers. Equal scores are ordered
    by ``doc_id``, null last. Null and empty texts have no terms; an item without any that occurs
    gives no rows. Every row is an item or a document of its own, so repeated rows come out
    repeatedly. Empty tables give no rows; other columns are ignored.

    Documents stay where they are. Each task keeps the postings of its documents for the terms
    asked for, and goes through an item's terms from the rarest on; only its ``k`` best per item are
    shuffled. The terms of up to ``block_terms`` are sent to tasks together; more items take more passes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    terms = saved(asked.mapInArrow(_items, "item_id long, terms array<binary>"), "items")
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in _blocks(terms, block_terms):
        found = found.unionByName(_ranked(spark, texts, block, k))
    return found


SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), whole AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0
), post AS (
  SELECT row, doc_id, any_value(len(terms)) AS n, term, count(*) AS tf
  FROM (SELECT row, doc_id, terms, unnest(terms) AS term FROM d) GROUP BY row, doc_id, term
), weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM post, whole GROUP BY term
), item AS (
  SELECT DISTINCT row, item_id, term FROM (
    SELECT row, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS row, * FROM benchmark))
), scored AS (
  SELECT item.row, item_id, post.row AS doc, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total))))::BIGINT AS score
  FROM item JOIN post USING (term) JOIN weighed USING (term), whole GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
