"""Hard-negative mining: inner products bounded by segment means and deviations before they are computed."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.llm.common import saved

# Tasks get the functions below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Segments per level of refinement; the last level's survivors are scored exactly.
LEVELS = (1, 4, 16, 32)
#: Vector components per tile of rows, and anchors per block: what one task holds at a time.
TILE_CELLS, BLOCK = 1 << 19, 1024

POSITIVES, NEGATIVES = 5, 3
#: A negative scores from 50 % to 95 % of its positive.
LEAST_PCT, MOST_PCT = 50, 95


def prepared(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, label, dim, v`` of the rows that take part, with relabelled rows and scaled components."""
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return given.where(F.col("label").isNotNull() & F.col("x").isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id",
        moved.alias("label"),
        F.size("x").alias("dim"),
        F.transform("x", lambda x: F.floor(x * 256)).alias("v"),
    )


class _Block:
    """Rows of one task as arrays, with the summaries of each level."""

    def __init__(self, table, dim: int) -> None:
        ids = table["vec_id"].combine_chunks()
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.vec_id = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.row, self.label = table["row"].to_numpy(), table["label"].to_numpy()
        self.v = table["v"].combine_chunks().flatten().to_numpy().reshape(len(self.row), dim)
        self.x = self.v.astype(np.float64)
        self.norm = np.sqrt((self.x**2).sum(1))
        self.largest = float(np.abs(self.x).max(initial=0))
        self.levels = [self._summary(k, dim) for k in LEVELS if k < dim]

    def _summary(self, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """Mean and deviation of each of ``k`` segments, both times the root of the segment's length."""
        length = -(-dim // k)
        padded = np.zeros((len(self.x), k * length))
        padded[:, :dim] = self.x
        parts = padded.reshape(len(self.x), k, length)
        mean = parts.mean(2)
        return mean * np.sqrt(length), np.sqrt(((parts - mean[:, :, None]) ** 2).sum(2))


def _bounds(anchors: _Block, i: int, tile: _Block, rows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score: product of the means, less or plus that of the deviations."""
    (mean, deviation), (means, deviations) = anchors.levels[level], tile.levels[level]
    centre, reach = means[rows] @ mean[i], deviations[rows] @ deviation[i]
    reach += 1e-9 * anchors.norm[i] * tile.norm[rows] + 1e-6  # rounding
    return centre - reach, centre + reach


def _scores(anchors: _Block, i: int, tile: _Block, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 53 bits by Python's integers, beyond 64 the nearest long."""
    dim = tile.v.shape[1]
    if anchors.largest * tile.largest * dim < 2**53:
        return (tile.x[rows] @ anchors.x[i]).astype(np.int64)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    whole = tile.v[rows].astype(object) @ anchors.v[i].astype(object)
    return np.array([min(max(int(s), low), high) for s in np.atleast_1d(whole)], dtype=np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    """The ``k``-th largest value, or minus infinity if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _first(scores: np.ndarray, tile: _Block, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best: highest score, then smallest id."""
    near = np.flatnonzero(scores >= _kth(scores, k))
    return near[np.lexsort((tile.row[rows[near]], tile.vec_id[rows[near]], -scores[near]))[:k]]


def _positives(anchors: _Block, tile: _Block, i: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    rows = np.flatnonzero((tile.label == anchors.label[i]) & (tile.row != anchors.row[i]))
    for level in range(len(tile.levels)):
        low, high = _bounds(anchors, i, tile, rows, level)
        rows = rows[high >= _kth(low, POSITIVES)]
    scores = _scores(anchors, i, tile, rows)
    best = _first(scores, tile, rows, POSITIVES)
    return [(0, rows[best], scores[best])]


def _negatives(anchors: _Block, tile: _Block, i: int, targets: Sequence[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    rows = np.flatnonzero(tile.label != anchors.label[i])
    for level in range(len(tile.levels)):
        low, high = _bounds(anchors, i, tile, rows, level)
        keep = np.zeros(len(rows), dtype=bool)
        for p in map(float, targets):
            least, most = p * LEAST_PCT / 100, p * MOST_PCT / 100
            sure = low[(low >= least + 1) & (high <= most - 1)]
            keep |= (high >= least - 1) & (low <= most + 1) & (high >= _kth(sure, NEGATIVES))
        rows = rows[keep]
    scores = _scores(anchors, i, tile, rows)
    found = []
    for j, p in enumerate(targets):
        # In Python's integers where a long would overflow.
        wide = scores.astype(object) if max(abs(p), np.abs(scores.astype(float)).max(initial=0)) > 2**55 else scores
        inside = np.flatnonzero((wide * 100 >= p * LEAST_PCT) & (wide * 100 <= p * MOST_PCT))
        best = inside[_first(scores[inside], tile, rows[inside], NEGATIVES)]
        found.append((j, rows[best], scores[best]))
    return found


def _cell(anchor_rows, tile_rows):
    """The best rows of one tile for the anchors of one block."""
    import pyarrow as pa

    columns = {name: [] for name in ("anchor", "j", "row", "vec_id", "no_id", "score")}
    if anchor_rows.num_rows and tile_rows.num_rows:
        dim = anchor_rows["dim"][0].as_py()
        anchors, tile = _Block(anchor_rows, dim), _Block(tile_rows, dim)
        targets = anchor_rows["targets"].to_pylist() if "targets" in anchor_rows.column_names else None
        for i in range(len(anchors.row)):
            found = _positives(anchors, tile, i) if targets is None else _negatives(anchors, tile, i, targets[i])
            for j, rows, scores in found:
                columns["anchor"].append(np.full(len(rows), anchors.row[i]))
                columns["j"].append(np.full(len(rows), j))
                columns["row"].append(tile.row[rows])
                columns["vec_id"].append(tile.vec_id[rows])
                columns["no_id"].append(tile.no_id[rows])
                columns["score"].append(scores)
    whole = {name: np.concatenate(parts) if parts else np.array([], np.int64) for name, parts in columns.items()}
    no_id = whole.pop("no_id").astype(bool)
    return pa.table(
        {
            name: pa.array(values, pa.int32() if name == "j" else pa.int64(), mask=no_id if name == "vec_id" else None)
            for name, values in whole.items()
        }
    )


def _meet(anchors: DataFrame, rows: DataFrame, by: Sequence[str], best: int) -> DataFrame:
    """``anchor, j, rank, vec_id, score``: the ``best`` rows of each anchor among those with equal ``by``.

    Rows are dealt into tiles of a fixed size and anchors into blocks, by a hash of the row, so
    a group that holds a third of the table is many tiles; every tile meets every block of its group.
    """
    keys = list(by)
    n_rows = rows.groupBy(*keys).agg(F.ceil(F.count("*") * F.greatest(F.first("dim"), F.lit(1)) / TILE_CELLS).alias("tiles"))
    n_anchors = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    sizes = n_rows.join(n_anchors, keys)

    def dealt(part: str) -> Column:
        return F.pmod(F.xxhash64("row"), F.col(part)).alias(part[:-1])

    def each(part: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(part) - 1)).alias(part[:-1])

    tiles = rows.join(sizes, keys).select(*rows.columns, dealt("tiles"), each("blocks"))
    blocks = anchors.join(sizes, keys).select(*anchors.columns, dealt("blocks"), each("tiles"))
    cell = [*keys, "tile", "block"]
    found = (
        blocks.groupBy(*cell)
        .cogroup(tiles.groupBy(*cell))
        .applyInArrow(_cell, "anchor long, j int, row long, vec_id long, score long")
    )
    order = Window.partitionBy("anchor", "j").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).drop("row")


def hard_negatives(vectors: DataFrame, every: int = 50) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Takes ``vec_id, label, embedding``. Rows with a null label, vector or component, or one that is
    not finite, take no part. A row's score is its integer inner product with the anchor, of
    components scaled by 256 and rounded down; the highest come first, ties by smaller ``vec_id``.
    Anchors are the rows whose ``vec_id`` is divisible by ``every``; their positives are the first
    five other rows of their label, and each positive gets the first three rows of other labels that
    score from 50 % to 95 % of it. A row with a null ``vec_id`` is no anchor and comes last among
    ties. Repeated rows are rows of their own. Vectors of different lengths are never compared;
    empty vectors score 0. Scores beyond 64 bits become the nearest long. An empty table gives no
    rows; other columns are ignored.

    Tiles of rows meet blocks of anchors, first within a label for the positives, then over all
    labels. In a task, the segments' means and deviations bound each score, with more segments
    from level to level, and rows that cannot be among the best are left out before the exact score.
    """
    rows = saved(prepared(vectors), "vectors")
    anchors = saved(rows.where(F.col("vec_id") % every == 0), "anchors")
    positives = saved(_meet(anchors, rows, ("dim", "label"), POSITIVES), "positives")
    targets = positives.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found")
    )
    aimed = anchors.join(targets, F.col("row") == F.col("anchor")).select(
        *anchors.columns, F.col("found.score").alias("targets")
    )
    negatives = _meet(aimed, rows, ("dim",), NEGATIVES)
    named = aimed.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    of_positive = positives.select(
        "anchor",
        (F.col("rank") - 1).alias("j"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        negatives.join(of_positive, ["anchor", "j"])
        .join(named, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


#: Row numbers stand for the rows' identity.
HARD_NEGATIVES_SQL = """
WITH given AS (
  SELECT row_number() OVER () AS row, vec_id, label::BIGINT AS label, embedding FROM embeddings
), t AS (
  SELECT row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM given
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.row, b.vec_id,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM t a JOIN t b ON a.row <> b.row AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id NULLS LAST, s.row) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
   AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
