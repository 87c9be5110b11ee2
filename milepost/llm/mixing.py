"""Mix sources to target weights by hash thresholds found in histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.llm.common import count_words, saved

#: A document's place is a hash of 60 bits; each histogram level looks at 12 of them.
PLACE_BITS, LEVEL_BITS, LEVELS = 60, 12, 3


def _place(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, PLACE_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Add ``target`` to ``source, source_size``, one row per source.

    Sources in code-point order, null last, take ``weights`` in turn and share the sum of all
    sizes by weight. No target exceeds ``most`` times its source's size; the excess goes to the
    others by weight until none is above. Sources ordered by size per weight fill up in that
    order, so one running sum finds those that are full. One row per source is all it sorts.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    cap = F.lit(float(most)) * F.col("source_size")
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    running = order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    before = F.coalesce(F.sum("cap").over(running), none)
    left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(running), none)
    shared = (
        sources.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("total", F.sum(F.col("source_size").cast("double")).over(every))
        .withColumn("before", before)
        .withColumn("left", left)
        .withColumn("full", F.col("cap") * F.col("left") <= F.col("weight") * (F.col("total") - F.col("before")))
        .withColumn("open_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every))
        .withColumn("open_total", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), none))
    )
    level = F.col("weight") * (F.col("open_total") / F.col("open_weight"))
    return shared.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(level).alias("target"))


def _running(hist: DataFrame) -> DataFrame:
    """Add ``before``: the sizes of a source's earlier buckets."""
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return hist.withColumn("before", F.coalesce(F.sum("bucket_size").over(order), F.lit(0)))


def limits(sized: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Per source (column ``of``) its ``source_size, target, times`` and ``last``, the threshold's place.

    ``sized`` has ``source, size, place`` per document and is read once per histogram level.
    """
    size = F.col("source_size")
    times = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = saved(
        targets(totals, weights, most)
        .withColumn("times", times)
        .withColumn("rest", F.col("target") - F.col("times") * size)
        .withColumn("low", F.lit(0).cast("long")),
        "mix_targets",
    )
    state_columns = state.columns

    def inside(width: int) -> DataFrame:
        """Documents in the slice of ``2 ** width`` places that starts at their source's ``low``."""
        found = sized.join(
            state.select(F.col("source").alias("of"), "low", "rest"), F.col("source").eqNullSafe(F.col("of"))
        )
        return found if width == PLACE_BITS else found.where(F.shiftright("place", width) == F.shiftright("low", width))

    width = PLACE_BITS
    for _ in range(LEVELS):
        step = width - LEVEL_BITS
        buckets = F.shiftright("place", step)
        hist = inside(width).groupBy("source", buckets.alias("bucket"), "rest").agg(F.sum("size").alias("bucket_size"))
        # The last bucket that starts within the budget holds the threshold.
        cut = (
            _running(hist)
            .where(F.col("before") <= F.col("rest"))
            .groupBy("source")
            .agg(F.max(F.struct("bucket", "before")).alias("cut"))
            .select(F.col("source").alias("of"), "cut")
        )
        state = saved(
            state.join(cut, F.col("source").eqNullSafe(F.col("of")), "left")
            .withColumn("rest", F.col("rest") - F.coalesce("cut.before", F.lit(0)))
            .withColumn("low", F.coalesce(F.shiftleft("cut.bucket", step), "low"))
            .select(*state_columns),
            "mix_state",
        )
        width = step
    hist = inside(width).groupBy("source", F.col("place").alias("bucket"), "rest").agg(F.sum("size").alias("bucket_size"))
    last = (
        _running(hist)
        .where(2 * F.col("before") + F.col("bucket_size") <= 2 * F.col("rest"))
        .groupBy("source")
        .agg(F.max("bucket").alias("last"))
        .select(F.col("source").alias("of"), "last")
    )
    return saved(
        state.join(last, F.col("source").eqNullSafe(F.col("of")), "left").select(
            F.col("source").alias("of"),
            "source_size",
            "target",
            "times",
            F.coalesce("last", F.col("low") - 1).alias("last"),
        ),
        "mix_limits",
    )


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        count_words(F.col("text").cast("string")).alias("size"),
        _place(F.col("doc_id")).alias("place"),
    )


def _times() -> Column:
    return F.col("times") + (F.col("place") <= F.col("last")).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``size`` counts words (null: 0). Of every source the mix takes each document as many whole
    times as fits its target, and once more the documents whose hash lies below the source's
    threshold, so that the source's sum comes as near to its target as one document allows.
    Sums per source and hash bucket show which bucket a threshold lies in; only documents of
    that bucket are summed again by the next bits, and at last by the whole hash. Nothing is
    sorted but histograms. Documents with one ``doc_id`` (null is one) have one hash and stand
    or fall together. Sources may be null; an empty table gives no rows. Other columns are
    ignored. The hash depends on ``doc_id`` alone, so reruns agree.
    """
    sized = saved(_sized(docs), "sized")
    found = limits(sized, weights, most)
    return sized.join(found, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _times()).alias("taken")
    )


def mixture(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The documents as often as :func:`mix` takes them, none to ``most`` times; same columns."""
    found = limits(saved(_sized(docs), "sized"), weights, most)
    own = F.col("source").cast("string").eqNullSafe(F.col("of"))
    # The row's own columns travel as one, so that names of the limits cannot clash with them.
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "source", _place(F.col("doc_id")).alias("place"))
    taken = rows.join(found, own).select(F.explode(F.array_repeat("doc", _times().cast("int"))).alias("doc"))
    return taken.select("doc.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS place
  FROM (SELECT doc_id, source,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM {documents})
), totals AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS s FROM sized GROUP BY source
), weighed AS (
  SELECT *, 3.0::DOUBLE * s AS cap,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM totals
), ordered AS (
  SELECT *, sum(s) OVER () AS total,
         coalesce(sum(cap) OVER o, 0) AS before,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS remaining
  FROM weighed
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, cap * remaining <= w * (total - before) AS is_full FROM ordered
), shared AS (
  SELECT source, s, CASE WHEN is_full THEN cap ELSE
         w * ((total - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0))
              / sum(CASE WHEN NOT is_full THEN w END) OVER ()) END AS target
  FROM marked
), goal AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS times FROM shared
), placed AS (
  SELECT source, place, sum(size) AS here FROM sized GROUP BY source, place
), summed AS (
  SELECT *, coalesce(sum(here) OVER (PARTITION BY source ORDER BY place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed
), drawn AS (
  SELECT p.source, p.place, 2 * p.before + p.here <= 2 * (g.target - g.times * g.s) AS extra
  FROM summed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source
)
SELECT z.doc_id, z.source, CAST(z.size AS BIGINT) AS size, CAST(g.s AS BIGINT) AS source_size, g.target,
       CAST(z.size * (g.times + CASE WHEN d.extra THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized z JOIN goal g ON z.source IS NOT DISTINCT FROM g.source
JOIN drawn d ON z.source IS NOT DISTINCT FROM d.source AND z.place = d.place
"""
