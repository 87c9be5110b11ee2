"""Exact grouped quantiles that never gather a group in one task.

``median`` and ``percentile`` keep every distinct value of a group in one task's
memory, which fails when a report group holds a third of a 100 TB table. Here:

1. one aggregation per report group takes the plain aggregates, the counts and a
   bounded-size sketch, which yields values proven to lie below and above each
   wanted rank (the bracket);
2. a second pass marks each value as below, inside or above its bracket. Rows
   without a value inside collapse to one counter per task and group, so the
   shuffle carries about ``6 / accuracy`` of the rows per quantile;
3. a bracket is cut into equal bins. Counts per bin, a bounded table, show which
   bins hold the ranks, and only the values of those bins are put in order.

The sketch only decides how many values are kept. A rank that its bracket did not
cover would raise an error, never return a wrong value. Building a report starts no job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins per bracket, and ranks that a bracket must span to be used.
BINS, OPEN_RANKS = 1_024, 4

# Stands for any value under a bracket.
BELOW = "double('-Infinity')"


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"_k_{key}"])
    return condition


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k_{k}" for k in keys})


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    probs: Sequence[float] = (0.5,),
    aggs: Sequence[Column] = (),
    exact: bool = True,
    accuracy: int = 1_000,
    bounded_keys: bool = True,
) -> DataFrame:
    """Aggregate ``df`` by ``keys``: ``aggs`` plus one ``array<double>`` of quantiles per measure.

    NULLs are ignored; a group without values gets NULL quantiles. ``exact=False`` takes the
    sketch values as they are, in one pass. ``bounded_keys`` says that the keys take few values
    however large ``df`` is (services, months, fixed labels): then the table of brackets, one
    row per group, is broadcast. Otherwise it is joined as Spark sees fit.
    """
    names = list(measures)
    work = df.select("*", *[measures[m].cast("double").alias(f"_m_{m}") for m in names])
    if not exact:
        sketches = [F.percentile_approx(f"_m_{m}", list(probs), accuracy * 10).alias(m) for m in names]
        return work.groupBy(*keys).agg(*aggs, *sketches)

    def spread(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if bounded_keys else table

    margin = 3.0 / accuracy
    edges = [edge for p in probs for edge in (max(p - margin, 0.0), min(p + margin, 1.0))]
    profile = work.groupBy(*keys).agg(
        *aggs,
        *[F.count(f"_m_{m}").alias(f"_n_{m}") for m in names],
        *[F.percentile_approx(f"_m_{m}", edges, accuracy).alias(f"_b_{m}") for m in names],
    )
    slots = [(s, m, j) for s, (m, j) in enumerate((m, j) for m in names for j in range(len(probs)))]

    # A bracket of fewer than four ranks may miss the two that are interpolated: it stays open, so
    # a group of up to this many values (666 by default) is kept whole. The result is the same.
    narrow = OPEN_RANKS * accuracy // 6
    # The slot expressions are SQL text: one call to the JVM each instead of a dozen.
    limits = []
    for s, m, j in slots:
        few = f"`_n_{m}` <= {narrow}"
        limits += [
            f"if({few}, {BELOW}, `_b_{m}`[{2 * j}]) AS _lo_{s}",
            # NaN sorts above every number, so it leaves the bracket open.
            f"if({few}, double('NaN'), `_b_{m}`[{2 * j + 1}]) AS _hi_{s}",
            f"(`_n_{m}` - 1) * {float(probs[j])}D AS _pos_{s}",
        ]
    brackets = spread(profile.selectExpr(*[f"`{k}` AS `_k_{k}`" for k in keys], *limits))

    def cell(slot: int, measure: str) -> Column:
        """Bin and value of a row in one slot, NULL above the bracket."""
        value, lo, hi = f"`_m_{measure}`", f"_lo_{slot}", f"_hi_{slot}"
        span = f"({hi} - {lo})"
        # An endless or empty span gives NULL: one bin.
        bin_no = f"coalesce(CAST(least({BINS - 1}, floor(({value} - {lo}) / nullif({span}, 0D) * {BINS})) AS INT), 0)"
        ended = f"{span} < double('Infinity')"
        return F.expr(
            f"CASE WHEN {value} < {lo} THEN struct(-1 AS bin, {BELOW} AS valor) "
            f"WHEN {value} <= {hi} THEN struct(if({ended}, {bin_no}, 0) AS bin, {value} AS valor) END"
        ).alias(f"_c_{slot}")

    cells = (
        work.join(brackets, _same_keys(work, brackets, keys))
        .groupBy(*keys, *[f"_pos_{s}" for s, _, _ in slots], *[cell(s, m) for s, m, _ in slots])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = ", ".join(f"struct({s} AS slot, _pos_{s} AS pos, _c_{s} AS cell)" for s, _, _ in slots)
    inside = (
        cells.select(*keys, "n", F.expr(f"inline(array({listed}))"))
        .where(F.col("cell").isNotNull())
        .select(*keys, "slot", "pos", "cell.bin", "cell.valor", "n")
    )

    def running(window_keys: Sequence[str], order: str) -> Column:
        window = Window.partitionBy(*window_keys).orderBy(order)
        return F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    holds = "(desde <= floor(pos) AND floor(pos) < hasta) OR (desde <= ceil(pos) AND ceil(pos) < hasta)"
    # At most BINS + 1 rows per group and slot are counted up, and at most two of them go on.
    wanted = (
        inside.groupBy(*keys, "slot", "pos", "bin")
        .agg(F.sum("n").alias("n"))
        .withColumn("hasta", running([*keys, "slot"], "bin"))
        .withColumn("desde", F.col("hasta") - F.col("n"))
        .where(holds)
        .select(*keys, F.col("slot").alias("_slot"), F.col("bin").alias("_bin"), F.col("desde").alias("antes"))
    )
    wanted = spread(_renamed(wanted, keys))
    ranked = (
        inside.join(
            wanted, _same_keys(inside, wanted, keys) & (F.col("slot") == F.col("_slot")) & (F.col("bin") == F.col("_bin"))
        )
        .withColumn("hasta", F.col("antes") + running([*keys, "slot", "bin"], "valor"))
        .withColumn("desde", F.col("hasta") - F.col("n"))
    )

    def value_at(slot: int, rank: str, name: str) -> Column:
        here = f"slot = {slot} AND desde <= {rank}(pos) AND {rank}(pos) < hasta"
        return F.expr(f"max(valor) FILTER (WHERE {here})").alias(name)

    found = spread(
        _renamed(
            ranked.groupBy(*keys).agg(
                *[value_at(s, "floor", f"_v_{s}") for s, _, _ in slots],
                *[value_at(s, "ceil", f"_w_{s}") for s, _, _ in slots],
            ),
            keys,
        )
    )
    result = profile.join(found, _same_keys(profile, found, keys), "left")

    def quantile(slot: int, measure: str, j: int) -> str:
        count, low, high = f"`_n_{measure}`", f"_v_{slot}", f"_w_{slot}"
        part = f"(({count} - 1) * {float(probs[j])}D) % 1"
        covered = f"{low} IS NOT NULL AND {high} IS NOT NULL AND ({low} != {BELOW} OR {count} <= {narrow})"
        return (
            f"CASE WHEN {covered} THEN {low} * (1D - {part}) + {high} * ({part}) "
            f"WHEN {count} > 0 THEN raise_error('quantile rank outside its bracket') END"
        )

    per_measure = {m: [quantile(s, m, j) for s, mm, j in slots if mm == m] for m in names}
    plain = [c for c in profile.columns if not c.startswith(("_n_", "_b_"))]
    return result.select(
        *[profile[c] for c in plain],
        *[F.expr(f"array({', '.join(per_measure[m])})").alias(m) for m in names],
    )


def grouped_medians(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], **kwargs) -> DataFrame:
    """:func:`grouped_quantiles` at 0.5, with one double column per measure."""
    table = grouped_quantiles(df, keys, measures, probs=(0.5,), **kwargs)
    return table.select(*[F.col(c)[0].alias(c) if c in measures else F.col(c) for c in table.columns])
