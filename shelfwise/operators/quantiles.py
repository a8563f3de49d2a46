"""Exact, linearly interpolated quantiles that never gather a group in one task.

Each wanted rank has a range of values that holds it, at first the whole group.
A range with more than ``LARGE`` rows is cut at quantiles of a bounded sketch, the
rows in each piece are counted exactly, and the piece that holds the rank is the
next range. A rank is read off once its range has at most ``LARGE`` rows or a
single value; only such a range is ever ordered in one task. The sketch decides
how fast ranges shrink, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfwise.session import cut_lineage

LARGE = 100_000
PIECES = 64
ACCURACY = 1_000


def quantiles_from_counts(
    counts: DataFrame, by: list[str], value: str, count: str, probabilities: dict[str, float]
) -> DataFrame:
    """Exact quantiles of a table of (group, value, rows).

    For whole-number values whose sum is bounded by the data, such as text
    lengths or rows per key: ``d`` distinct ones take at least ``d * d / 2``
    characters or rows, so the counts of even a huge table sort in one task.
    """
    running = W.partitionBy(*by).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = (
        counts.where(F.col(value).isNotNull())
        .withColumn("_upto", F.sum(count).over(running))
        .withColumn("_n", F.sum(count).over(W.partitionBy(*by)))
    )
    picks, outputs = [], []
    for i, (name, p) in enumerate(probabilities.items()):
        h = F.lit(p) * (F.col("_n") - 1)
        picks += [
            F.min(F.when(F.col("_upto") >= F.floor(h) + 1, F.col(value))).alias(f"_a{i}"),
            F.min(F.when(F.col("_upto") >= F.ceil(h) + 1, F.col(value))).alias(f"_z{i}"),
            F.max(h - F.floor(h)).alias(f"_f{i}"),
        ]
        outputs.append((F.col(f"_a{i}") + (F.col(f"_z{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}")).alias(name))
    return ranked.groupBy(*by).agg(*picks).select(*by, *outputs)


def _ranges(rows: DataFrame, by: list[str], ranks: Column) -> DataFrame:
    """The whole of each group as the range of each of its ranks, which count from 0."""
    groups = rows.groupBy(*by).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    return groups.select(*by, F.explode(F.array_distinct(ranks)).alias("_rank"), "_lo", "_hi", "_n").withColumn("_below", F.lit(0).cast("bigint"))


def _narrowed(rows: DataFrame, ranges: DataFrame, by: list[str], few: bool) -> DataFrame:
    """Each range cut into pieces, and the piece with its rank as the new range."""
    key = [*by, "_rank"]
    hint = F.broadcast if few else (lambda df: df)
    inside = rows.join(hint(ranges.select(*key, "_lo", "_hi")), by).where("_v BETWEEN _lo AND _hi").select(*key, "_v")
    marks = F.percentile_approx("_v", [k / PIECES for k in range(1, PIECES)], ACCURACY)
    cuts = inside.groupBy(*key).agg(F.array_distinct(marks).alias("_cuts"))
    # A piece is one cut, or the values between two; a cut is a value of the range, so the range shrinks.
    piece = 2 * F.size(F.filter("_cuts", lambda c: c < F.col("_v"))) + F.array_contains("_cuts", F.col("_v")).cast("int")
    counted = (
        inside.join(hint(cuts), key)
        .groupBy(*key, piece.alias("_piece"))
        .agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*key).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counted = counted.withColumn("_before", before).join(hint(ranges.select(*key, "_below")), key)
    at = F.col("_rank") - F.col("_below")
    found = counted.where((at >= F.col("_before")) & (at < F.col("_before") + F.col("_n")))
    return found.select(*key, "_lo", "_hi", "_n", (F.col("_below") + F.col("_before")).alias("_below"))


def values_at_ranks(rows: DataFrame, by: list[str], ranks: Column, few: bool = False, large: int | None = None) -> DataFrame:
    """``(by, _rank, _x)``: the value of ``rows(by, _v)`` at each rank of ``ranks``, an array over ``_n``."""
    large = large or LARGE
    key = [*by, "_rank"]
    is_open = (F.col("_n") > large) & (F.col("_lo") < F.col("_hi"))
    ranges = cut_lineage(_ranges(rows, by, ranks), "ranges")
    while not ranges.where(is_open).isEmpty():
        after = _narrowed(rows, ranges.where(is_open), by, few)
        ranges = cut_lineage(ranges.where(~is_open).unionByName(after), "ranges")
    hint = F.broadcast if few else (lambda df: df)
    single = ranges.where("_lo = _hi").select(*key, F.col("_lo").alias("_x"))
    small = ranges.where("_lo < _hi")
    inside = rows.join(hint(small), by).where("_v BETWEEN _lo AND _hi")
    counts = inside.groupBy(*key, "_below", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(W.partitionBy(*key).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow))
    at = F.col("_rank") - F.col("_below")
    read = counts.withColumn("_upto", upto).where((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_c")))
    return single.unionByName(read.select(*key, F.col("_v").alias("_x")))


def exact_quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probabilities: dict[str, float],
    groups_are_few: bool = False,
    large: int | None = None,
) -> DataFrame:
    """One row per group with one column per entry of ``probabilities``.

    ``groups_are_few`` is set only where the number of groups is fixed by the
    plan (one per profiled column), which makes the table of ranges broadcastable.
    Missing values are left out; groups without values are absent.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    place = {name: F.lit(p) * (F.col("_n") - 1) for name, p in probabilities.items()}
    ranks = F.array(*[f(h).cast("bigint") for h in place.values() for f in (F.floor, F.ceil)])
    rows = cut_lineage(rows, "values")
    found = values_at_ranks(rows, by, ranks, groups_are_few, large)
    sizes = rows.groupBy(*by).agg(F.count("_v").alias("_n"))
    # Two ranks at most for each wanted quantile.
    known = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))
    joined = sizes.join(F.broadcast(known) if groups_are_few else known, by)

    def interpolated(h: Column) -> Column:
        low, high = (F.try_element_at("_at", f(h).cast("bigint")) for f in (F.floor, F.ceil))
        return low + (high - low) * (h - F.floor(h))

    return joined.select(*by, *[interpolated(h).alias(name) for name, h in place.items()])
