"""Exact stratified sampling, splitting, folds and undersampling.

Rows of a class are ordered by ``md5(seed:key)``; a part is a range of ranks in
that order. Instead of ranking every row of a class in one task, the class is
counted by hash prefix and the prefix holding each range end is found. While such
a prefix has more than ``TASK_ROWS`` rows it is counted by longer prefixes, so the
depth of this trie follows the class; then only its rows are ranked to read off
the hash at the end. The full rows are compared with a class-level table of
such ends and never shuffled by class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfwise import schemas as S
from shelfwise.functions.numeric import round_half_even
from shelfwise.session import cut_lineage, small_side

STEP_DIGITS = 3
HASH_DIGITS = 32
TASK_ROWS = 10_000


def row_hash(key: list[str], seed: int) -> Column:
    """``md5('seed:key1:key2...')`` in hex."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def class_sizes(df: DataFrame, by: str) -> DataFrame:
    """Rows per class, null classes left out."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def range_ends(df: DataFrame, by: str, key: list[str], ends: DataFrame, seed: int) -> DataFrame:
    """The (hash, key) of the row at each rank in ``ends(by, upto)``.

    Ends of 0 give an empty hash, which sorts before every row.
    """
    ends = small_side(ends)
    hashed = cut_lineage(df.where(F.col(by).isNotNull()).select(by, *key, row_hash(key, seed).alias("_h")), "hashes")
    nodes = ends.where("upto > 0").select(by, F.lit("").alias("_p"), F.col("upto").alias("_need")).distinct()
    found, depth = None, 0
    while True:
        nodes, depth = _children(hashed, nodes, by, depth), depth + STEP_DIGITS
        is_open = F.lit(depth < HASH_DIGITS) & (F.col("_c") > TASK_ROWS)
        ready = _ranked(hashed, nodes.where(~is_open), by, key, depth)
        found = ready if found is None else found.unionByName(ready)
        nodes = nodes.where(is_open)
        if nodes.isEmpty():
            break
    empty = ends.where("upto <= 0").select(
        by,
        F.struct(
            F.lit("").alias("_h"),
            *[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in key],
        ).alias("_end"),
    )
    return found.unionByName(empty)


def _children(hashed: DataFrame, nodes: DataFrame, by: str, depth: int) -> DataFrame:
    """For each node, a prefix with a rank in it, the next longer prefix that holds the rank, with its rows."""
    parents = small_side(nodes.select(by, "_p").distinct())
    inside = hashed.withColumn("_p", F.substring("_h", 1, depth)).join(parents, [by, "_p"])
    running = W.partitionBy(by, "_p").orderBy("_q").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = (
        inside.groupBy(by, "_p", F.substring("_h", 1, depth + STEP_DIGITS).alias("_q"))
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_last", F.sum("_c").over(running))
    )
    held = counted.join(small_side(nodes.select(by, "_p", "_need")), [by, "_p"]).where("_need <= _last and _need > _last - _c")
    return cut_lineage(held.select(by, F.col("_q").alias("_p"), (F.col("_need") - F.col("_last") + F.col("_c")).alias("_need"), "_c"), "ends")


def _ranked(hashed: DataFrame, nodes: DataFrame, by: str, key: list[str], depth: int) -> DataFrame:
    """The row at each wanted rank inside its prefix."""
    wanted = nodes.groupBy(by, "_p").agg(F.collect_set("_need").alias("_needs"))
    within = W.partitionBy(by, "_p").orderBy("_h", *key)
    return (
        hashed.withColumn("_p", F.substring("_h", 1, depth))
        .join(small_side(wanted), [by, "_p"])
        .withColumn("_rn", F.row_number().over(within).cast("bigint"))
        .where(F.array_contains("_needs", F.col("_rn")))
        .select(by, F.struct("_h", *key).alias("_end"))
    )


def assign_parts(df: DataFrame, by: str, key: list[str], ends: DataFrame, seed: int) -> DataFrame:
    """Adds ``part``: how many range ends of its class lie before the row.

    ``key`` must identify a row within its class. Rows of a class that has no
    end, or of a null class, are left out.
    """
    per_class = range_ends(df, by, key, ends, seed).groupBy(by).agg(
        F.collect_list("_end").alias("_ends")
    )
    # The hash is computed below the join, once per row.
    keyed = df.withColumn("_row", F.struct(row_hash(key, seed).alias("_h"), *key))
    before = F.size(F.filter("_ends", lambda end: end < F.col("_row")))
    return keyed.join(small_side(per_class), by).withColumn("part", before).drop("_ends", "_row")


def sample_quotas(df: DataFrame, by: str, fraction: float) -> DataFrame:
    """Rows to keep per class: the fraction, rounded half to even."""
    return class_sizes(df, by).withColumn("upto", F.rint(F.col("n") * fraction).cast("bigint"))


def stratified_sample(
    df: DataFrame, by: str = S.TARGET, fraction: float = 1.0, key: list[str] | None = None, seed: int = 42
) -> DataFrame:
    """Exactly the rounded fraction of every class; 1 or more keeps all."""
    if fraction >= 1.0:
        return df
    quotas = sample_quotas(df, by, fraction).select(by, "upto")
    return assign_parts(df, by, key or [S.KEY], quotas, seed).where("part = 0").drop("part")


def undersample(
    df: DataFrame, by: str, cap: int, key: list[str] | None = None, seed: int = 42
) -> DataFrame:
    """At most ``cap`` rows of every class (the class balancing feature)."""
    quotas = class_sizes(df, by).select(by, F.least("n", F.lit(cap).cast("bigint")).alias("upto"))
    return assign_parts(df, by, key or [S.KEY], quotas, seed).where("part = 0").drop("part")


def undersample_to_share(
    df: DataFrame, by: str, share: float, key: list[str] | None = None, seed: int = 42
) -> DataFrame:
    """Classes above the given share of all rows cut down to it."""
    sizes = class_sizes(df, by)
    total = sizes.agg(F.sum("n")).scalar()
    quotas = sizes.select(by, F.least("n", F.floor(total * share).cast("bigint")).alias("upto"))
    return assign_parts(df, by, key or [S.KEY], quotas, seed).where("part = 0").drop("part")


def split_quotas(df: DataFrame, by: str, test_size: float = 0.2) -> DataFrame:
    """Train and test rows per class by largest remainder.

    The test set has ``ceil(test_size * N)`` rows in total. Shares use whole
    numbers, so the remainders compare exactly; equal ones go by class name.
    """
    sizes = class_sizes(df, by)
    totals = sizes.agg(F.sum("n").alias("_total")).select(
        "_total", F.ceil(F.col("_total") * test_size).cast("bigint").alias("_test")
    )
    wide = "decimal(19,0)"
    quota = sizes.select(
        by,
        "n",
        totals.select("_total").scalar().alias("_total"),
        (totals.select("_total").scalar() - totals.select("_test").scalar()).alias("_train"),
    ).withColumn("_scaled", F.col("n").cast(wide) * F.col("_train").cast(wide))
    quota = quota.withColumn("_rest", F.pmod(F.col("_scaled"), F.col("_total").cast(wide)))
    quota = quota.withColumn(
        "_floor", ((F.col("_scaled") - F.col("_rest")) / F.col("_total").cast(wide)).cast("bigint")
    )
    # One row per class: a global order over a class-level table.
    order = W.orderBy(F.desc("_rest"), by)
    missing = F.col("_train") - F.sum("_floor").over(W.partitionBy())
    return quota.select(
        by,
        "n",
        (F.col("_floor") + (F.row_number().over(order) <= missing).cast("bigint")).alias("train_rows"),
    ).withColumn("test_rows", F.col("n") - F.col("train_rows"))


def train_test_split(
    df: DataFrame, by: str = S.TARGET, test_size: float = 0.2, key: list[str] | None = None, seed: int = 42
) -> DataFrame:
    """Adds ``split`` (train or test) with exact per-class quotas.

    Rows without a class are dropped; a class of one row is an error, as a
    stratified split cannot serve it.
    """
    quotas = split_quotas(df, by, test_size)
    ends = quotas.select(
        by,
        F.when(F.col("n") >= 2, F.col("test_rows"))
        .otherwise(F.raise_error(F.concat(F.lit("class with a single row: "), F.col(by).cast("string"))))
        .cast("bigint")
        .alias("upto"),
    )
    parts = assign_parts(df, by, key or [S.KEY], ends, seed)
    return parts.withColumn("split", F.when(F.col("part") == 0, "test").otherwise("train")).drop("part")


def stratified_folds(
    df: DataFrame, by: str, folds: int = 5, key: list[str] | None = None, seed: int = 42, column: str = "fold"
) -> DataFrame:
    """Adds a fold number; class sizes per fold differ by at most one."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    sizes = class_sizes(df, by)
    upto = F.floor(F.col("n") / folds) * F.col("_i") + F.least(F.pmod(F.col("n"), F.lit(folds)), F.col("_i"))
    ends = sizes.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(folds - 1)))).select(
        by, upto.cast("bigint").alias("upto")
    )
    parts = assign_parts(df, by, key or [S.KEY], ends.distinct(), seed)
    return parts.withColumnRenamed("part", column)


def split_distribution(df: DataFrame, by: str = S.TARGET) -> DataFrame:
    """Rows and percentage per split and class, ordered by class."""
    counts = df.groupBy("split", by).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(W.partitionBy("split"))
    return counts.withColumn(
        "percentage", round_half_even(F.col("count") / total * 100, 1)
    ).orderBy("split", by)


def split_summary(df: DataFrame, by: str = S.TARGET, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Sizes, classes and both distributions as one nested row.

    Only the class-level counts are gathered into the maps.
    """
    counts = df.groupBy("split", by).agg(F.count(F.lit(1)).alias("n"))
    is_train = F.col("split") == "train"
    entry = F.struct(F.col(by).cast("string").alias("key"), F.col("n").alias("value"))
    return counts.agg(
        F.lit(test_size).alias("test_size"),
        F.lit(seed).alias("random_state"),
        F.lit(by).alias("target_column"),
        F.sum("n").alias("total_samples"),
        F.sum(F.when(is_train, F.col("n"))).alias("train_samples"),
        F.sum(F.when(~is_train, F.col("n"))).alias("test_samples"),
        F.count_if(is_train).alias("n_classes"),
        F.map_from_entries(F.collect_list(F.when(is_train, entry))).alias("train_distribution"),
        F.map_from_entries(F.collect_list(F.when(~is_train, entry))).alias("test_distribution"),
        F.array_sort(F.collect_list(F.when(is_train, F.col(by).cast("string")))).alias("classes"),
    )


def split_coverage(df: DataFrame, by: str = S.TARGET) -> DataFrame:
    """Each class with its presence in train and in test."""
    return df.groupBy(by).agg(
        F.bool_or(F.col("split") == "train").alias("in_train"),
        F.bool_or(F.col("split") == "test").alias("in_test"),
    )


def missing_classes(df: DataFrame, by: str = S.TARGET) -> DataFrame:
    """Classes that one of the two splits lacks, with the side lacking them."""
    return (
        split_coverage(df, by)
        .where(~(F.col("in_train") & F.col("in_test")))
        .select(by, F.when(F.col("in_train"), "test").otherwise("train").alias("missing_in"))
    )


def sample_distribution(before: DataFrame, after: DataFrame, by: str = S.TARGET, n: int = 5) -> DataFrame:
    """Class percentages before and after sampling, for the ``n`` largest."""
    old, new = class_sizes(before, by), class_sizes(after, by)
    old_total, new_total = old.agg(F.sum("n")).scalar(), new.agg(F.sum("n")).scalar()
    return (
        old.withColumnRenamed("n", "_before")
        .join(new.withColumnRenamed("n", "_after"), by, "left")
        .select(
            by,
            F.col("_before").alias("count_before"),
            round_half_even(F.col("_before") / old_total * 100, 1).alias("percentage_before"),
            round_half_even(
                F.coalesce(F.try_divide(F.col("_after"), new_total), F.lit(0.0)) * 100, 1
            ).alias("percentage_after"),
        )
        .orderBy(F.desc("count_before"), by)
        .limit(n)
    )
