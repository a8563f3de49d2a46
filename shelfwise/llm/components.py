"""Connected components of an edge table, as a few shuffles per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, root)``, root the smallest node of the component.

    Alternates large-star and small-star rounds until the edges stop changing,
    which takes a logarithmic number of rounds. Groups are only ever reduced to
    their minimum and joined back, so no task holds a component.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        after = stored(small, "edges")
        drop_stored(current)
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        current = after
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
