"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by the leading bits of a seeded hash of its
rows, so a block is a random share of its source and needs no sort. A source's
target is met by whole passes over its blocks plus the blocks below a hash
threshold; the threshold is refined ten bits at a time from grouped sums, never
by ranking a source in one task. The drawn blocks are then dealt to output
shards: at every node of a binary tree over the shards a
multivariate-hypergeometric draw decides how many blocks of each source go left,
and the leaves' quotas cut each source's permuted list of blocks into disjoint
pieces. Rows are shuffled locally, inside their shard.

The driver holds one number per source and block; block size grows with the
corpus so that this plan stays near a million entries.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import shared_path, stored, table, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_PASSES = 2.0
SEED = 20_240
BLOCK_WORDS = 1 << 14
PLAN_BLOCKS = 1 << 20
SHARD_WORDS = 1 << 20
SHARDS = 1 << 12
HASH_BITS = 60
STEP_BITS = 10
BROADCAST_ROWS = 200_000


def targets(sizes: dict, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> dict:
    """Words wanted of each source; no more than ``most`` times its size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    wanted, free = {}, set(order)
    left = share * sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in order if s in free and weight[s] * unit > most * sizes[s]]
        if not over:
            wanted.update({s: weight[s] * unit for s in free})
            break
        for s in over:
            wanted[s] = most * sizes[s]
            left -= wanted[s]
            free.discard(s)
    return {s: float(wanted[s]) for s in order}


def sized(docs: DataFrame, text: str = "text", source: str = "source", keep: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """The rows packed into ``_row``, their words counted, and a seeded 60-bit hash of the whole row.

    ``keep`` names the columns that ``_row`` holds, all by default. Rows that
    agree in every column share a hash and are told apart nowhere.
    """
    key = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`").cast("string") for c in docs.columns])
    packed = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns])
    return docs.select(packed.alias("_row"), word_count(f"`{text}`").alias("_size"), F.col(f"`{source}`").alias("_source"), F.shiftrightunsigned(key, 64 - HASH_BITS).alias("_key"))


def thresholds(rows: DataFrame, remainders: dict) -> dict:
    """For each source the hash below which its rows hold about ``remainders`` words.

    Each round sums words by the next ten bits inside the bin that holds the
    boundary, until that bin is one hash; the nearer side of the last hash wins.
    """
    state = {s: [0, r, 0.0] for s, r in remainders.items() if r > 0}  # prefix, words still wanted
    done = {s: 0 for s, r in remainders.items() if r <= 0}
    for level in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        if not state:
            break
        spark = rows.sparkSession
        open_bins = F.broadcast(spark.createDataFrame([(s, p[0]) for s, p in state.items()], "src string, prefix long"))
        inside = rows.join(open_bins, rows["_source"].eqNullSafe(open_bins["src"]) & (F.shiftrightunsigned("_key", HASH_BITS - level + STEP_BITS) == F.col("prefix")))
        sums = inside.groupBy("src", F.shiftrightunsigned("_key", HASH_BITS - level).alias("bin")).agg(F.sum("_size").alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")).collect()
        by_source: dict = {}
        for r in sums:
            by_source.setdefault(r.src, []).append(r)
        for s, bins in by_source.items():
            wanted = state[s][1]
            for r in sorted(bins, key=lambda r: r.bin):
                if r.n >= wanted:
                    break
                wanted -= r.n
            else:
                done[s] = 1 << HASH_BITS
                del state[s]
                continue
            if r.low == r.high:
                done[s] = r.high + (1 if wanted * 2 >= r.n else 0)
                del state[s]
            else:
                state[s] = [r.bin, wanted, 0.0]
    return done


def split_tree(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard, whose sums differ by one at most."""
    quotas = np.zeros((shards, len(counts)), np.int64)

    def deal(first: int, last: int, own: np.ndarray) -> None:
        if last - first == 1:
            quotas[first] = own
            return
        middle = (first + last) // 2
        total = int(own.sum())
        size = total * (middle - first) // (last - first)
        draw = np.random.default_rng([seed, first, last]).multivariate_hypergeometric(own, size, method="marginals")
        deal(first, middle, draw)
        deal(middle, last, own - draw)

    deal(0, shards, counts)
    return quotas


def plan(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES, seed: int = SEED) -> tuple[DataFrame, DataFrame, int]:
    """Per source its target and threshold; per source, block and pass its shard; the number of shards."""
    spark = rows.sparkSession
    sizes = {r["_source"]: int(r["n"] or 0) for r in rows.groupBy("_source").agg(F.sum("_size").alias("n")).collect()}
    wanted = targets(sizes, weights, share, most)
    total = sum(sizes.values())
    block_words = max(BLOCK_WORDS, math.ceil(total / PLAN_BLOCKS))
    passes = {s: (int(wanted[s] // sizes[s]) if sizes[s] else 0) for s in sizes}
    rest = {s: wanted[s] - passes[s] * sizes[s] if sizes[s] else 0.0 for s in sizes}
    below = thresholds(rows, rest)
    bits = {s: min(20, max(0, math.ceil(math.log2(max(1, sizes[s] / block_words))))) for s in sizes}
    order = list(wanted)
    draws = []
    for s in order:
        n = 1 << bits[s]
        whole = [(p, b) for p in range(passes[s]) for b in range(n)]
        part = [(passes[s], b) for b in range(n) if (b << (HASH_BITS - bits[s])) < below[s]]
        draws.append(whole + part)
    counts = np.array([len(d) for d in draws], np.int64)
    shards = max(1, min(SHARDS, math.ceil(sum(wanted.values()) / SHARD_WORDS)))
    quotas = split_tree(counts, shards, seed) if len(counts) else np.zeros((shards, 0), np.int64)
    entries = []
    for i, s in enumerate(order):
        shard = np.repeat(np.arange(shards), quotas[:, i])
        for j, k in enumerate(np.random.default_rng([seed, i]).permutation(len(draws[i]))):
            copy, block = draws[i][k]
            entries.append((s, block, copy, int(shard[j])))
    per_source = spark.createDataFrame([(s, sizes[s], wanted[s], bits[s], passes[s], below[s]) for s in order], "src string, source_size long, target double, bits int, passes int, below long")
    per_block = spark.createDataFrame(entries, "src string, block long, copy int, shard int")
    per_block = per_block.groupBy("src", "block").agg(F.collect_list(F.struct("copy", "shard")).alias("_draws"))
    return F.broadcast(per_source), F.broadcast(per_block) if len(entries) <= BROADCAST_ROWS else per_block, shards


def drawn(rows: DataFrame, per_source: DataFrame, per_block: DataFrame) -> DataFrame:
    """Every row with its draws: one (copy, shard) for each time the mix takes it."""
    rows = rows.join(per_source, rows["_source"].eqNullSafe(per_source["src"]), "left").drop("src")
    rows = rows.withColumn("_block", F.expr(f"cast(shiftrightunsigned(_key, {HASH_BITS} - bits) as long)"))
    blocks = per_block.withColumnRenamed("src", "_src").withColumnRenamed("block", "_b")
    rows = rows.join(blocks, rows["_source"].eqNullSafe(blocks["_src"]) & (rows["_block"] == blocks["_b"]), "left").drop("_src", "_b")
    taken = F.filter(F.coalesce("_draws", F.array().cast("array<struct<copy:int,shard:int>>")), lambda d: (d["copy"] < F.col("passes")) | (F.col("_key") < F.col("below")))
    return rows.withColumn("_draws", taken)


def mixed(docs: DataFrame, text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mixed table: the columns of ``docs``, each row as often as the mix takes it.

    Rows lie in their output shard's partition in a shuffled order. Sizes are
    words; null and empty texts have size 0 and follow their block; a null
    source is a source of its own, sorted last. An empty table stays empty.
    """
    rows = sized(docs, text, source)
    counts = stored(rows.select("_source", "_size", "_key"), "mix-sizes")
    per_source, per_block, _ = plan(counts, **how)
    picks = drawn(rows, per_source, per_block).select("_row", "_key", F.explode("_draws").alias("_draw"))
    order = F.xxhash64("_key", "_draw.copy", "_draw.shard")
    picks = picks.select("_row", F.col("_draw.shard").alias("_shard"), order.alias("_order"))
    return picks.repartitionByRange("_shard", "_order").sortWithinPartitions("_shard", "_order").select("_row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    rows = stored(sized(table(spark, sf_dir, "documents", "doc_id", "source", "text"), keep=["doc_id"]), "mix-sizes")
    per_source, per_block, _ = plan(rows.select("_source", "_size", "_key"))
    out = drawn(rows, per_source, per_block)
    return out.select("_row.doc_id", F.col("_size").alias("size"), "source_size", "target", (F.size("_draws") * F.col("_size")).cast("long").alias("taken"))
