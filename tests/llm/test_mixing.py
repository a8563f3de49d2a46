import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing

SCHEMA = "doc_id long, text string, source string, bits long, src string, block int, size int"


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {**{s: 2.0 * sizes[s] for s in capped}, **share}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {None: 500, "z": 7, "é": 40, "b": 0}, {"x": 3}])
def test_targets(sizes):
    got, want = mixing.targets(sizes), brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_split_tree_deals_every_block_once():
    counts = np.array([7, 0, 100, 33])
    quotas = mixing.split_tree(counts, 6, 1)
    assert quotas.sum(0).tolist() == counts.tolist()
    assert set(quotas.sum(1)) <= {140 // 6, 140 // 6 + 1}
    assert (quotas == mixing.split_tree(counts, 6, 1)).all()


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), ["hot", "b", "c", None][min(3, int(rng.exponential(1)))], i, "s", 0, 1) for i in range(3000)]
    rows += [(9001, None, "b", 0, "s", 0, 1), (9002, "", None, 0, "s", 0, 1), (None, "a b", "b", 0, "s", 0, 1)] + [(7, "same row", "c", 0, "s", 0, 1)] * 3
    rows += [(9100, "long " * 5000, "hot", 0, None, 0, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_mix_meets_targets(spark, docs):
    rows = mixing.sized(docs)
    sizes = {r[0]: r[1] for r in rows.groupBy("_source").agg(F.sum("_size")).collect()}
    per_source, per_block, _ = mixing.plan(rows.select("_source", "_size", "_key"))
    out = mixing.drawn(rows, per_source, per_block).withColumn("taken", F.size("_draws") * F.col("_size"))
    assert out.where("taken > 2 * _size").count() == 0 and out.count() == docs.count()
    want = mixing.targets(sizes)
    for r in out.groupBy("_source").agg(F.sum("taken").alias("t"), F.max("_size").alias("m")).collect():
        assert abs(r.t - want[r["_source"]]) <= r.m
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == out.agg(F.sum(F.size("_draws"))).first()[0]
    key = [F.xxhash64(*docs.columns)]
    again = mixing.mixed(docs.repartition(5))
    assert mixed.select(*key).exceptAll(again.select(*key)).count() == 0


def test_word_counts(spark):
    from shelfwise.llm.common import word_count

    texts = ["", None, "  ", "a", " a\tb\x0b\x0c c\r\n", "x y", "x\x1cy z", "a  b"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(word_count()).collect()]
    import re

    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_empty_table(spark):
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, sf_dir):
    a = mixing.op6_mixing(spark, sf_dir).orderBy("doc_id").collect()
    assert a == mixing.op6_mixing(spark, sf_dir).orderBy("doc_id").collect()
