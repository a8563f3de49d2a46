import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from shelfwise.operators import sampling, weights


def frame(spark, sizes):
    rows = [(f"{c}-{i}", c) for c, n in sizes.items() for i in range(n)]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "k string, c string").repartition(5)


def ranked(sizes, seed=42):
    return {
        c: sorted((f"{c}-{i}" for i in range(n)), key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        for c, n in sizes.items()
    }


def by_class(rows):
    out = defaultdict(set)
    for k, c in rows:
        out[c].add(k)
    return out


# The large class outnumbers the hash prefixes, so many prefixes repeat.
SIZES = {"one": 1, "three": 3, "five": 5, "seven": 7, "hot": 9000, "mid": 400}


def test_sample_takes_the_first_hashes_of_half_even_quotas(spark):
    got = by_class(sampling.stratified_sample(frame(spark, SIZES), "c", 0.5, ["k"]).select("k", "c").collect())
    order = ranked(SIZES)
    for c, n in SIZES.items():
        assert got[c] == set(order[c][: round(0.5 * n)]), c


def test_whole_fraction_changes_nothing(spark):
    df = frame(spark, {"a": 2})
    assert sampling.stratified_sample(df, "c", 1.0, ["k"]) is df


def test_null_classes_are_left_out(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("c", "x")], "k string, c string")
    assert {r.c for r in sampling.stratified_sample(df, "c", 0.9, ["k"]).collect()} == {"x"}


def test_undersample_caps_only_large_classes(spark):
    got = Counter(r.c for r in sampling.undersample(frame(spark, SIZES), "c", 5, ["k"]).collect())
    assert got == {c: min(n, 5) for c, n in SIZES.items()}
    shared = Counter(r.c for r in sampling.undersample_to_share(frame(spark, SIZES), "c", 0.1, ["k"]).collect())
    assert shared == {c: min(n, math.floor(sum(SIZES.values()) * 0.1)) for c, n in SIZES.items()}


def test_split_is_disjoint_complete_and_exact(spark):
    sizes = {c: n for c, n in SIZES.items() if n > 1}
    df = frame(spark, sizes)
    rows = sampling.train_test_split(df, "c", 0.2, ["k"]).select("k", "c", "split").collect()
    assert len(rows) == len({r.k for r in rows}) == sum(sizes.values())
    test = Counter(r.c for r in rows if r.split == "test")
    n = sum(sizes.values())
    assert sum(test.values()) == math.ceil(0.2 * n)
    n_train = n - math.ceil(0.2 * n)
    for c, size in sizes.items():
        assert abs((size - test[c]) - size * n_train / n) < 1
    order = ranked(sizes)
    for c in sizes:
        assert {r.k for r in rows if r.c == c and r.split == "test"} == set(order[c][: test[c]])


def test_split_sizes_as_published(spark):
    rng = random.Random(0)
    cuts = sorted(rng.sample(range(1, 6681), 27))
    sizes = {f"c{i:02d}": b - a for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, 6681]))}
    quotas = sampling.split_quotas(frame(spark, sizes), "c", 0.2).collect()
    assert sum(r.train_rows for r in quotas) == 5344 and sum(r.test_rows for r in quotas) == 1337


def test_class_of_one_row_cannot_be_split(spark):
    with pytest.raises(Exception, match="class with a single row: one"):
        sampling.train_test_split(frame(spark, {"one": 1, "two": 10}), "c", 0.2, ["k"]).count()


def test_folds_are_balanced_and_shuffled(spark):
    sizes = {"a": 3, "b": 1, "c": 5003, "d": 12}
    rows = sampling.stratified_folds(frame(spark, sizes), "c", 5, ["k"]).collect()
    assert len(rows) == sum(sizes.values())
    for c, n in sizes.items():
        per_fold = Counter(r.fold for r in rows if r.c == c)
        assert sorted((per_fold[f] for f in range(5)), reverse=True) == [n // 5 + (f < n % 5) for f in range(5)]
    with pytest.raises(ValueError):
        sampling.stratified_folds(frame(spark, {"a": 3}), "c", 1, ["k"])


def test_same_seed_same_rows_other_seed_other_rows(spark):
    pick = lambda seed: {r.k for r in sampling.stratified_sample(frame(spark, {"a": 300}), "c", 0.3, ["k"], seed).collect()}
    assert pick(1) == pick(1) and pick(1) != pick(2)


def test_large_class_tables_take_the_shuffled_path(spark, monkeypatch):
    from shelfwise import session

    plain = {r.k for r in sampling.stratified_sample(frame(spark, SIZES), "c", 0.5, ["k"]).collect()}
    monkeypatch.setattr(sampling, "small_side", lambda df: session.small_side(df, max_rows=2))
    assert {r.k for r in sampling.stratified_sample(frame(spark, SIZES), "c", 0.5, ["k"]).collect()} == plain


def test_split_reports(spark):
    df = sampling.train_test_split(frame(spark, {"a": 10, "b": 30}), "c", 0.2, ["k"])
    info = sampling.split_summary(df, "c").first().asDict()
    assert info["train_distribution"] == {"a": 8, "b": 24} and info["test_distribution"] == {"a": 2, "b": 6}
    assert info["classes"] == ["a", "b"] and info["n_classes"] == 2 and info["total_samples"] == 40
    assert sampling.missing_classes(df, "c").count() == 0
    assert sampling.missing_classes(df.where("not (c = 'a' and split = 'test')"), "c").collect()[0][:] == ("a", "test")


def test_balanced_weights(spark):
    df = frame(spark, {"a": 30, "b": 10})
    got = {r.c: r.weight for r in weights.class_weights(df, "c").collect()}
    assert got == {"a": 40 / 60, "b": 40 / 20}
    rows = weights.sample_weights(df, weights.class_weights(df, "c"), "c").collect()
    assert sum(r.sample_weight for r in rows) == pytest.approx(40)
    assert weights.class_weights(df, "c", "none").count() == 0


def test_aggressive_weights_have_mean_one(spark):
    got = [r.weight for r in weights.aggressive_weights(frame(spark, {"a": 30, "b": 10, "c": 2}), "c").collect()]
    assert sum(got) / 3 == pytest.approx(1)
    raw = [(42 / (3 * n)) ** 1.2 for n in (30, 10, 2)]
    assert sorted(got) == pytest.approx(sorted(w / (sum(raw) / 3) for w in raw))


def test_incomplete_weights_are_replaced(spark):
    df = frame(spark, {"a": 3, "b": 1})
    given = spark.createDataFrame([("a", 9.0)], "c string, weight double")
    assert {r.c: r.weight for r in weights.resolve_weights(df, given, "c").collect()} == {"a": 4 / 6, "b": 2.0}
    full = given.union(spark.createDataFrame([("b", 1.0)], given.schema))
    assert {r.c: r.weight for r in weights.resolve_weights(df, full, "c").collect()} == {"a": 9.0, "b": 1.0}
    assert [r.c for r in weights.missing_from_weights(df, given, "c").collect()] == ["b"]


def test_imbalance_findings(spark):
    df = frame(spark, {"big": 3000, "mid": 300, "few": 25, "tiny": 3})
    bands = {r.c: r.band for r in weights.imbalance_report(df, "c").collect()}
    assert bands == {"big": "dominant", "mid": "normal", "few": "small", "tiny": "small"}
    actions = Counter(r.finding for r in weights.recommendations(df, "c").collect())
    assert actions == {"critical": 3, "few samples": 2, "dominant": 2}
    spread = weights.class_spread(df, "c").first()
    assert spread["imbalance_ratio"] == 1000 and spread["severity"] == "severe"


def test_no_window_holds_more_than_the_stated_rows(spark, monkeypatch):
    """The trie grows with the class: ends are read off small prefixes only."""
    monkeypatch.setattr(sampling, "STEP_DIGITS", 1)
    monkeypatch.setattr(sampling, "TASK_ROWS", 20)
    nodes = []
    kept = sampling.cut_lineage
    monkeypatch.setattr(sampling, "cut_lineage", lambda df, name: nodes.append((name, kept(df, name))) or nodes[-1][1])
    got = by_class(sampling.stratified_sample(frame(spark, SIZES), "c", 0.5, ["k"]).select("k", "c").collect())
    order = ranked(SIZES)
    assert all(got[c] == set(order[c][: round(0.5 * n)]) for c, n in SIZES.items())
    levels = [df for name, df in nodes if name == "ends"]
    assert len(levels) == 3 and levels[-1].agg({"_c": "max"}).first()[0] <= 20
