import random

import pytest

from shelfwise.llm import toxicity

SCHEMA = "doc_id long, text string, score string, toxic2 int"


@pytest.mark.parametrize("word, want", [("1d10t", "idiot"), ("ІDIOT", "idiot"), ("m0r0n,", "moron"), ("$cum", "scum"), ("100", "100"), ("crème", "creme"), ("stupid!!!", "stupid"), ("a$$$", "a"), ("", "")])
def test_fold(word, want):
    assert toxicity.fold(word) == want


def test_matcher_words_stems_and_exceptions():
    m = toxicity.Matcher({" scum ": 2.0, " lowei": 3.0, " trash ": 1.0}, ["trash can"])
    assert m.weight(toxicity.fold_text("Scum, of loweischaft")) == 5.0
    assert m.weight(toxicity.fold_text("scummy discum")) == 0.0
    assert m.weight(toxicity.fold_text("the trash can")) == 0.0
    assert m.weight(toxicity.fold_text("trash talk")) == 1.0
    assert toxicity.Matcher({}).weight(" scum ") == 0.0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    bad, stem = ["zork", "blarg"], ["x", "yen", "ung", "ado"]
    rows, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(150)}" for _ in range(rng.choice([8, 60, 300]))]
        toxic = i % 5 == 1
        if toxic:
            words[rng.randrange(8)] = rng.choice(bad) if i % 2 else "vequ" + rng.choice(stem)
        rows.append((i, " ".join(words), "clash", 0))
        labels.append((i, int(toxic)))
    rows += [(5000, None, "a", 1), (5001, "", "a", 1), (None, "Z0RK now", "a", 1), (5002, "fine words", "a", 1), (5002, "fine words", "a", 1), (5003, "w1 " * 40000 + "blarg", "a", 1)]
    labels += [(None, 1), (3, None), (3, 0), (99999, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learned_scores(spark, labelled):
    docs, labels = labelled
    model = toxicity.trained(spark, docs, labels)
    assert " zork " in model["lexicon"] and " vequ" in model["lexicon"]
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {i: i % 5 == 1 for i in range(900)} | {5000: False, 5001: False, None: True, 5002: False}
    wrong = [r for r in got if r.doc_id in truth and bool(r.predicted) != truth[r.doc_id]]
    assert len(wrong) <= 9
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(1 - r.predicted for r in got)


def test_without_labels_or_rows(spark, labelled):
    docs, labels = labelled
    model = toxicity.trained(spark, docs, labels.where("false"))
    assert model["lexicon"] == {} and toxicity.score(docs, model).count() == docs.count()
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.score(empty, toxicity.trained(spark, empty, labels)).count() == 0


def test_exceptions_are_learned(spark):
    rows = [(i, f"word{i} you zork word{i}", 1) for i in range(60)] + [(100 + i, f"a tame zork word{i}", 0) for i in range(60)] + [(200 + i, f"word{i} word{i + 1}", 0) for i in range(1000)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(sample)
    assert " zork " in model["lexicon"] and "tame zork" in model["exceptions"] and "you zork" not in model["exceptions"]
    got = {r.doc_id: r.predicted for r in toxicity.score(sample, model).collect()}
    assert all(got[i] == y for i, _, y in rows)


def test_known_insults_need_few_labels_and_yield_to_many(spark):
    few = [(i, "a moron said so" if i < 2 else f"plain words {i}", int(i < 2)) for i in range(12)]
    model = toxicity.fit(spark.createDataFrame(few, "doc_id long, text string, toxic int"))
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame([(1, "You IDI0T"), (2, "plain"), (3, None)], "doc_id long, text string"), model).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    many = [(i, f"a clown in ring {i}", 0) for i in range(60)] + [(100 + i, f"moron {i}", 1) for i in range(60)]
    model = toxicity.fit(spark.createDataFrame(many, "doc_id long, text string, toxic int"))
    assert " clown " not in model["lexicon"] and " moron " in model["lexicon"]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_held_out_rows(spark, sf_dir, sf):
    """Recall and precision on rows that the model never learned from."""
    folder = sf_dir.replace("sf0.001", sf)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.op8_toxicity(spark, folder).where("held_out").join(labels, "doc_id").join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    known = {toxicity.fold(w) for w in toxicity.INSULTS}
    insulting = [r for r in got if known & set(toxicity.fold_text(r.text or "").split())]
    assert got and all(r.predicted for r in insulting if r.toxic)
    alarms = [r for r in got if r.predicted]
    assert sum(r.toxic for r in alarms) >= 0.8 * len(alarms)
    if sf != "sf0.001":
        toxic = [r for r in got if r.toxic]
        assert len(toxic) >= 5 and sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
