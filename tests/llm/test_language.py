import random

import numpy as np
import pyarrow as pa

from shelfwise.llm import language

SCHEMA = "doc_id long, text string, lang string, lang_pred int"


def texts(n=240):
    rng = random.Random(1)
    kinds = {"aa": ["the", "and", "ing", "of"], "bb": ["schön", "der", "und", "ßen"], "cc": ["кот", "это", "мир", "дом"]}
    return [(i, " ".join(rng.choice(kinds[k]) + rng.choice(["", "a", "en"]) for _ in range(rng.choice([5, 50, 400]))), k, 0) for i in range(n) for k in [["aa", "bb", "cc"][i % 3]]]


def test_gradients_match_differences():
    model = {k: (v.astype(np.float64) if k != "languages" else v) for k, v in language.start(["a", "b"]).items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 257, (6, 32)), rng.integers(0, 2, 6)
    _, grads = language.gradients(model, x, y)
    for name in grads:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in model[name].shape)
            if name == "embed":
                at = (int(x[0, rng.integers(0, 32)]), at[1])
            keep, eps = model[name][at], 1e-6
            model[name][at] = keep + eps
            up, _ = language.gradients(model, x, y)
            model[name][at] = keep - eps
            down, _ = language.gradients(model, x, y)
            model[name][at] = keep
            assert abs((up - down) / (2 * eps) - grads[name][at]) < 1e-4


def test_windows_hold_every_byte():
    values = ["", None, "é" * 100, "abc", "x" * 128, "y" * 300]
    x, doc = language.windows(pa.array(values))
    for d, v in enumerate(values):
        codes = x[doc == d].ravel()
        assert bytes(codes[codes < 256].astype(np.uint8)) == (v or "").encode()


def test_learned_languages(spark):
    rows = texts() + [(1000, None, "aa", 0), (1001, "", "aa", 0), (1002, "123 !? \n", "bb", 0), (None, "der schön und", "bb", 0), (1003, "the of and ing the", None, 0), (1004, "und der " * 30000, None, 0), (1004, "und der " * 30000, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = language.identify(docs, language.trained(docs)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {r[0]: r[2] for r in rows[:240]} | {None: "bb", 1003: "aa", 1004: "bb"}
    by = {r.doc_id: r.lang_pred for r in got}
    assert {by[i] for i in (1000, 1001, 1002)} == {"und"}
    assert sum(by[i] == k for i, k in truth.items()) / len(truth) > 0.97


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None, 0)], SCHEMA)
    assert [tuple(r) for r in language.identify(docs, language.trained(docs)).collect()] == [(1, "und", 0.0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert language.identify(empty, language.trained(empty)).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    got = language.op7_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.9
