import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import substrings
from shelfwise.llm.common import Words

SCHEMA = "doc_id long, text string, kept_text string, n_words int"


def brute(rows, window=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[k : k + window])
                least[g] = min(i, least.get(g, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, small):
    rng = random.Random(seed)
    vocabulary = ["a", "b"] if small else [f"w{i}" for i in range(300)] + ["é"] * 30
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 13, 14, 60]))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randrange(25))]
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", " \t"]).join(words)))
    return rows + [(5000, None), (5001, ""), (None, " ".join(passages[3])), (None, " ".join(passages[3])), (-7, " ".join(passages[4])), (6000, "x " * 40), (6001, "x " * 5000), (6001, "x " * 5000), (6002, "x " * 12)] + [(7000 + k, " ".join(passages[5])) for k in range(50)]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, small):
    rows = corpus(3 + small, small)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got = substrings.without_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=repr) == brute(rows)


def test_long_stretches_against_brute_force(spark):
    rng = random.Random(12)
    passages = [" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(20)]
    rows = [(1, "x " * 70000), (2, "start " + "x " * 70000), (3, "a b " * 70000), (4, "c " + "a b " * 70000)]
    rows += [(10 + k, f"{p} end{k} " + "x " * 20 + "a b " * 20) for k, p in enumerate(passages * 2)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = substrings.without_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=repr) == brute(rows)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(8)
    for alphabet in ("ab", "abcdefghijklmnopqrstuvwxyz"):
        shared = [rng.choice(alphabet) for _ in range(40)]
        texts = [" ".join([rng.choice(alphabet) for _ in range(rng.randrange(30))] + shared + [rng.choice(alphabet) for _ in range(rng.randrange(30))]) for _ in range(40)] + [" ".join(shared)]
        words = Words(pa.array(texts), lower=False)
        names = words.hashes()
        starts, anchor, alone = substrings.anchors(names, words.doc, words.offsets)
        seen = {}
        for s, a, x in zip(starts, anchor, alone):
            key = tuple(names[s : s + 13].tolist())
            assert seen.setdefault(key, (int(a), bool(x))) == (int(a), bool(x))
        assert alone.mean() < (0.6 if alphabet == "ab" else 0.1)


def test_packing_round_trip():
    columns = [np.arange(5, dtype=np.uint64), np.empty(0, "<u4"), np.array([1, 2], "<u2"), np.frombuffer(b"xyz", np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(columns, substrings.unpacked(substrings.packed(*columns))))


def test_empty_table(spark):
    assert substrings.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in substrings.op5_substrings(spark, sf_dir).collect()), key=repr) == brute(rows)
