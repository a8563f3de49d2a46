import random

import numpy as np
import pytest
import xxhash

from shelfwise.llm import simhash
from shelfwise.llm.components import components

SCHEMA = "doc_id long, text string, fp string, bucket long"


def brute_print(text, size=3):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(ids, fps, radius=3):
    label = list(range(len(fps)))
    arr = np.array(fps, np.uint64)
    changed = True
    near = [np.flatnonzero(np.bitwise_count(arr ^ f) <= radius) for f in arr]
    while changed:
        changed = False
        for i, n in enumerate(near):
            low = min(label[j] for j in n)
            if low < label[i]:
                label[i] = low
                changed = True
    best = {}
    for i, root in zip(ids, label):
        if i is not None:
            best[root] = min(i, best.get(root, i))
    return [best.get(r) for r in label]


def test_every_pair_within_the_radius_shares_a_mask():
    rng = random.Random(1)
    for radius in (1, 3, 5):
        found = [m % (1 << 64) for m in simhash.masks(radius, 0)]
        assert len(found) == 2 ** (radius + 1) - 1
        for _ in range(300):
            x = rng.getrandbits(64)
            y = x
            for b in rng.sample(range(64), radius):
                y ^= 1 << b
            assert any(x & m == y & m for m in found)


def test_fingerprints_and_components(spark):
    rng = random.Random(4)
    vocabulary = [f"W{i}é" for i in range(400)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 40, 900]))]
        for c in range(rng.choice([1, 1, 2, 4])):
            copy = list(words)
            if c and len(copy) > 30:
                copy[rng.randrange(len(copy))] = "x"
            rows.append((len(rows) + 1, "\t".join(copy), "clash", 5))
    rows += [(900, None, "a", 1), (901, "", "a", 1), (902, " \n", None, 1), (None, "null id", "a", 1), (3, "again 3", "a", 1), (3, "again 3", "a", 1), (None, None, "a", 1)]
    got = simhash.linked(simhash.fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()
    fps = [brute_print(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], fps, brute_components([r[0] for r in rows], fps)), key=repr)
    assert sorted(((g.doc_id, g.fp % (1 << 64), g.component_id) for g in got), key=repr) == want


def test_large_buckets_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 4)
    rng = random.Random(2)
    centre = rng.getrandbits(63)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(63), rng.choice([1, 2, 3]))) for _ in range(60)} | {rng.getrandbits(63) for _ in range(200)})
    ids = list(range(10, 10 + len(fps)))
    got = simhash.linked(spark.createDataFrame(list(zip(ids, fps)), "doc_id long, fp long")).collect()
    want = dict(zip(ids, brute_components(ids, fps)))
    assert {g.doc_id: g.component_id for g in got} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 140)} == {100} and got[201] == 200


def test_empty_table(spark):
    assert simhash.linked(simhash.fingerprints(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fps = [brute_print(d.text) for d in docs]
    want = brute_components([d.doc_id for d in docs], fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op4_simhash(spark, sf_dir).collect()}
    assert got == {d.doc_id: (f"{f:016x}", c) for d, f, c in zip(docs, fps, want)}
