import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from shelfwise.llm import eliasfano, lm

SCHEMA = "doc_id long, text string, score string, key int"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


def base(rows, train):
    c = collections.Counter(t for _, x in train for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return [(i, len(tokens(x)), sum(t in c for t in tokens(x)), n, round(sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 6)) for i, x in rows]


def test_elias_fano_finds_exactly_its_members():
    rng = np.random.default_rng(2)
    for top, n in ((2**63, 5000), (4000, 3000), (2**40, 1), (70, 64), (2**64 - 1, 300)):
        values = np.unique(rng.integers(0, top, n, np.uint64))
        code = eliasfano.encode(values)
        assert (eliasfano.find(code, values) == np.arange(len(values))).all()
        others = np.setdiff1d(rng.integers(0, top, 4000, np.uint64), values)
        assert (eliasfano.find(code, others) == -1).all()


def test_elias_fano_reads_back_and_packs():
    rng = np.random.default_rng(6)
    for values in (np.sort(rng.integers(0, 5000, 3000, np.uint64)), np.zeros(10, np.uint64), np.sort(rng.integers(0, 2**50, 200, np.uint64))):
        assert (eliasfano.access(eliasfano.encode(values), np.arange(len(values))) == values).all()
    values = rng.integers(0, 2**37, 70_000, np.uint64)
    assert (eliasfano.low_bits(eliasfano.pack_bits(values, 37), 37, np.arange(len(values))) == values).all()
    assert (lm.unpacked(lm.packed(values), len(values)) == values).all()


def test_successors_lie_behind_their_contexts_pointers():
    below = lm.Level([{"block": 0, "n": 6, "total": 60, "file": ""}, {"block": 1, "n": 4, "total": 9, "file": ""}])
    goal = lm.Level([], below, rows=[3, 1], words=10)
    keys = np.array([3, 7, 21, 22, 29, 40, 58], np.uint64)  # context times ten plus word
    assert goal.numbered(keys).tolist() == [0, 2, 0, 0, 2, 0, 2] and goal.numbered(np.array([61, 99], np.uint64)).tolist() == [3, 3]
    code = goal.encoded(keys)
    assert eliasfano.access(code, np.arange(7)).tolist() == [0, 2, 2, 5, 5, 6, 7]
    wanted = np.arange(0, 100, dtype=np.uint64)
    at = goal.search(code, wanted)
    assert wanted[at >= 0].tolist() == keys.tolist() and at[at >= 0].tolist() == list(range(7))


def test_search_in_divided_rows_takes_few_reads(tmp_path, monkeypatch):
    """successors of a row's later blocks were guessed as if the block held all word numbers."""
    rng, words, cuts = np.random.default_rng(8), 1 << 20, 4
    below = lm.Level([{"block": 0, "n": words, "total": 1 << 23, "file": ""}])
    goal = lm.Level([], below, rows=[cuts], words=words)
    # Contexts with none, some and very many successors, and one with every word number from the middle on.
    parts = [(c, np.sort(rng.choice(words, n, replace=False))) for c, n in ((3, 1), (5, 40), (6, 30_000), (9, 7), (40, 200_000))] + [(41, np.arange(words // 2, words // 2 + 5000))]
    keys = np.concatenate([c * words + w for c, w in parts]).astype(np.uint64)
    blocks = []
    for k in range(cuts):
        own = keys[goal.numbered(keys) == k]
        lm.written(f"{tmp_path}/{k}", {**goal.encoded(own), "count": np.arange(len(own)).astype("<u4"), "prob": np.zeros(len(own), np.uint8)})
        blocks.append({"block": k, "n": len(own), "total": len(own), "file": f"{tmp_path}/{k}"})
    level = lm.Level(blocks, below, rows=[cuts], words=words)
    reads, low_bits = [], eliasfano.low_bits
    monkeypatch.setattr(eliasfano, "low_bits", lambda low, width, at: (reads.append(len(at)), low_bits(low, width, at))[1])
    asked = np.concatenate([keys, rng.integers(0, 45 * words, 100_000, np.uint64)])
    node = level.find(asked)[0]
    number, place = level.numbered(keys), np.empty(len(keys), np.int64)
    for k in range(cuts):
        place[number == k] = level.bases[k] + np.arange((number == k).sum())
    want = dict(zip(keys.tolist(), place.tolist()))
    assert node.tolist() == [want.get(x, -1) for x in asked.tolist()]
    assert sum(reads) < 5 * len(np.unique(asked))


def test_ones_and_zeros_are_found_where_they_lie():
    rng = np.random.default_rng(9)
    for share in (0.01, 0.5, 0.97):
        bits = (rng.random(64 * 300) < share).astype(np.uint8)
        bits[64 * 10 : 64 * 20], bits[64 * 30 : 64 * 40] = 0, 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        for flip in (False, True):
            places = np.flatnonzero(bits != flip)
            before = np.concatenate([[0], np.cumsum((bits != flip).reshape(-1, 64).sum(axis=1))])
            rank = np.arange(len(places))
            assert (eliasfano.select_one(words, before, rank, flip) == places).all()
            assert (eliasfano.next_one(words, before, rank[:-1], places[:-1], flip) == places[1:]).all()


def test_small_blocks_give_the_same_scores(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    score = lambda: sorted((tuple(r) for r in lm.score(docs, lm.trained(docs)).collect()), key=repr)
    want = score()
    # Few tokens a block and few open blocks: every context is spread over several.
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(lm, "OPEN_BLOCKS", 2)
    assert lm.trained(docs)[1]["rows"] != [1] * len(lm.trained(docs)[1]["rows"]) and score() == want


def corpus():
    rng = random.Random(3)
    return [(i, " ".join(rng.choice(["The", "cat", "sat", "on", "a", "mat", f"w{rng.randrange(60)}"]) for _ in range(rng.choice([0, 1, 9, 90])))) for i in range(120)] + [(500, None), (501, ""), (None, "the cat"), (502, "cat " * 30000), (700, "again"), (700, "again")]


def test_scores_against_counts(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    trie = lm.trained(docs)
    got = lm.score(docs, trie).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == sorted(base(rows, rows), key=repr)
    # The model again, from plain counts; quantising may cost half a step a token.
    grams = [collections.Counter(g for _, x in rows for t in [tokens(x)] for g in zip(*[t[k:] for k in range(n)])) for n in (1, 2, 3)]
    n, v = sum(grams[0].values()), len(grams[0])

    def prob(t, k):
        p = (grams[0][t[k : k + 1][0],] + 0.5) / (n + 0.5 * (v + 1))
        for size in (2, 3):
            if k < size - 1:
                break
            gram = tuple(t[k - size + 1 : k + 1])
            kept = lambda g: grams[len(g) - 1][g] >= (1 if len(g) == 1 else lm.LEAST)
            if not kept(gram[:-1]):
                break
            share = grams[size - 1][gram] / grams[size - 2][gram[:-1]] if kept(gram) else 0
            p = lm.WEIGHT * share + (1 - lm.WEIGHT) * p
        return p

    want = {i: sum(math.log10(prob(t, k)) for k in range(len(t))) for i, x in rows for t in [tokens(x)]}
    for r in got:
        assert abs(r.score - want[r.doc_id]) <= lm.QUANTUM * r.n_tokens + 1e-6


def test_ngrams_that_occur_once(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(8))) for i in range(20)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = lm.score(docs, lm.trained(docs)).collect()
    # Every word and n-gram occurs once, the end twenty times; 180 tokens, 161 words.
    once, end = 1.5 / (180 + 0.5 * 162), 20.5 / (180 + 0.5 * 162)
    after = lambda p, n: p if n == 0 else lm.WEIGHT + (1 - lm.WEIGHT) * after(p, n - 1)
    want = sum(math.log10(after(end if k == 8 else once, min(k, 2))) for k in range(9))
    assert len(got) == 20 and all(abs(r.score - want) <= lm.QUANTUM * 9 for r in got)


def test_elias_fano_in_pieces():
    values = np.unique(np.random.default_rng(4).integers(0, 2**50, 150_000, np.uint64))
    code = eliasfano.encode(values)
    assert (eliasfano.find(code, values) == np.arange(len(values))).all()


def test_counts_beyond_32_bits(spark, tmp_path):
    many = 5 << 32

    def level(counts, levels):
        plan = lm.planned(levels, 3)
        rows = lm.pieces(plan, np.array(list(counts), np.uint64), np.array(list(counts.values())))
        return lm.add_level(spark.createDataFrame(pa.Table.from_batches([rows])), levels, plan, str(tmp_path))

    one = level({k: many if k == 7 else 3 for k in range(20)}, [])
    two = level({7 * 20 + 8: many // 4}, [one])
    assert one.find(np.array([7, 8, 99], np.uint64))[1].tolist() == [many, 3, 0] and one.total == many + 19 * 3
    _, count, prob = two.find(np.array([148], np.uint64))
    want = lm.WEIGHT * 0.25 + (1 - lm.WEIGHT) * 10 ** lm.unigram_log(3, one.total, one.size)
    assert count.tolist() == [many // 4] and prob.tolist() == [lm.quantised(np.log10(want))]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 1)], SCHEMA)
    trie = lm.trained(docs.where("false"))
    assert trie == [] and lm.score(docs, trie).first().n_known == 0
    assert lm.score(docs.where("false"), lm.trained(docs)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    got = lm.op3_lm(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(base(rows, [r for r in rows if not out(r[0])]))
    assert all(r.held_out == out(r.doc_id) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
