import random

import pyarrow as pa
import pytest

from shelfwise.llm import decontamination as dc

SCHEMA = "doc_id long, text string, item_id string, score int"
ITEMS = "item_id long, text string, doc_id string"


def sentence(rng, n, rare=True):
    return " ".join(rng.choice(["the", "of", "and", "in"]) if rng.random() < 0.4 else f"w{rng.randrange(5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    items = [(i, f"{sentence(rng, rng.choice([12, 30, 55]))}. {sentence(rng, 8)}.") for i in range(90)]
    items += [(500, None), (501, ""), (502, "one sentence with some rarewords zyx only"), (503, sentence(rng, 700) + ". " + sentence(rng, 9) + "."), (None, "null item"), (3, items[3][1])]
    docs = []
    for i in range(300):
        parts = [sentence(rng, rng.randrange(0, 200)) for _ in range(3)]
        if i % 5 == 0:
            parts[1] = rng.choice(items[:90])[1].upper().replace(" ", "\n", 3)
        docs.append((i, ". ".join(parts), "clash", 1))
    docs += [(900, None, "a", 1), (901, "", "a", 1), (902, "x " * 60000 + items[7][1] + " y" * 60000, "a", 1), (None, items[8][1], "a", 1), (903, items[503 - 413][1] or "", "a", 1), (904, items[93][1], "a", 1), (905, items[9][1], "a", 1), (905, items[9][1], "a", 1), (906, "One sentence, with some RAREWORDS zyx only!", "a", 1)]
    return docs, items


def brute(docs, items):
    """Every item's question and answer against every text, without an index."""
    wanted = {i: dc.question_and_answer(t) for i, t in items if i is not None and dc.tokens(t)}
    out = []
    for d, t, *_ in docs:
        words = dc.tokens(t)
        for i, (q, a) in wanted.items():
            both = dc.shingles(q) | dc.shingles(a)
            if both and dc.shingles_of(words, both) == both:
                out.append((d, i))
    return sorted(out, key=repr)


def test_finds_every_embedded_item(spark, tables):
    docs, items = tables
    got = dc.contaminated(spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame([(*i, "z") for i in items], ITEMS)).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == brute(docs, items)
    kept = dc.drop_contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(*i, "z") for i in items], ITEMS))
    assert kept.columns == ["doc_id", "text", "item_id", "score"]
    bad = {d for d, _ in brute(docs, items)}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((d[0] for d in docs if d[0] not in bad), key=repr)


def test_items_without_or_with_another_last_sentence(spark):
    rng = random.Random(31)
    questions = {i: sentence(rng, rng.choice([30, 55])) for i in range(40)}
    items = [(i, f"{q}. Yes w{i} surely.", "z") for i, q in questions.items()]
    docs, want = [], []
    for i, q in questions.items():
        half = " ".join(q.split()[: len(q.split()) * 2 // 5])
        for k, held in enumerate([q, f"{q}. Yes w{i} maybe.", f"{q}. Yes w{i} surely.", half, f"{half}. Yes w{i} surely."]):
            docs.append((10 * i + k, f"{sentence(rng, 40)}. {held}. {sentence(rng, 40)}", "a", 1))
            want += [(10 * i + k, i)] * (k < 3)
    got = dc.contaminated(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want
    assert all((r.answer_overlap == 1.0) == (r.doc_id % 10 == 2) for r in got)


def test_retrieval_equals_scoring_every_passage(tables):
    docs, items = tables
    index = dc.build_index([i for i in items if i[0] is not None])
    texts = [d[1] or "" for d in docs[:120]]
    found = {}
    import numpy as np

    ids = [np.array([index["vocabulary"].get(w, -1) for w in dc.tokens(t)], np.int64) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    for d, i, a, b, s in dc.retrieve(index, np.concatenate(ids), offsets):
        found[d, i, int(a - offsets[d])] = round(s, 9)
    want = {}
    for d, x in enumerate(ids):
        for block in index["blocks"]:
            stride = block["stride"]
            for c in range(max(1, -(-len(x) // stride))):
                present = set(x[c * stride : (c + 2) * stride].tolist())
                for i in block["items"]:
                    s = sum(v for w, v in index["impacts"][i].items() if w in present)
                    if s >= index["threshold"] - 1e-9:
                        want[d, i, c * stride] = round(min(1.0, s), 9)
    assert found == want and found


def test_parts_of_a_large_benchmark_cover_it(spark, tables):
    items = [(i, t, "z") for i, t in tables[1]]
    parts = list(dc.indexes(spark.createDataFrame(items, ITEMS), items=20))
    assert len(parts) > 1 and sorted(i for p in parts for i in p["items"]) == sorted({i for i, t, _ in items if i is not None and dc.tokens(t)})


def test_empty_tables(spark, tables):
    empty, none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    docs = spark.createDataFrame(tables[0][:5], SCHEMA)
    assert dc.contaminated(docs, none).count() == 0 and dc.drop_contaminated(docs, none).count() == 5
    assert dc.contaminated(empty, spark.createDataFrame([(1, "a b c", "z")], ITEMS)).count() == 0
    assert dc.matches(dc.build_index([(1, "a b c")]), pa.array([], pa.string())) == {}


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(((r.doc_id, r.item_id) for r in dc.op2_decontamination(spark, sf_dir).collect()), key=repr)
    assert got == brute(docs, items) and got
