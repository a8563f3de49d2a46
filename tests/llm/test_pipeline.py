import pathlib
import random
import time

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import decontamination, simhash

SCHEMA = "doc_id long, text string, lang string, row long, component int"


def test_near_duplicates_by_shingles(spark):
    rng = random.Random(6)
    rows, groups = [], []
    for g in range(40):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 80, 300]))]
        for c in range(rng.choice([1, 2, 3])):
            copy = list(words)
            if c and len(copy) > 50:
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy), "en", 0, 0))
            groups.append(g)
    rows += [(900, "", "x", 0, 0), (901, None, "x", 0, 0), (None, " \n", "x", 0, 0), (902, "same row here", "x", 0, 0), (902, "same row here", "x", 0, 0), (903, "a b c d", None, 0, 0), (904, "a b c e", None, 0, 0)]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got.columns == ["doc_id", "text", "lang", "row", "component"]
    first = {}
    for i, g in enumerate(groups):
        first.setdefault(g, i)
    kept, want = {r.doc_id for r in got.collect()}, {*first.values(), 900, 902, 903, 904}
    assert want <= kept and got.count() == len(kept)
    # SimHash is a net with holes at its edge: a copy beyond the radius stays.
    assert len(kept - want) <= 2


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_alike_by_brute_force():
    rng = random.Random(3)
    pool = [{rng.randrange(9000) for _ in range(rng.choice([0, 5, 60, 6000]))} for _ in range(12)]
    sets = [set(rng.sample(sorted(s), int(len(s) * rng.choice([0.75, 0.9, 1])))) for s in pool for _ in range(4)]
    near = simhash.alike([np.array(sorted(s), np.int64) for s in sets], 0.8)
    assert near.tolist() == [[a is b or jaccard(a, b) >= 0.8 for b in sets] for a in sets]
    label, reach = simhash.classes(near), near
    for _ in sets:
        reach = reach @ near
    assert label.tolist() == reach.argmax(1).tolist()


def test_groups_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 10)
    rng = random.Random(8)
    words = [f"w{rng.randrange(4000)}" for _ in range(400)]
    rows = []
    for i in range(60):
        copy = list(words)
        copy[rng.randrange(400)] = f"changed{i}"
        rows.append((2**60 + i if i else None, " ".join(copy), "en", i, 0))
    rows += [(5, " ".join(words), "x", i, 0) for i in range(30)] + [(1, "quite another text", "x", 0, 0)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 5]


def brute(rows, size=5):
    """The smallest id of every group of texts linked by a Jaccard similarity of 0.8, from all pairs."""
    words = [t.lower().split() for _, t, *_ in rows]
    sets = [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set() for w in words]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and (a := jaccard(sets[i], sets[j])) >= 0.8:
                label = [label[j] if x == label[i] else x for x in label]
    return sorted({min(r[0] for r, x in zip(rows, label) if x == own) for own in label})


def edited(rng, words):
    """Scattered words, one passage or the tail replaced, near the limit of 0.8."""
    copy, n = list(words), len(words)
    kind = rng.randrange(3)
    if kind == 0:
        for k in rng.sample(range(n), max(1, n // 60)):
            copy[k] = f"new{rng.randrange(9999)}"
    elif kind == 1:
        a = rng.randrange(n - n // 11)
        copy[a : a + n // 12] = [f"new{rng.randrange(9999)}" for _ in range(n // 12)]
    else:
        copy += [f"new{rng.randrange(9999)}" for _ in range(rng.randrange(n // 6, n // 4 + 2))]
    return copy


def test_all_pairs_by_brute_force(spark):
    rng = random.Random(21)
    rows = []
    footer = [f"footer{k}" for k in range(30)]
    for _ in range(50):
        words = [f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(rng.choice([40, 120, 400]))] + footer
        for copy in [words] + [edited(rng, words) for _ in range(rng.choice([0, 1, 2]))]:
            rows.append((len(rows), " ".join(copy), "en", 0, 0))
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(r.doc_id for r in got) == brute(rows)


def test_no_rows(spark):
    assert simhash.drop_near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stages_in_turn(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "token files"]
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    clean = corpus_pipeline.clean(spark, docs, sf_dir)
    assert clean.columns == columns and len({r.doc_id for r in clean.collect()} & toxic) <= 2
    apart = corpus_pipeline.dedup(spark, docs, sf_dir)
    assert apart.columns == columns and apart.groupBy("text").count().where("count > 1").count() == 0
    free = corpus_pipeline.decontaminate(spark, docs, sf_dir)
    held = decontamination.op2_decontamination(spark, sf_dir).select("doc_id").distinct()
    assert free.columns == columns and free.count() == docs.count() - held.count()


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    total = out.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert total[0] == total[1] > 0


def test_large_groups_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 4)
    rng = random.Random(5)
    rows = []
    for _ in range(8):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        # A chain: neighbours are alike, its ends are not.
        for k in range(14):
            rows.append((len(rows), " ".join(words), "en", 0, 0))
            words[k * 20 : k * 20 + 20] = [f"new{rng.randrange(9999)}" for _ in range(20)]
    rows += [(len(rows) + k, t, "en", 0, 0) for k, t in enumerate(["", " ", "\n", "\t", "  ", " \n", "\n\n"])]
    rng.shuffle(rows)
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(r.doc_id for r in got) == brute(rows)


def test_look_alike_rows_with_nulls_stay_apart(spark):
    rows = [(5, None, "x", 0, 0), (None, "5", "x", 0, 0), (6, "6 x", None, 0, 0), (6, "6", "x", 0, 0)]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, t) for i, t, *_ in rows), key=str)


def test_parities_by_brute_force(spark):
    rng = random.Random(17)
    pairs = []
    for n in (0, 1, 50, 63, 64, 65, 128, 129, 900, 3000):
        for _ in range(12):
            a = {rng.randrange(-(2**63), 2**63) for _ in range(n)}
            b = set(list(a)[: int(n * rng.choice([0, 0.5, 0.8, 0.9, 1]))]) | {rng.randrange(-(2**63), 2**63) for _ in range(rng.choice([0, 1, n // 9, n // 2, n, 5 * n]))}
            pairs.append((len(a ^ b), len(a) + len(b), *(simhash.parities(np.array(sorted(s), np.int64)).tolist() for s in (a, b))))
    rows = spark.createDataFrame(pairs, "apart long, total long, x array<long>, y array<long>").select("apart", "total", simhash.least_apart("x", "y").alias("least")).collect()
    # Never too many, and enough to tell texts apart that have little in common.
    assert len(rows) == len(pairs) and all(0 <= r.least <= r.apart for r in rows)
    assert all(r.least == r.apart for r in rows if r.apart <= 1)
    like = [r for r in rows if r.total > 1000 and r.apart > 0.4 * r.total and r.least > 0]
    assert like and all(r.least > r.total / 9 for r in like)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_near_duplicates_leave_little_on_disk(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for _ in range(60):
        # A passage that two texts share makes a candidate that is not near.
        words = [f"w{rng.randrange(10**6)}" for _ in range(1000)]
        rows += [(len(rows) + k, " ".join(t), "en", 0, 0) for k, t in enumerate([words, words[:600] + [f"x{rng.randrange(10**6)}" for _ in range(400)]])]
    words[500] = "changed"
    rows.append((len(rows), " ".join(words), "en", 0, 0))
    folder, seen, plain = pathlib.Path(spark.conf.get("spark.checkpoint.dir")), [], simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, name: seen.append((name, (out := plain(df, name)).count())) or out)
    before = set(folder.iterdir())
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert "gone" in left and not left & {"entries", "prefixes", "shared", "candidates", "sets"}
    assert sum(n for name, n in seen if name == "candidates") <= 2 and got.count() == len(rows) - 1
    # Shuffle files of the stage's own writes go without waiting for the driver's garbage.
    with simhash.short_lived_shuffles(spark):
        files = shuffle_files(spark)
        plain(spark.range(1000).repartition(7, "id"), "dealt")
        for _ in range(50):
            if shuffle_files(spark) <= files:
                break
            time.sleep(0.1)
        assert shuffle_files(spark) <= files
