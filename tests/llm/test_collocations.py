import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import collocations

SCHEMA = "text string, lang string, phrase string, n string, score int"
TRANSLATE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, report):
    f = {}
    for text, lang in rows:
        counts = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(TRANSLATE)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for g, c in counts.items() if len(g) == 1)
        wanted = {g: c for g, c in counts.items() if len(g) > 1 and c >= least}
        dropped = {g[i:j] for g, c in wanted.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g) and 100 * c >= 80 * counts[g[i:j]]}
        rows = []
        for g, a in wanted.items():
            if g not in dropped:
                score, k = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n, -s) for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:report], 1)]
    return sorted(out)


def got_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for lang, vocabulary in (("en", 60), ("de", 12), (None, 6), ("und", 6)):
        fixed = [[f"W{rng.randrange(vocabulary)}" for _ in range(rng.randrange(2, 7))] for _ in range(10)]
        for _ in range(150):
            words = []
            for _ in range(rng.randrange(1, 12)):
                words += rng.choice(fixed) if rng.random() < 0.5 else [f"w{int(rng.paretovariate(0.8)) % vocabulary}é"]
                words += rng.choice([[], [], ["\n"], [". "], [","], ["\t"]])
            out.append((" ".join(words), lang))
    return out + [(None, "en"), ("", "fr"), (" ;.. ", None), ("same words here " * 5000, "es"), ("same words here " * 5000, "es")]


@pytest.mark.parametrize("least, report, ahead, bits", [(3, 20, 1, 1 << 20), (3, 2000, 4, 1 << 20), (5, 7, 2, 64), (1, 40, 1, 1 << 16)])
def test_by_brute_force(spark, rows, least, report, ahead, bits):
    docs = spark.createDataFrame([(t, lang, "clash", "x", 1) for t, lang in rows], SCHEMA).repartition(4)
    got = got_of(collocations.collocations(docs, least, report, ahead, bits))
    assert got == brute(rows, least, report)


def test_scores_beyond_64_bits(spark):
    a, total = 3_000_000_000_000_000_001, 6_000_000_000_000_000_005
    got = spark.range(1).select(collocations.ratio(F.lit(a), F.lit(total)).alias("s"), collocations.ratio(F.lit(7), F.lit(14)).alias("one")).first()
    assert (got.s, got.one) == (2000000 * a // total, 1000000)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None, None, None, None), ("a b", "en", None, None, None)], SCHEMA)).count() == 0
