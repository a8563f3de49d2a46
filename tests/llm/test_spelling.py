import random
import re
import zlib
from collections import Counter

import pytest

from shelfwise.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, key string"
TRANSLATE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TRANSLATE)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, pairs=None):
    near = {w: set() for w in counts}
    gone = {}
    for w in counts:
        for i in range(len(w)):
            gone.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    for (a, b), group in gone.items():
        for w in group:
            near[w] |= group - {w}
            if a + b in counts:
                near[w].add(a + b)
                near[a + b].add(w)
    out, form = set(), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]


@pytest.mark.parametrize("group", [2, 64])
def test_query_by_brute_force(spark, sf_dir, group, monkeypatch):
    monkeypatch.setattr(spelling.variants, "__defaults__", (10, group))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = rows_of(spelling.op13_spelling(spark, sf_dir))
    assert len(got) == len(set(got)) and set(got) == brute(count_words(docs))


@pytest.mark.parametrize("group", [2, 5, 64])
def test_pairs_by_brute_force(spark, group):
    rng = random.Random(group)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(2, 12))) for _ in range(300)}
    words |= {"common" + "".join(rng.choice("xyz") for _ in range(rng.randrange(2, 5))) for _ in range(200)} | {"aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "q" * 3000, "q" * 2999}
    got = [(r.a, r.b) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), group).collect()]
    want = {(a, b) for a in words for b in words if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    assert len(got) == len(want) and {tuple(sorted(p)) for p in got} == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "Straße×÷abc ABCDEFGH abcdefgh"), (3, "abcdefgh" * 3000), (3, "abcdefgh" * 3000), (4, "abcdefgh, " * 40), (5, "abcdefgi abcdefgi ŸĀabcdefgi"), (5, "abcdefgi"), (6, "1234 ...")]
    docs = spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], SCHEMA)
    got = rows_of(spelling.variants(spelling.word_counts(docs)))
    assert set(got) == brute(count_words(rows)) and ("abcdefgi", "abcdefgh", "abcdefgh") in {r[:3] for r in got}
    assert rows_of(spelling.variants(spelling.word_counts(docs.limit(0)))) == []


def test_chain_of_forms(spark):
    counts = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 10_000, "zzzzzzz": 3}
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert set(got) == brute(counts) and {r[2] for r in got} == {"aaabbbb", "zzzzzzz"}
