import random
import sys

import duckdb
import pyarrow as pa
import pytest

from shelfwise.llm import repetition
from shelfwise.llm.common import Words

SCHEMA = "doc_id long, text string, kept string, n_words string"


def brute(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            k = 0
            while i != j and max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_longest_repeats(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abc" if seed % 2 else "abcdefghijklmnop") for _ in range(rng.choice([0, 1, 7, 60]))) for _ in range(8)] + ["x " * 40]
    words = Words(pa.array(texts), lower=False)
    assert repetition.repeats(words).tolist() == [n for t in texts for n in brute(t.split())]


def check(spark, rows):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in rows])
    cursor = con.execute(repetition.OP9_SQL)
    names = [c[0] for c in cursor.description]
    got = repetition.quality(spark.createDataFrame(rows, SCHEMA)).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_rules_against_sql(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(" ".join(rng.choice(["the", "a#", "of*", "é", "big", "dog", f"w{rng.randrange(400)}"]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 30))), "x", None) for i in range(60)]
    line = " ".join(f"u{i}" for i in range(130))
    rows += [(100, None, "a", "b"), (101, "", "a", "b"), (None, "id null " * 9, "a", "b"), (102, "same line\nsame line\n \n \nlast", "a", "b"), (103, f"{line}\n{line}", "a", "b"), (103, f"{line}\n{line}", "a", "b"), (104, line + " " + " ".join(f"v{i}" for i in range(3000)) + " " + line, "", ""), (105, "a\x0bb\x0cc\rd\x1ce", "", "")]
    check(spark, rows)


def test_empty_table(spark):
    assert repetition.quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_sql(spark, sf_dir):
    sys.path.insert(0, "tests")
    import oracle

    assert oracle.difference(repetition.op9_repetition(spark, sf_dir), oracle.connect(sf_dir), repetition.OP9_SQL) is None
