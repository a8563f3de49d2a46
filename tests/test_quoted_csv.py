"""Quoted CSV cut into many splits against Python's csv module."""

import csv
import io
import random

import pyarrow as pa
import pytest

from shelfwise.sources import quoted_csv
from shelfwise.sources.quoted_csv import read_quoted_csv


def write(path, rows, stray=False):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["id", "text", "odd `name`"])
    writer.writerows(rows)
    path.write_text(out.getvalue() + ('tail,5" disk,a"b"\n' if stray else ""))


def made(n, seed):
    rng = random.Random(seed)
    pick = ["plain", 'say ""', '"', "two\nlines", "\n\n", "a,b", 'x"\n"y', "", "é\n", "end\n"]
    return [(str(i), " ".join(rng.choice(pick) for _ in range(rng.randrange(1, 6))), rng.choice(pick)) for i in range(n)]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cells(df):
    return sorted(tuple(v or "" for v in r) for r in df.collect())


def test_many_splits_of_one_file(spark, tmp_path, small_splits):
    rows = made(400, 1) + [("900", "long\n" * 2000, 'ends"'), ("901", "after", "it")]
    write(tmp_path / "a.csv", rows)
    df = read_quoted_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id", "text", "odd `name`"]
    assert cells(df) == sorted(rows)
    # The one file is read by many tasks, though rows cross their edges.
    states = quoted_csv.split_states(quoted_csv._lines(spark, str(tmp_path / "a.csv"))).collect()
    assert len(states) > 20 and sum(r.inside for r in states) > 10
    assert quoted_csv._lines(spark, str(tmp_path / "a.csv")).rdd.getNumPartitions() > 20


def test_files_of_a_folder_and_stray_quotes(spark, tmp_path, small_splits):
    rows = [made(60, s) for s in (2, 3, 4)]
    for i, part in enumerate(rows):
        write(tmp_path / f"p{i}.csv", part, stray=i == 1)
    got = cells(read_quoted_csv(spark, str(tmp_path)))
    assert got == sorted(sum(rows, []) + [("tail", '5" disk', 'a"b"')])


def test_as_one_task_reads_it(spark, tmp_path):
    write(tmp_path / "a.csv", made(200, 5))
    (tmp_path / "b.csv").write_text('id,text,odd `name`\r\n1,"x\r\ny",\r\n\r\n2,short\n3,"open')
    whole = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path))
    got = read_quoted_csv(spark, str(tmp_path))
    assert cells(got.where("id > 3 or id is null")) == cells(whole.where("id > 3 or id is null"))
    assert {r.id for r in got.collect()} == {r.id for r in whole.collect()}


def test_line_steps():
    lines = ['a,b', '"', 'x"', '"a","b', 'b",c', '"a""b"', 'a"b', '""', ',"', '"a"b,"c']
    outside, inside = quoted_csv._steps(pa.array(lines))
    assert outside.tolist() == [False, True, False, True, False, False, False, False, True, True]
    assert quoted_csv._walk(pa.array(['a,"x', "y", 'z",b', "c"]), False).tolist() == [True, True, False, False]
    assert quoted_csv._walk(pa.array(["y", 'z",b']), True).tolist() == [True, False]
    assert inside.tolist()[:3] == [True, False, False]


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("id,text\n")
    assert read_quoted_csv(spark, str(tmp_path)).count() == 0
