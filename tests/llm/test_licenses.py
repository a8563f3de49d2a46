import sys

import duckdb

from shelfwise.llm import licenses

SCHEMA = "doc_id long, text string, w string, labels string"


def check(spark, rows):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    if rows:
        con.executemany("insert into documents values (?, ?)", [r[:2] for r in rows])
    cursor = con.execute(licenses.OP1_SQL)
    names = [c[0] for c in cursor.description]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA)).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(cursor.fetchall(), key=repr)
    return {r.doc_id: r for r in got}


def test_scan_against_sql(spark):
    filler = "lorem ipsum the license of version " * 40
    texts = [
        "Released under the MIT License. " + filler + "Under-the-MIT/license under the mit license",
        "Licensed under the Apache License, Version 2.0.\nThis work is licensed under the GNU General Public License, version 3.",
        "CC BY-NC, cc by nc 4.0 and cc by sa",
        "Permission is hereby granted, free of charge, to any human obtaining a copy of this software",
        "mit mit mit under the mit licence; ÀMIT under the mit license",
        "Redistribution and use in source and binary forms, changed, with or without modification, are permitted",
        "gnu general public license version 3",
        "", None, "...", "the " * 50_000 + "under the mit license",
        "licensed under the GNU Lesser General Public License, version 3",
    ]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(0, texts[0], "x", "y"), (None, texts[1], None, None)]
    got = check(spark, rows)
    assert (got[0].n_base, got[0].first_word, got[0].base_labels) == (3, 1, "mit")
    assert got[1].labels == "apache-2,gpl-3" and got[1].base_labels == "apache-2" and got[1].score == 1.0
    assert got[2].n_base == 2 and got[3].labels == "mit" and got[5].labels == "" and got[11].labels == "lgpl-3"
    assert got[10].first_word == 50_000 and got[8].score == 0.0 and got[8].first_word is None


def test_empty_table(spark):
    check(spark, [])


def test_query_against_sql_and_its_plan(spark, sf_dir):
    sys.path.insert(0, "tests")
    import oracle

    df = licenses.op1_licenses(spark, sf_dir)
    assert oracle.difference(df, oracle.connect(sf_dir), licenses.OP1_SQL) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
