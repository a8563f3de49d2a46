"""Compare a query's rows with its SQL twin, whatever their order."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _normal(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(df, con, sql):
    """None where both agree, else a short account of the first difference."""
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if have[0] != want[0]:
        return f"columns {have[0]} != {want[0]}"
    if len(have[1]) != len(want[1]):
        return f"{len(have[1])} rows != {len(want[1])}"
    for a, b in zip(have[1], want[1]):
        if a != b:
            return f"{have[0]}: {a} != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"{have[0]}: types of {a} != {b}"
    return None
