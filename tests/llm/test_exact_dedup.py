import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import exact_dedup
from shelfwise.llm.exact_dedup import CuckooFilter, Index, Part

SCHEMA = "doc_id long, text string, digest string, part int, n long"


def digest_of(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", text or "").encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 7)))) for i in range(400)]
    out += [(1000 + i, "hot\ttext " + " " * (i % 7)) for i in range(300)]
    out += [(2000, None), (2001, ""), (2002, " \n "), (None, "a  b"), (None, "lonely"), (2003, "x" * 300_000), (2004, "x" * 150_000 + "\x0c" + "x" * 150_000), (2005, "no break"), (2006, "nobreak")]
    return out


def test_filter_finds_removes_and_fills_up():
    rng = random.Random(1)
    f, added = CuckooFilter(64), []
    while f.add(h := rng.getrandbits(64)):
        added.append(h)
    assert len(added) > 64 * 4 * 0.85
    # The one that found no slot has pushed out at most one of the others.
    assert sum(f.find(h) < 0 for h in added) <= 1
    again = CuckooFilter(table=f.packed())
    assert again.table == f.table
    for h in added[:100]:
        again.remove(h)
    assert sum(again.find(h) >= 0 for h in added[:100]) <= 5 and sum(again.find(h) < 0 for h in added[100:]) <= 5


def test_part_resizes_and_verifies(monkeypatch):
    monkeypatch.setattr(exact_dedup, "FIRST_BUCKETS", 1)
    part, pack = Part(), lambda t: exact_dedup.pa.compress(t, codec="zstd", asbytes=True)
    part.filter = CuckooFilter(1)
    texts = [str(i).encode() for i in range(3000)]
    for t in texts + texts[:50]:
        part.insert(hashlib.sha256(t).hexdigest(), 1, pack(t), len(t))
    assert part.live == 3000 and part.filter.buckets >= 750
    # The same digest with other content is no hit.
    digest = hashlib.sha256(b"7").hexdigest()
    assert part.entry(digest, pack(b"7"), 1)[1] == 2 and part.entry(digest, pack(b"8"), 1) is None
    for t in texts:
        part.delete(hashlib.sha256(t).hexdigest(), 2, pack(t), len(t))
    assert part.live == 0 and not any(part.content.values()) and not any(part.filter.table)


def test_groups_by_brute_force(spark, rows):
    out, _ = exact_dedup.resolved(frame(spark, rows).select("doc_id", "text"))
    groups = {}
    for i, t in rows:
        groups.setdefault(digest_of(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = sorted([(i, min(groups[digest_of(t)])[3], len(groups[digest_of(t)]), digest_of(t)) for i, t in rows], key=repr)
    got = sorted([(r.doc_id, r.keep_id, r.group_size, r.digest) for r in out.collect()], key=repr)
    assert got == want


def test_deduplicated_keeps_one_row_of_each_group(spark, rows):
    docs = frame(spark, rows + [(3000, "twin"), (3000, "twin"), (3000, "t win")])
    got = exact_dedup.deduplicated(docs)
    assert got.schema == docs.schema
    kept = got.collect()
    assert sorted(digest_of(r.text) for r in kept) == sorted({digest_of(t) for _, t in rows} | {digest_of("twin")})
    assert [(r.doc_id, r.text) for r in kept if digest_of(r.text) == digest_of("twin")] == [(3000, "t win")]
    twins = exact_dedup.deduplicated(frame(spark, [(1, "a")] * 3)).collect()
    assert [(r.doc_id, r.text) for r in twins] == [(1, "a")]


def test_insert_and_delete(spark):
    first, report = Index(parts=3).insert(frame(spark, [(i, f"t{i % 40}") for i in range(100)]))
    assert {(r.digest, r.live) for r in report.collect()} == {(digest_of(f"t{k}"), 3 if k < 20 else 2) for k in range(40)}
    second, report = first.insert(frame(spark, [(200, "t 1"), (201, "new")]))
    assert {(r.digest, r.live) for r in report.collect()} == {(digest_of("t1"), 4), (digest_of("new"), 1)}
    third, report = second.delete(frame(spark, [(1, "t1"), (201, "new"), (9, "never seen"), (20, "t20"), (60, "t20")]))
    assert {(r.digest, r.live) for r in report.collect()} == {(digest_of("t1"), 3), (digest_of("new"), 0), (digest_of("never seen"), 0), (digest_of("t20"), 0)}
    live = {r.digest: r.n for r in third.live().collect()}
    assert live == {digest_of(f"t{k}"): (3 if k < 20 else 2) for k in range(40) if k != 20}
    fourth, report = third.insert(frame(spark, [(300, "t20")]))
    assert [(r.live, r.doc_id) for r in report.collect()] == [(1, 300)]
    # The filters hold one fingerprint for each live digest.
    filters = fourth.rows.where(F.col("kind") == exact_dedup.FILTER).collect()
    assert sum(sum(map(bool, CuckooFilter(table=bytes(r.content)).table)) for r in filters) == 40
    for index in (first, second, third, fourth):
        index.drop()


def test_no_rows(spark):
    empty = frame(spark, [(1, "a")]).where("false")
    assert exact_dedup.resolved(empty.select("doc_id", "text"))[0].count() == 0 and exact_dedup.deduplicated(empty).count() == 0
