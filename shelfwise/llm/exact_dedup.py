"""Exact duplicates by a cuckoo-filter index over live digests.

The index is a table in parts by digest. A part has three kinds of rows: its
filter (four slots a bucket, 16-bit fingerprints, two buckets for each digest,
the second from the first and the fingerprint), its live digests with their
copies, and their content, packed, under the digest's bucket. Inserting sends
every digest to its part and asks the filter: a miss is new for certain, a hit is
compared with the content in its bucket, so a fingerprint shared by chance never
joins two texts. An insertion that finds no slot after ``KICKS`` moves doubles
the filter and fills it again from the stored digests. Deletion takes copies away
and, with the last one, the digest, its fingerprint and its content.

A slice of texts first merges its own copies, so a text that fills a third of all
rows reaches its part once a slice. Content travels packed. A part's rows
arrive in order and one after another; only one part's live content is held.
Every insertion or deletion writes a new table, so a lost task is just run again.

Null texts count as empty. Empty texts, and those of white space alone, are equal.
Of equal texts the row with the most code points, then the smallest id (null ids
last) stays. Rows that also agree in both are the same to this order: all of them
are marked as staying, while ``deduplicated`` keeps one. Very long texts are
taken whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import bounded, drop_stored, stored, table
from shelfwise.llm.runs import byte_set, text_bytes

SLOTS = 4
FIRST_BUCKETS = 64
KICKS = 200
PARTS_PER_SPLIT = 4
CODEC = "zstd"
WHITE = byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
FILTER, LIVE, ADDED = 0, 1, 2
ROWS = "part int, kind int, digest string, n long, content binary, size long, n_chars long, doc_id long, ties long"
NAMES = [c.split()[0] for c in ROWS.split(", ")]


class CuckooFilter:
    """Fingerprints of 64-bit hashes in buckets of four; ``add`` is false when the table is too full."""

    def __init__(self, buckets: int = FIRST_BUCKETS, table: bytes | None = None):
        self.buckets = buckets
        self.table = list(np.frombuffer(table, "<u2")) if table else [0] * (buckets * SLOTS)
        if table:
            self.buckets, self.table = len(self.table) // SLOTS, [int(x) for x in self.table]

    @staticmethod
    def fingerprint(h: int) -> int:
        return (h >> 48) or 1

    def home(self, h: int) -> int:
        return h & (self.buckets - 1)

    def other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def slot(self, bucket: int, mark: int) -> int:
        """Where a bucket holds a value (0: a free slot); -1 if nowhere."""
        for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if self.table[at] == mark:
                return at
        return -1

    def find(self, h: int) -> int:
        mark, home = self.fingerprint(h), self.home(h)
        at = self.slot(home, mark)
        return at if at >= 0 else self.slot(self.other(home, mark), mark)

    def add(self, h: int) -> bool:
        mark, bucket = self.fingerprint(h), self.home(h)
        for turn in range(KICKS):
            at = self.slot(bucket, 0)
            if at < 0:
                at = self.slot(self.other(bucket, mark), 0)
            if at >= 0:
                self.table[at] = mark
                return True
            at = bucket * SLOTS + (h >> (turn % 32)) % SLOTS
            mark, self.table[at] = self.table[at], mark
            bucket = self.other(bucket, mark)
        return False

    def remove(self, h: int) -> bool:
        at = self.find(h)
        if at >= 0:
            self.table[at] = 0
        return at >= 0

    def packed(self) -> bytes:
        return np.array(self.table, "<u2").tobytes()


class Part:
    """One part while it is worked on: the filter, and live digests by bucket of content."""

    def __init__(self, table: bytes | None = None):
        self.filter = CuckooFilter(table=table)
        self.content: dict[int, list] = {}
        self.live = 0

    @staticmethod
    def hash(digest: str) -> int:
        return int(digest[-16:], 16)

    def keep(self, digest: str, n: int, content: bytes, size: int) -> list:
        entry = [digest, n, content, size]
        self.content.setdefault(self.filter.home(self.hash(digest)), []).append(entry)
        self.live += 1
        return entry

    def entry(self, digest: str, content: bytes, size: int) -> list | None:
        """The live entry with this content, asked of the filter first."""
        h = self.hash(digest)
        if self.filter.find(h) < 0:
            return None
        for found in self.content.get(self.filter.home(h), ()):
            if found[0] == digest and found[3] == size and (found[2] == content or unpacked(found[2], size) == unpacked(content, size)):
                return found
        return None

    def insert(self, digest: str, n: int, content: bytes, size: int) -> list:
        found = self.entry(digest, content, size)
        if found is None:
            if not self.filter.add(self.hash(digest)):
                self.resize(digest)
            return self.keep(digest, n, content, size)
        found[1] += n
        return found

    def resize(self, digest: str) -> None:
        """A filter of twice the buckets, or more, filled from the live digests and ``digest``."""
        entries = [e for bucket in self.content.values() for e in bucket]
        buckets = self.filter.buckets
        while True:
            buckets *= 2
            self.filter = CuckooFilter(buckets)
            if all(self.filter.add(self.hash(d)) for d in [*(e[0] for e in entries), digest]):
                break
        self.content = {}
        for e in entries:
            self.content.setdefault(self.filter.home(self.hash(e[0])), []).append(e)

    def delete(self, digest: str, n: int, content: bytes, size: int) -> list | None:
        found = self.entry(digest, content, size)
        if found is not None:
            found[1] -= n
            if found[1] <= 0:
                h = self.hash(digest)
                self.filter.remove(h)
                self.content[self.filter.home(h)].remove(found)
                self.live -= 1
        return found


def unpacked(content: bytes, size: int) -> bytes:
    return pa.decompress(content, size, codec=CODEC, asbytes=True)


def squeezed(texts: pa.Array) -> list[bytes]:
    """The texts' bytes without white space; null counts as empty."""
    data, offsets = text_bytes(texts)
    keep = ~WHITE[data]
    ends = np.concatenate([[0], np.cumsum(keep)])[offsets]
    body = data[keep].tobytes()
    return [body[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def n_chars(texts: pa.Array) -> list[int]:
    return pc.utf8_length(pc.fill_null(texts, "")).to_pylist()


def digests(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the text replaced by ``n_chars`` and the ``digest`` of what is not white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            text = batch.column("text")
            names = [hashlib.sha256(t).hexdigest() for t in squeezed(text)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_chars(text), pa.int64()), pa.array(names, pa.string())], names=["doc_id", "n_chars", "digest"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, digest string")


def better(a: tuple, b: tuple) -> tuple:
    """Of two (n_chars, doc_id, ties) the one that stays; ties add up."""
    ka, kb = (-a[0], a[1] is None, a[1] or 0), (-b[0], b[1] is None, b[1] or 0)
    return (*a[:2], a[2] + b[2]) if ka == kb else min((ka, a), (kb, b))[1]


def arrivals(docs: DataFrame, parts: int) -> DataFrame:
    """``docs(doc_id, text)`` as rows of the kind ``ADDED``, the equal texts of a slice merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            merged: dict[bytes, list] = {}
            for text, chars, doc_id in zip(squeezed(batch.column("text")), n_chars(batch.column("text")), batch.column("doc_id").to_pylist()):
                row = (chars, doc_id, 1)
                known = merged.get(text)
                if known:
                    known[0] += 1
                    known[1] = better(known[1], row)
                else:
                    merged[text] = [1, row]
            out = []
            for text, (n, best) in merged.items():
                digest = hashlib.sha256(text).hexdigest()
                out.append((int(digest[:8], 16) % parts, ADDED, digest, n, pa.compress(text, codec=CODEC, asbytes=True), len(text), *best))
            yield batch_of(out)

    return docs.select("doc_id", "text").mapInArrow(run, ROWS)


SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("digest", pa.string()), ("n", pa.int64()), ("content", pa.binary()), ("size", pa.int64()), ("n_chars", pa.int64()), ("doc_id", pa.int64()), ("ties", pa.int64())])


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(SCHEMA), SCHEMA)], schema=SCHEMA)


def worked(rows: DataFrame, parts: int, deleting: bool) -> DataFrame:
    """The parts' old rows and arrivals to their new rows and one report row for each digest that arrived."""

    def finish(number: int, part: Part, best: dict[str, tuple]) -> Iterator[pa.RecordBatch]:
        out = [(number, FILTER, None, part.live, part.filter.packed(), part.filter.buckets, None, None, None)]
        for bucket in part.content.values():
            out += [(number, LIVE, e[0], e[1], e[2], e[3], None, None, None) for e in bucket]
        out += [(number, ADDED, digest, entry[1] if entry else 0, None, None, *row) for digest, (entry, row) in best.items()]
        for a in range(0, len(out), 512):
            yield batch_of(out[a : a + 512])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, best = None, Part(), {}
        for batch in batches:
            for own, kind, digest, n, content, size, chars, doc_id, ties in zip(*(c.to_pylist() for c in batch.columns)):
                if own != number:
                    if number is not None:
                        yield from finish(number, part, best)
                    number, part, best = own, Part(), {}
                if kind == FILTER:
                    part = Part(content)
                elif kind == LIVE:
                    part.keep(digest, n, content, size)
                else:
                    entry = (part.delete if deleting else part.insert)(digest, n, content, size)
                    row = (chars, doc_id, ties)
                    best[digest] = (entry, better(best[digest][1], row) if digest in best else row)
        if number is not None:
            yield from finish(number, part, best)

    dealt = rows.select(*NAMES).repartition(parts, "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(run, ROWS)


class Index:
    """The live digests of all inserted rows, as a table in the shared folder."""

    def __init__(self, rows: DataFrame | None = None, parts: int | None = None):
        self.rows, self.parts = rows, parts

    def change(self, docs: DataFrame, deleting: bool) -> tuple[Index, DataFrame]:
        parts = self.parts or PARTS_PER_SPLIT * max(1, docs.rdd.getNumPartitions())
        rows = arrivals(docs, parts)
        if self.rows is not None:
            rows = self.rows.unionByName(rows)
        after = stored(worked(rows, parts, deleting), "digests")
        report = after.where(F.col("kind") == ADDED).select("digest", F.col("n").alias("live"), "n_chars", "doc_id", "ties")
        return Index(after.where(F.col("kind") != ADDED), parts), report

    def insert(self, docs: DataFrame) -> tuple[Index, DataFrame]:
        """The index with ``docs(doc_id, text)`` added, and for each of their digests its live copies
        and the length, id and ties of the row among them that stays."""
        return self.change(docs, False)

    def delete(self, docs: DataFrame) -> tuple[Index, DataFrame]:
        """The index without ``docs(doc_id, text)``, and for each of their digests the copies still live.

        Texts that are not live are left alone; more copies than are live delete the digest.
        """
        return self.change(docs, True)

    def live(self) -> DataFrame:
        """``(digest, n)`` of all live digests."""
        return self.rows.where(F.col("kind") == LIVE).select("digest", "n")

    def drop(self) -> None:
        drop_stored(self.rows)


def resolved(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each row's digest and the row that stays of its group, and the table to drop when that is read."""
    index, report = Index().insert(docs)
    groups = report.select("digest", F.col("live").alias("group_size"), F.col("n_chars").alias("most"), F.col("doc_id").alias("keep_id"), "ties")
    # A text of very many copies is one large key here: AQE divides its partition, as groups hold it once.
    return digests(docs).join(groups, "digest"), index.rows


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all columns as they are."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    plain = packed.select("doc_id", "text")
    _, report = Index().insert(plain)
    white = "".join(chr(c) for c in np.flatnonzero(WHITE))
    body = F.coalesce("text", F.lit(""))
    keyed = packed.select("_row", F.sha2(F.translate(body, white, "").cast("binary"), 256).alias("digest"), F.col("doc_id").alias("_id"), F.length(body).alias("_chars"))
    best = report.select("digest", "doc_id", "n_chars", "ties")
    stays = keyed.join(best, "digest").where(F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_chars") == F.col("n_chars")))
    once = stays.where("ties = 1").select("_row")
    tied = stays.where("ties > 1").dropDuplicates(["digest"]).select("_row")
    return once.unionByName(tied).select("_row.*")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts and the row of it that stays."""
    out, _ = resolved(table(spark, sf_dir, "documents", "doc_id", "text"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("most"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


OP12_SQL = r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""
