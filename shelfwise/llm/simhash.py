"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are computed where the texts are read; from then on only 64-bit
numbers move. Every bit position gets a vector of r + 1 random bits, and every
non-zero vector v of r + 1 bits is a mask: the positions whose vector has an odd
product with v. Up to r positions give r linear equations in r + 1 unknowns, so
some v is orthogonal to all of them: any two fingerprints within r bits agree
under some mask, without exception.

Equal fingerprints are one node from the start. A bucket with more nodes than
``BUCKET`` is masked again with fresh vectors, which keep the same guarantee and
leave half as many free bits each time, until its size is bounded by its free
bits. Inside a bucket a spanning forest of the close pairs goes out, not all
pairs, so links grow with the nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import Words, bounded, drop_stored, hash_strings, short_lived_shuffles, stored, table
from shelfwise.llm.components import components

SHINGLE = 3
RADIUS = 3
BUCKET = 2_000
LEVELS = 3
SEED = 7


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per group of consecutive hashes the bits set in over half of them; no hashes, no bits."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    ends = np.cumsum(counts)
    starts = (ends - counts)[full]
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Add up in pieces: single bytes hold up to 255 ones.
    sums = np.empty((len(full), 64), np.int64)
    for i, (a, n) in enumerate(zip(starts, counts[full])):
        sums[i] = bits[a : a + n].sum(0, dtype=np.int64) if n < 64 else np.add.reduce(np.add.reduceat(bits[a : a + n], np.arange(0, n, 255), axis=0), axis=0, dtype=np.int64)
    on = (sums * 2 > counts[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()
    return out


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every shingle, repeats included, and the number of shingles per text.

    A text with fewer words than ``size`` has one shingle, all of it; without words it has none.
    """
    counts = np.where(words.counts >= size, words.counts - size + 1, np.minimum(words.counts, 1))
    flat = words.vocabulary.take(pa.array(words.ids)).cast(pa.large_binary())
    lengths = np.diff(np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1])
    ends = np.cumsum(lengths + 1) - 1  # in the words joined by single blanks
    starts = ends - lengths
    joined = b" ".join(flat.to_pylist())
    first = np.arange(len(flat))
    first = first[first - words.offsets[words.doc] < counts[words.doc]]
    last = np.minimum(first + size, words.offsets[words.doc[first] + 1]) - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[first].tolist(), ends[last].tolist())), np.uint64, len(first)), counts


def distinct_word_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the distinct words of every text, and their number."""
    pairs = np.unique(words.doc * max(1, len(words.vocabulary)) + words.ids)
    doc, word = np.divmod(pairs, max(1, len(words.vocabulary)))
    return hash_strings(words.vocabulary)[word], np.bincount(doc, minlength=len(words.counts))


def fingerprints(docs: DataFrame, shingle: int | None = SHINGLE) -> DataFrame:
    """``docs(doc_id, text)`` with the text replaced by ``fp``, a signed 64-bit SimHash.

    ``shingle`` None takes the set of distinct words as features instead.
    Words are lower-cased in A-Z; null and empty texts have fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, most=2 << 20):
            words = Words(batch.column("text"), lower=True)
            hashes, counts = distinct_word_hashes(words) if shingle is None else shingle_hashes(words, shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(majority(hashes, counts).view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def masks(radius: int, seed: int) -> list[int]:
    """The 2^(radius+1) - 1 covering masks as signed 64-bit numbers."""
    vectors = np.random.default_rng([SEED, seed]).integers(0, 1 << (radius + 1), 64)
    out = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i in range(64) if bin(int(vectors[i]) & v).count("1") % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def covered(nodes: DataFrame, radius: int, level: int, key: list) -> DataFrame:
    """Every node under every mask of a level; ``key`` extends the bucket of the level above.

    Nodes become many rows each, so they are spread over all tasks first.
    """
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    views = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks(radius, level))])
    return nodes.select("fp", *key, F.explode(views).alias("v")).select("fp", F.xxhash64(*key, "v.mask", "v.part").alias("bucket"))


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of one bucket that differ in at most ``radius`` bits."""
    group = np.arange(len(fps))
    left, right = [], []
    for i in range(1, len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= radius)
        if len(near):
            joined, one_of_each = np.unique(group[near], return_index=True)
            left.append(near[one_of_each])
            right.append(np.full(len(joined), i))
            group[:i][np.isin(group[:i], joined)] = i
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
    return fps[a], fps[b]


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints ``nodes(fp)`` within ``radius`` bits.

    Fingerprints that agree under one mask mostly agree under many: buckets with
    the same members are one before any pair is looked at.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [forest(fps.view(np.uint64), radius) for fps in batch.column("fps").to_numpy(zero_copy_only=False)]
            a, b = (np.concatenate([f[side] for f in found] or [np.empty(0, np.uint64)]).view(np.int64) for side in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    edges, level = None, 0
    rows = covered(nodes, radius, 0, [])
    while True:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        # Sizes of exploded rows are guessed far too small: without the hint they would be broadcast.
        rows = stored(rows.join(sizes.hint("merge"), "bucket"), "buckets")
        ready = rows.where(F.col("n") <= BUCKET if level < LEVELS else F.lit(True))
        members = ready.groupBy("bucket").agg(F.sort_array(F.collect_list("fp")).alias("fps")).select("fps").distinct()
        found = members.mapInArrow(pairs, "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
        over = rows.where(F.col("n") > BUCKET).select("fp", "bucket")
        if level >= LEVELS or over.isEmpty():
            return edges
        level += 1
        rows = covered(over, radius, level, ["bucket"])


def linked(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints(doc_id, fp)`` with ``component_id``, the smallest doc_id reachable over close fingerprints.

    Rows with equal fingerprints, empty texts included, are one class. A null id
    never is the smallest unless its whole component has none.
    """
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classes = stored(classes, "classes")
    roots = components(links(classes.select("fp"), radius))
    members = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    members = stored(members, "members")
    whole = members.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(members.join(whole, "root").select("fp", "component_id"), "fp")


STAGE_SHINGLE = 5
STAGE_RADIUS = 3
SIMILARITY = 0.8
GROUP = 500
GROUP_SHINGLES = 400_000
ROUNDS = 6
SAMPLE = 16
OFTEN = 4
COMMON = 100_000


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``docs(component, doc_id, row, text)`` with the text replaced by the set of its shingles' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, most=2 << 20):
            hashes, counts = shingle_hashes(Words(batch.column("text"), lower=True), size)
            sets = [np.unique(h).view(np.int64) for h in np.split(hashes, np.cumsum(counts)[:-1])] if len(counts) else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("component", "doc_id", "row")), pa.array(sets, pa.list_(pa.int64()))], names=["component", "doc_id", "row", "shingles"])

    return docs.select("component", "doc_id", "row", "text").mapInArrow(run, "component long, doc_id long, row long, shingles array<long>")


def alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of a bounded list of sets have a Jaccard similarity of ``similarity`` or more."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    _, name, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[name] > 1
    column, name = np.unique(name[shared], return_inverse=True)
    order = np.argsort(name, kind="stable")
    owner, name = np.repeat(np.arange(n), sizes)[shared][order], name[order]
    both = np.zeros((n, n))
    for start in range(0, len(column), 4096):
        a, b = np.searchsorted(name, [start, start + 4096])
        held = np.zeros((n, min(4096, len(column) - start)), np.float32)
        held[owner[a:b], name[a:b] - start] = 1
        both += held @ held.T
    either = sizes[:, None] + sizes - both
    near = np.where(either == 0, 1.0, both / np.maximum(either, 1)) >= similarity
    np.fill_diagonal(near, True)
    return near


def classes(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row it reaches."""
    label = np.arange(len(near))
    while True:
        after = np.where(near, label, len(near)).min(1)
        if (after == label).all():
            return label
        label = after


SETTLED = "row long, lost long, leads boolean, none boolean, first_id long, first_row long"


def settled(group: pa.Table, similarity: float) -> pa.Table:
    """One row per entry of a bounded group, as ``SETTLED``.

    An entry stands for a class of rows seen to be alike, of which ``first_row``
    stays. Classes linked here become one: its first row stays, the others are
    ``lost``; the entry with most links ``leads``, that is, stands for all.
    """
    none, first_id, first_row, row = (group.column(c).to_numpy() for c in ("none", "first_id", "first_row", "row"))
    order = np.lexsort([first_row, first_id, none])
    none, first_id, first_row, row = none[order], first_id[order], first_row[order], row[order]
    sets = group.column("shingles").combine_chunks()
    starts, values = sets.offsets.to_numpy(), sets.values.to_numpy()
    near = alike([values[starts[i] : starts[i + 1]] for i in order], similarity)
    label, degree = classes(near), near.sum(1)
    # Rows are in order, so the smallest row of a class is its first.
    best = np.lexsort([np.arange(len(label)), -degree, label])
    best = best[np.flatnonzero(np.diff(label[best], prepend=-1))]
    lost = pa.array(first_row, mask=label == np.arange(len(label)))
    return pa.table({"row": row, "lost": lost, "leads": np.isin(np.arange(len(label)), best), "none": none[label], "first_id": first_id[label], "first_row": first_row[label]})


def near_duplicates(docs: DataFrame, shingle: int = STAGE_SHINGLE, radius: int = STAGE_RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """The ``row`` names of ``docs(doc_id, text, row)`` that repeat a row that stays.

    SimHash over the distinct words proposes groups of texts that differ in a
    few words, shared prefix shingles all other pairs; five-word shingles decide. Rows linked by a
    Jaccard similarity of ``similarity`` or more, directly or over others, are
    one class, and its first row (by id, null ids last) stays. Equal texts are
    one entry from the start.

    A group of up to ``GROUP`` entries and ``GROUP_SHINGLES`` shingles is settled
    in one task. Larger ones are dealt into parts of that size, in each of
    ``ROUNDS`` rounds by another min-hash, so that two entries of the wanted
    similarity meet with a chance of 0.8 or more a round unless a part is full;
    every part leaves one entry for each of its classes, until the group is small.
    This only saves work: ``all_linked`` then finds every pair that is left.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    body = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", "row", F.struct(F.xxhash64(body), F.crc32(body.cast("binary")), F.length(body)).alias("same"))
    named = stored(named, "named")
    firsts = stored(named.groupBy("same").agg(F.min(order).alias("o")).select("same", "o.row", "o"), "firsts")
    lost = named.join(firsts.select("same", F.col("row").alias("kept")), "same").where("row <> kept").select("row")
    # Texts are read where they lie; only fingerprints and the texts of groups are shuffled.
    prints = fingerprints(docs.select(F.col("row").alias("doc_id"), "text"), None)
    prints = stored(prints.join(firsts.select(F.col("row").alias("doc_id")), "doc_id"), "prints")
    groups = stored(linked(prints, radius).select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")), "groups")
    drop_stored(prints)
    several = groups.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    texts = docs.join(stored(groups.join(several, "component"), "wanted"), "row")
    entries = shingle_sets(texts, shingle).select("component", "row", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("first_id"), F.col("row").alias("first_row"), "shingles")
    entries = stored(entries, "entries")
    used, seen = [entries], []
    for turn in range(ROUNDS + 1):
        sizes = entries.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.size("shingles")).alias("total"))
        is_large = (F.col("n") > GROUP) | (F.col("total") > GROUP_SHINGLES)
        small = entries.join(sizes.where(~is_large).select("component"), "component")
        done = stored(grouped(small, ["component"], similarity), "settled")
        seen.append(done.where("lost is not null").select(F.col("lost").alias("a"), F.col("first_row").alias("b")))
        entries = entries.join(sizes.where(is_large).select("component"), "component")
        if turn == ROUNDS or entries.isEmpty():
            break
        drawn = F.array_min(F.transform("shingles", lambda h: F.xxhash64(h, F.lit(turn))))
        dealt = stored(entries.withColumn("drawn", F.coalesce(drawn, F.lit(0))), "dealt")
        used.append(dealt)
        loads = dealt.groupBy("component", "drawn").agg(F.ceil(F.greatest(F.count("*") / GROUP, F.sum(F.size("shingles")) / GROUP_SHINGLES)).alias("parts"))
        dealt = dealt.join(loads, ["component", "drawn"]).withColumn("part", F.pmod(F.xxhash64("row", F.lit(turn)), F.col("parts")))
        done = stored(grouped(dealt, ["component", "drawn", "part"], similarity), "settled")
        seen.append(done.where("lost is not null").select(F.col("lost").alias("a"), F.col("first_row").alias("b")))
        leads = done.where("leads").select("row", "none", "first_id", "first_row")
        entries = stored(dealt.select("component", "row", "shingles").join(leads, "row"), "entries")
        used.append(entries)
    drop_stored(*used)
    roots = all_linked(docs, firsts.select("row"), reduce(DataFrame.unionByName, seen), shingle, similarity)
    members = stored(roots.join(firsts.select(F.col("row").alias("node"), "o"), "node"), "members")
    stays = members.groupBy("root").agg(F.min("o").alias("kept"))
    return lost.unionByName(members.join(stays, "root").where("o <> kept").select(F.col("node").alias("row")))


def frequent(sets: DataFrame) -> np.ndarray:
    """The commonest shingles in a sample of the sets, commonest last.

    Prefixes are in this order, the others first. Any order finds the same pairs;
    this one keeps passages that many texts share out of the prefixes.
    """
    drawn = sets.select(F.explode("shingles").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN)
    return np.array([r.h for r in drawn.orderBy(F.desc("n"), "h").limit(COMMON).collect()][::-1], np.int64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of 64 places or more, a power of two and no fewer than the hashes, whether an odd number fall there; as bits."""
    places = max(64, 1 << (len(hashes) - 1).bit_length())
    odd = (np.bincount(hashes & (places - 1), minlength=places) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def least_apart(x: str, y: str):
    """At least so many members of two sets are in only one of them, by their ``parities``.

    A member of one set only changes one place, a member of both none. Bits of
    twice the length are folded; beyond that nothing is said.
    """
    n = F.least(F.size(x), F.size(y))
    halves = lambda c: F.zip_with(F.slice(c, 1, n), F.slice(c, n + 1, n), lambda p, q: p.bitwiseXOR(q))
    folded = lambda c: F.when(F.size(c) > n, halves(c)).otherwise(F.col(c))
    differ = F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.when(F.greatest(F.size(x), F.size(y)) > 2 * n, 0).otherwise(F.aggregate(differ, F.lit(0), lambda total, d: total + d))


def prefixes(docs: DataFrame, size: int, similarity: float, common: np.ndarray) -> DataFrame:
    """``docs(row, text)`` as ``size`` of its shingle set, the set's ``prefix`` and its parity ``bits``.

    Of two sets with the wanted similarity, one of the first
    ``n - ceil(similarity * n) + 1`` shingles of each, in any one order, is in both.
    """
    names = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[names], names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = shared.value
        for batch in bounded(batches, most=2 << 20):
            hashes, counts = shingle_hashes(Words(batch.column("text"), lower=True), size)
            sizes, bits, out = [], [], []
            for h in np.split(hashes.view(np.int64), np.cumsum(counts)[:-1]) if len(counts) else []:
                h = np.unique(h)
                bits.append(parities(h))
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    h = h[np.argsort(np.where(known[at] == h, place[at] + 1, 0), kind="stable")]
                sizes.append(len(h))
                out.append(h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sizes, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (out, bits))], names=["row", "size", "prefix", "bits"])

    return docs.select("row", "text").mapInArrow(run, "row long, size long, prefix array<long>, bits array<long>")


def all_linked(docs: DataFrame, rows: DataFrame, edges: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``(node, root)`` of ``rows`` joined by ``edges(a, b)`` or by any pair of the wanted similarity.

    Pairs that ``edges`` join already need no look. The others that share a
    prefix shingle are compared in full, unless their parity bits show that too
    much differs: first every row with the smallest one of each of its shingles,
    then all that are still apart. Classes only grow, so the second pass needs
    only the shingles that the first one found in several classes.
    """
    sample = docs.join(rows.where(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0), "row").select(F.lit(0).cast("long").alias("component"), "doc_id", "row", "text")
    common = frequent(shingle_sets(sample, shingle))
    short = stored(prefixes(docs, shingle, similarity, common).join(rows, "row"), "prefixes")
    bare = short.where("size = 0").select("row")
    edges = edges.unionByName(bare.select(F.col("row").alias("a"), F.lit(bare.agg(F.min("row")).first()[0]).cast("long").alias("b")))
    sketch, left, at = short.select("row", "bits"), short, F.posexplode("prefix").alias("at", "h")
    for star in (True, False):
        roots = stored(components(edges), "roots")
        classed = left.drop("class", "least").join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("class", F.coalesce("root", "row"))
        classed = classed.select("row", "size", "class", *([at] if star else ["at", "h"]))
        several = classed.groupBy("h").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.min("row").alias("least")).where("low <> high").select("h", "least")
        before, left = left, stored(classed.join(several.hint("merge"), "h"), "shared")
        right = (left.where("row = least") if star else left).select("h", *[F.col(c).alias(f"{c}2") for c in ("row", "size", "class", "at")])
        met = left.join(right.hint("merge"), "h").where("row > row2 and class <> class2")
        # A pair's first common shingle leaves it at most so many more; the others may be too few.
        most = F.least(F.col("size") - F.col("at"), F.col("size2") - F.col("at2"))
        met = met.where(most >= similarity / (1 + similarity) * (F.col("size") + F.col("size2")) - 1e-6)
        met = met.select(F.col("row").alias("a"), F.col("row2").alias("b"), (F.col("size") + F.col("size2")).alias("total")).distinct()
        met = met.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b")
        pairs = stored(met.where(least_apart("x", "y") <= (1 - similarity) / (1 + similarity) * F.col("total") + 1e-6).select("a", "b"), "candidates")
        drop_stored(*([] if star else [before, left, short]))
        wanted = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct()
        texts = docs.join(wanted, "row").withColumn("component", F.lit(0).cast("long"))
        sets = stored(shingle_sets(texts, shingle).select("row", "shingles"), "sets")
        both = pairs.join(sets.select(F.col("row").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("row").alias("b"), F.col("shingles").alias("y")), "b")
        common_size = F.size(F.array_intersect("x", "y"))
        near = both.where(common_size / (F.size("x") + F.size("y") - common_size) >= similarity).select("a", "b")
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(stored(near, "near"))
        drop_stored(sets, pairs)
    return components(edges)


def grouped(entries: DataFrame, key: list[str], similarity: float) -> DataFrame:
    return entries.groupBy(*key).applyInArrow(lambda group: settled(group, similarity), SETTLED)


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns and one row of each group of near duplicates.

    Texts without words, null ones too, are equal to each other. Of a group the
    row with the smallest id stays, null ids last, then the first as read.
    """
    # Rows are numbered once, in a stored table: equal rows stay apart and a rerun of a task numbers nothing anew.
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    with short_lived_shuffles(docs.sparkSession):
        numbered = stored(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()], F.monotonically_increasing_id().alias("_row")), "numbered")
        plain = numbered.select(F.col(own[doc_id]).cast("long").alias("doc_id"), F.col(own[text]).alias("text"), F.col("_row").alias("row"))
        gone = stored(near_duplicates(plain).withColumnRenamed("row", "_row"), "gone")
    return numbered.join(gone, "_row", "left_anti").select(*[F.col(n).alias(c) for c, n in own.items()])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: three-word shingles, three bits."""
    prints = stored(fingerprints(table(spark, sf_dir, "documents", "doc_id", "text")), "fingerprints")
    out = linked(prints)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
