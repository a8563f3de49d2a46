"""Phrase collocations by best-first branch-and-bound growth.

A phrase's count is at most its prefix's, so a prefix Q with first word w bounds
the score of everything that grows from it: f(Q) / (f(w) + f(Q)) of the scale,
as the cut behind w alone shows. The same holds for a suffix and its last word.

Words and pairs of words are counted once. Then each language gets a cut of
the score: the score of its pair of rank ``AHEAD`` times the report's size. All
prefixes whose bound reaches the cut are grown to three and four words, best
first in the sense that none with a lower bound is; so every phrase at or above
the cut, and every longer phrase that could take one of them out, has its exact
count. Where fewer than the report's size survive above the cut, the cut of
that language is lowered (down to 0, which grows everything) and it grows again.
The cut decides how much work a round does, never the result: a language is
settled when all scores that tie with its last place are above its cut.

Texts are read where they lie. A worker counts the n-grams of a slice and sends
each once. Which prefixes to grow it knows from a Bloom filter of at most
``BLOOM_BITS`` bits: a false hit only counts a phrase that nobody needs.

Null texts are empty; a null language is ``und``, together with a language of
that name. Rows that repeat count again; texts of any length are taken whole. Score
ties go by count, then by the phrase's bytes. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwise.llm.common import bounded, hash_strings, join_hashes, mix, stored, table
from shelfwise.llm.runs import LOWER, Runs, byte_set, text_bytes

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
REPORT = 2_000
AHEAD = 4
UNKNOWN = "und"
BLOOM_BITS = 1 << 28
BITS_PER_KEY = 16
PROBES = 4
BREAKS = byte_set(b".,;:!?\x0a\x0b\x0c\x0d")
BLANKS = byte_set(b"\x20\x09")


# --- n-grams of a slice ----------------------------------------------------------


class Grams:
    """The words of a slice with the language and piece each stands in."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = text_bytes(batch.column("text"))
        breaks = BREAKS[data]
        words = Runs(LOWER[data], offsets, ~(breaks | BLANKS[data]))
        self.vocabulary, self.ids = words.vocabulary, words.ids
        passed = np.concatenate([[0], np.cumsum(breaks)])
        self.piece = passed[words.start] + words.doc
        langs = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy().astype(np.int64)[words.doc] if len(words.doc) else np.empty(0, np.int64)
        self.word_hash, self.lang_hash = hash_strings(self.vocabulary), hash_strings(self.langs)

    def places(self, size: int) -> np.ndarray:
        """Where ``size`` words in a row stand in one piece."""
        n = len(self.ids) - size + 1
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1 :]) if n > 0 else np.empty(0, np.int64)

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        return reduce(lambda h, k: join_hashes(h, self.word_hash[self.ids[at + k]]), range(size), self.lang_hash[self.lang[at]])

    def counted(self, at: np.ndarray, size: int) -> pa.RecordBatch:
        """The distinct n-grams at the given places as language, phrase and count."""
        code, values = self.lang[at], max(1, len(self.vocabulary))
        most = max(1, len(self.langs))
        for k in range(size):
            if most * values >= 1 << 63:
                # Numbers that no longer fit are counted through.
                known, code = np.unique(code, return_inverse=True)
                most = len(known)
            code, most = code * values + self.ids[at + k], most * values
        _, first, count = np.unique(code, return_index=True, return_counts=True)
        words = [self.vocabulary.take(pa.array(self.ids[at[first] + k])) for k in range(size)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if size > 1 else words[0]
        return pa.RecordBatch.from_arrays([self.langs.take(pa.array(self.lang[at[first]])), phrase.cast(pa.string()), pa.array(count.astype(np.int64))], names=["lang", "phrase", "n"])


def phrase_hashes(lang: pa.Array, phrase: pa.Array) -> np.ndarray:
    """What ``Grams.hashes`` gives for phrases of one length."""
    if not len(phrase):
        return np.empty(0, np.uint64)
    words = pc.split_pattern(phrase, " ")
    flat = words.flatten().dictionary_encode()
    hashes = hash_strings(flat.dictionary)[flat.indices.to_numpy()].reshape(len(phrase), -1)
    langs = lang.dictionary_encode()
    return reduce(join_hashes, hashes.T, hash_strings(langs.dictionary)[langs.indices.to_numpy()])


# --- Bloom filter ----------------------------------------------------------------


def probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of each hash, ``bits`` a power of two."""
    step = mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    return [(hashes + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(PROBES)]


def holds(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    hit = np.ones(len(hashes), bool)
    for at in probes(hashes, len(bloom) * 64):
        hit &= (bloom[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return hit


def bloom_of(keys: DataFrame, most_bits: int = BLOOM_BITS):
    """A broadcast Bloom filter of ``keys(lang, phrase)``, of ``most_bits`` bits at most."""
    n = keys.count()
    bits = min(most_bits, max(64, 1 << (BITS_PER_KEY * max(1, n) - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate([*probes(phrase_hashes(batch.column("lang"), batch.column("phrase")), bits), np.empty(0, np.uint64)]))
            slot, start = np.unique(at >> np.uint64(6), return_index=True)
            word = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(word.view(np.int64))], names=["slot", "word"])

    words = keys.select("lang", "phrase").mapInArrow(run, "slot long, word long").groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow()
    bloom = np.zeros(bits // 64, np.uint64)
    bloom[words.column("slot").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bloom)


# --- counts and scores -------------------------------------------------------------


def counts(docs: DataFrame, size: int, heads=None, tails=None, both: bool = False) -> DataFrame:
    """``(lang, phrase, n)`` of all phrases of ``size`` words of ``docs(text, lang)``.

    With filters, of those whose first ``size - 1`` words are in ``heads`` or
    whose last are in ``tails`` (``both``: and).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, most=3 << 20):
            grams = Grams(batch)
            at = grams.places(size)
            if heads is not None:
                first, last = holds(heads.value, grams.hashes(at, size - 1)), holds(tails.value, grams.hashes(at + 1, size - 1))
                at = at[first & last if both else first | last]
            yield grams.counted(at, size)

    return docs.select("text", "lang").mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def ratio(a: Column, total: Column) -> Column:
    """floor(SCALE * a / total), in decimals since the product may pass 64 bits."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * a.cast("decimal(20,0)")
    low, base = wide % total.cast("decimal(20,0)"), total.cast("decimal(20,0)")
    return ((wide - low) / base).cast("long")


def words_of(phrase: str, first: int | Column, n: int | Column) -> Column:
    return F.concat_ws(" ", F.slice(F.split(phrase, " ", -1), first, n))


def scored(grams: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """``grams(lang, phrase, n)`` with l, r and score of their lowest cut, and ``head`` and ``tail``,
    the bounds of what grows from them to the right and to the left.

    Phrases with a part that is not in ``known(lang, phrase, n)`` are left out.
    """
    cuts = grams.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.array(*[F.lit(k) for k in range(1, size)])).alias("k"))
    cuts = cuts.withColumn("left", words_of("phrase", 1, F.col("k"))).withColumn("right", words_of("phrase", F.col("k") + 1, F.lit(size)))
    for side, name in (("left", "l"), ("right", "r")):
        part = known.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias(name))
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    cuts = cuts.withColumn("score", ratio(F.col("a"), F.col("l") + F.col("r")))
    if size == 2:
        out = cuts.select("lang", "phrase", "a", "l", "r", "score", F.col("l").alias("first"), F.col("r").alias("last"))
    else:
        best = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best"), F.max("l").alias("first"), F.max("r").alias("last"), F.count("*").alias("cuts"))
        out = best.where(F.col("cuts") == size - 1).select("lang", "phrase", "a", "best.l", "best.r", "best.score", "first", "last")
    return out.withColumn("head", ratio(F.col("a"), F.col("first") + F.col("a"))).withColumn("tail", ratio(F.col("a"), F.col("last") + F.col("a"))).drop("first", "last")


def cut_scores(pairs: DataFrame, wanted: int) -> DataFrame:
    """Per language the highest ``cut`` that ``wanted`` scores reach, 0 where there are fewer.

    Scores are whole numbers up to half of ``SCALE``, so a language's histogram is bounded.
    """
    bins = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    reached = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    bins = bins.select("lang", "score", reached.alias("reached"))
    return bins.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reached") >= wanted, F.col("score"))), F.lit(0)).alias("cut"))


def extended(longer: DataFrame, size: int) -> DataFrame:
    """For each phrase of ``size`` words the largest count of a phrase one word longer that holds it."""
    sides = F.array(words_of("phrase", 1, size), words_of("phrase", 2, size))
    return longer.select("lang", F.explode(sides).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("above"))


def surviving(phrases: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """The phrases without a longer one that holds them and is at least 80 % as frequent.

    A longer phrase's count is at most that of the phrase one word longer inside it, so those decide.
    """
    with_above = phrases.join(extended(longer, size), ["lang", "phrase"], "left")
    return with_above.where("above is null or 5 * above < 4 * a").drop("above")


def above_cut(phrases: DataFrame, cuts: DataFrame, column: str) -> DataFrame:
    return phrases.join(cuts, "lang").where(F.col(column) >= F.col("cut")).drop("cut")


def collocations(docs: DataFrame, least: int = LEAST, report: int = REPORT, ahead: int = AHEAD, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``report`` phrases of ``docs(text, lang)``."""
    words = stored(counts(docs, 1), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = words.where(F.col("n") >= least)
    bloom = bloom_of(often, bloom_bits)
    two = stored(counts(docs, 2, bloom, bloom, both=True).where(F.col("n") >= least), "pairs")
    bloom.unpersist()
    pairs = stored(scored(two, often, 2), "scored-pairs")
    left, settled, wanted = pairs, [], ahead * report
    while True:
        cuts = stored(cut_scores(left, wanted), "cuts")
        if cuts.isEmpty():
            break
        # Pairs whose bound to the right reaches the cut grow right; so do those that end a phrase that may.
        heads, tails = bloom_of(above_cut(left, cuts, "head"), bloom_bits), bloom_of(above_cut(left, cuts, "tail"), bloom_bits)
        three = stored(counts(docs, 3, heads, tails).where(F.col("n") >= least), "triples")
        triples = stored(scored(three, often.unionByName(two), 3), "scored-triples")
        for b in (heads, tails):
            b.unpersist()
        heads, tails = bloom_of(above_cut(triples, cuts, "head"), bloom_bits), bloom_of(above_cut(triples, cuts, "score"), bloom_bits)
        four = stored(counts(docs, 4, heads, tails).where(F.col("n") >= least), "quadruples")
        for b in (heads, tails):
            b.unpersist()
        quads = scored(four, often.unionByName(two).unionByName(three), 4)
        alive = surviving(above_cut(left, cuts, "score"), three, 2).unionByName(surviving(above_cut(triples, cuts, "score"), four, 3)).unionByName(above_cut(quads, cuts, "score"))
        alive = stored(alive.select("lang", "phrase", "a", "l", "r", "score"), "alive")
        full = alive.groupBy("lang").agg(F.count("*").alias("alive"))
        done = stored(cuts.join(full, "lang", "left").where(f"cut = 0 or alive >= {report}").select("lang"), "settled")
        settled.append(alive.join(done, "lang"))
        left = left.join(done, "lang", "left_anti")
        wanted *= max(2, ahead)
    rows = reduce(DataFrame.unionByName, settled) if settled else pairs.select("lang", "phrase", "a", "l", "r", "score").where("false")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = rows.withColumn("rank", place.cast("long")).where(F.col("rank") <= report)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases by their lowest cut."""
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


OP11_SQL = r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece, words
    FROM (
        SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda w: w <> '') AS words
        FROM (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
            FROM documents
        )
    )
    WHERE len(words) > 0
), spots AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
    SELECT lang, words[i : i + k - 1] AS g, k FROM spots, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(words)
), f AS (
    SELECT lang, g, k, count(*)::HUGEINT AS c FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT * FROM f WHERE k >= 2 AND c >= 30
), cuts AS (
    SELECT c.lang, c.g, c.k, c.c AS a, j, l.c AS l, r.c AS r, (2000000 * c.c) // (l.c + r.c) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
    JOIN f l ON l.lang = c.lang AND l.g = c.g[1 : j]
    JOIN f r ON r.lang = c.lang AND r.g = c.g[j + 1 : c.k]
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
), inside AS (
    SELECT DISTINCT lang, g[i : i + m - 1] AS g, c AS above
    FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates), (SELECT unnest([1, 2, 3]) AS i)
    WHERE i + m - 1 <= k
), dropped AS (
    SELECT DISTINCT s.lang, s.g FROM scored s JOIN inside x ON x.lang = s.lang AND x.g = s.g AND 100 * x.above >= 80 * s.a
), named AS (
    SELECT s.lang, array_to_string(s.g, ' ') AS phrase, a, l, r, score
    FROM scored s ANTI JOIN dropped d ON d.lang = s.lang AND d.g = s.g
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
