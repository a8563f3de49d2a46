"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words, the one that is not longer gives two disjoint chunks, its halves.
The other gives the grams of the same length that start within one place of a
chunk: one edit touches one half at most, so the other half is a gram of the
longer word, at its own place or one further on. Words that share a chunk are
joined and compared.

A chunk that more than ``GROUP`` words share is not paired. What lies outside the
chunk is chunked again, which the same argument allows, until few words are left
or the open part of the shorter word is one letter; then at most one word for
each letter shares all the rest.

Null and empty texts hold no words; rows that repeat count again; a null id
reads as an empty one. Words of any length and texts of any length are taken
whole. Ties between near words go to the smaller word in code-point order. An
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.llm.common import bounded, stored, table
from shelfwise.llm.runs import LOWER, Runs, byte_set, text_bytes

LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10
DROP_EVERY = 31
GROUP = 64
LETTERS = byte_set(bytes(range(65, 91)) + bytes(range(97, 123)))


def runs_of(texts: pa.Array) -> Runs:
    """Runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased; the range is lead byte C3 and what follows it."""
    data, offsets = text_bytes(texts)
    lead = data == 0xC3
    keep = LETTERS[data] | lead
    keep[1:] |= lead[:-1]
    return Runs(LOWER[data], offsets, keep)


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: runs of letters, one code point deleted where 31 divides their checksum, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = zlib.crc32
        for batch in bounded(batches):
            found = runs_of(batch.column("text"))
            size = max(1, len(found.vocabulary))
            letters = pc.utf8_length(found.vocabulary).to_numpy(zero_copy_only=False)
            long = letters[found.ids] >= least_letters
            pairs, count = np.unique(found.doc[long] * size + found.ids[long], return_counts=True)
            doc, word = np.divmod(pairs, size)
            values = found.vocabulary.cast(pa.large_binary()).to_pylist()
            seeds = [crc(f"{'' if i is None else i}:".encode()) for i in batch.column("doc_id").to_pylist()]
            hashes = np.fromiter((crc(values[w], seeds[d]) for d, w in zip(doc.tolist(), word.tolist())), np.int64, len(doc))
            cut = hashes % DROP_EVERY == 0
            totals = np.bincount(word[~cut], weights=count[~cut], minlength=len(values)).astype(np.int64)
            whole = np.flatnonzero(totals)
            shorter: dict[str, int] = {}
            for w, h, n in zip(word[cut].tolist(), hashes[cut].tolist(), count[cut].tolist()):
                text = values[w].decode()
                at = h % len(text)
                text = text[:at] + text[at + 1 :]
                if len(text) >= least_letters:
                    shorter[text] = shorter.get(text, 0) + n
            words = pa.concat_arrays([found.vocabulary.take(pa.array(whole)), pa.array(shorter, pa.large_string())])
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(np.concatenate([totals[whole], np.fromiter(shorter.values(), np.int64, len(shorter))]))], names=["word", "n"])

    counts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def chunked(rows: DataFrame) -> DataFrame:
    """Every row's two chunks, or matching grams, as ``key``, with the part outside as the new ``part``.

    ``rows(key, word, part, longer)``: ``part`` is the open part of ``word``;
    ``longer`` marks words that are matched against words one letter shorter.
    """
    size = F.length("part") - F.col("longer").cast("int")
    half = F.floor(size / 2).cast("int")

    def side(name: str, chunk: Column, rest: Column) -> Column:
        return F.struct(F.lit(name).alias("side"), size.alias("size"), chunk.alias("chunk"), rest.alias("rest"))

    head = side("head", F.substring("part", F.lit(1), half), F.substring("part", half + 1, F.length("part")))
    rest = half + F.col("longer").cast("int")
    tail = side("tail", F.substring("part", rest + 1, F.length("part")), F.substring("part", F.lit(1), rest))
    split = rows.select("key", "word", "longer", F.explode(F.array(head, tail)).alias("s"))
    # A chunk's key holds the key of the level above, so it names all that is equal outside the open part.
    key = F.sha2(F.concat_ws(" ", F.col("key"), F.col("s.side"), F.col("s.size").cast("string"), F.col("s.chunk")), 256)
    return split.select(key.alias("key"), "word", "longer", F.col("s.rest").alias("part"))


def paired(rows: DataFrame) -> DataFrame:
    """``(a, b)`` of one edit among rows that share a key."""
    short = rows.where("not longer").select("key", F.col("word").alias("a"))
    other = rows.select("key", F.col("word").alias("b"), "longer")
    met = short.join(other, "key").where("(longer or a < b) and levenshtein(a, b, 1) = 1")
    return met.select("a", "b")


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """Every pair ``(a, b)`` of ``words(word)`` exactly one edit apart, once."""
    start = words.select(F.lit("").alias("key"), "word", F.col("word").alias("part"), F.explode(F.array(F.lit(False), F.lit(True))).alias("longer"))
    open_rows, found = start.where("length(part) > cast(longer as int)"), []
    while True:
        rows = chunked(open_rows)
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("longer").alias("one_short"), F.max(F.length("part") - F.col("longer").cast("int")).alias("left"))
        # Sizes of exploded rows are guessed far too small: without the hint they would be broadcast.
        rows = stored(rows.join(sizes.where("size > 1 and not one_short").drop("one_short").hint("merge"), "key"), "chunks")
        small = (F.col("size") <= group) | (F.col("left") <= 1)
        found.append(stored(paired(rows.where(small)), "near"))
        open_rows = rows.where(~small).select("key", "word", "part", "longer")
        if open_rows.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()


def variants(words: DataFrame, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """``words(word, n)`` with near words counted, the form each word varies, and the root of its chain of forms."""
    words = stored(words, "words")
    pairs = near_pairs(words, group)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = near.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    best = best.select(F.col("a").alias("word"), "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    joined = words.join(best, "word", "left")
    is_form = F.col("form_n") >= times * F.col("n")
    formed = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "formed")
    # Counts grow at least ``times``-fold along a chain, so it ends; jumps double in length.
    jumps = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        after = jumps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        jumps = stored(jumps.join(after, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if jumps.where("moved").isEmpty():
            break
        jumps = jumps.drop("moved")
    return formed.join(jumps.drop("moved"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(word_counts(table(spark, sf_dir, "documents", "doc_id", "text")))
