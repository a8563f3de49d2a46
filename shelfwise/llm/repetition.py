"""Quality rules on repetition, from suffix arrays with longest-common-prefix intervals.

Texts are read in slices of a few megabytes. The suffixes of all texts of a
slice are sorted together by prefix doubling; a text's words carry the text's
number, so no repeat crosses from one text into another. After every doubling
only suffixes that still tie stay in the sort. The ranks of all rounds then give
the longest common prefix of neighbouring suffixes, whose maximum at a word is
the longest substring that starts there and stands elsewhere in the text too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.common import Words, bounded, table

MIN_WORDS = 10
BASE_WINDOW = 5
BASE_PERCENT = 20
MIN_REPEAT = 8
MAX_COVERED_PERCENT = 25
MAX_REPEAT = 100
SYMBOLS = "[#*$%&|<>]"


def repeats(words: Words) -> np.ndarray:
    """For every word the length of the longest repeated substring that starts there, 0 if none."""
    n = len(words.ids)
    if n == 0:
        return np.empty(0, np.int64)
    end = words.offsets[words.doc + 1]
    pair = words.doc * len(words.vocabulary) + words.ids
    _, group, sizes = np.unique(pair, return_inverse=True, return_counts=True)
    rank = (np.cumsum(sizes) - sizes)[group]  # of the first suffix of the tie
    tied = np.flatnonzero(sizes[group] > 1)
    ranks, step = [rank], 1
    while len(tied):
        follow = tied + step
        inside = follow < end[tied]
        second = np.where(inside, rank[np.minimum(follow, n - 1)], -1)
        order = np.lexsort((second, rank[tied]))
        tied, second = tied[order], second[order]
        first = rank[tied]
        new_group = np.concatenate([[True], first[1:] != first[:-1]])
        new_tie = new_group | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(tied))
        group_start = np.maximum.accumulate(np.where(new_group, at, 0))
        tie_start = np.maximum.accumulate(np.where(new_tie, at, 0))
        rank = rank.copy()
        rank[tied] = first + tie_start - group_start
        size = np.diff(np.append(np.flatnonzero(new_tie), len(tied)))
        tied = np.sort(tied[np.repeat(size, size) > 1])
        ranks.append(rank)
        step *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    a, b = suffixes[:-1], suffixes[1:]
    near = np.flatnonzero(ranks[0][a] == ranks[0][b])
    a, b = a[near], b[near]
    common = np.zeros(len(near), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        left, right = a + common, b + common
        inside = (left < end[a]) & (right < end[b])
        same = inside & (ranks[level][np.minimum(left, n - 1)] == ranks[level][np.minimum(right, n - 1)])
        common[same] += 1 << level
    out = np.zeros(n, np.int64)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def covered(words: Words, longest: np.ndarray, least: int) -> np.ndarray:
    """Per text the words inside repeats of at least ``least`` words, every occurrence included."""
    start = np.flatnonzero(longest >= least)
    edge = np.zeros(len(longest) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + longest[start], -1)
    inside = np.cumsum(edge[:-1]) > 0
    return np.bincount(words.doc[inside], minlength=len(words.counts))


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Per text its lines that have a word and equal an earlier line."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    doc = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    lines = lists.flatten().dictionary_encode()
    has_word = pc.match_substring_regex(lines.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    line = lines.indices.to_numpy()
    doc, line = doc[has_word[line]], line[has_word[line]]
    distinct = np.unique(doc * max(1, len(has_word)) + line) // max(1, len(has_word))
    return np.bincount(doc, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, longest_repeat long, base_failed boolean, kept boolean"


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_repeat: int = MIN_REPEAT, max_covered_percent: int = MAX_COVERED_PERCENT, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Measures and verdict for every row of ``docs``.

    A row is kept if it passes the base rules, repeats of ``min_repeat`` or more
    words cover at most ``max_covered_percent`` of its words, and no repeat is
    longer than ``max_repeat`` words. Null and empty texts have no words, so
    they fail the base rule; repeated rows are judged one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, most=2 << 20):
            texts = batch.column("text")
            words = Words(texts, lower=False)
            longest = repeats(words)
            chars = pc.utf8_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
            n = words.counts
            again = covered(words, longest, BASE_WINDOW)
            spans = covered(words, longest, min_repeat)
            top = np.zeros(len(n), np.int64)
            np.maximum.at(top, words.doc, longest)
            failed = (n < MIN_WORDS) | (100 * again > BASE_PERCENT * n)
            kept = ~failed & (100 * spans <= max_covered_percent * n) & (top <= max_repeat)
            symbols = pc.fill_null(pc.count_substring_regex(texts, SYMBOLS), 0)
            sums = np.bincount(words.doc, weights=chars[words.ids], minlength=len(n)).astype(np.int64)
            values = [n, sums, symbols.cast(pa.int64()), duplicate_lines(texts), again, spans, top, failed, kept]
            names = [c.split()[0] for c in RULES.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[v if isinstance(v, pa.Array) else pa.array(v) for v in values]], names=["doc_id", *names])

    return docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text").mapInArrow(run, f"doc_id long, {RULES}")


def op9_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return quality(table(spark, sf_dir, "documents", "doc_id", "text")).drop("longest_repeat")


def _window_sql(size: int, name: str) -> str:
    return f"""
{name}_w AS (SELECT r, p, list_aggregate(w[p:p + {size - 1}], 'string_agg', ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {size - 2})) AS p FROM d WHERE len(w) >= {size})),
{name}_r AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM {name}_w) WHERE c > 1),
{name} AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + {size})) AS q FROM {name}_r) GROUP BY r)"""


OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
{_window_sql(BASE_WINDOW, "base")}, {_window_sql(MIN_REPEAT, "span")}, {_window_sql(MAX_REPEAT + 1, "long")},
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m AS (SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
    cast(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
    coalesce(base.n, 0) AS n_repeat_words, coalesce(span.n, 0) AS n_covered, coalesce(long.n, 0) AS n_long
  FROM d LEFT JOIN base USING (r) LEFT JOIN span USING (r) LEFT JOIN long USING (r) LEFT JOIN lines USING (r)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, base_failed,
  NOT base_failed AND 100 * n_covered <= {MAX_COVERED_PERCENT} * n_words AND n_long = 0 AS kept FROM v"""
