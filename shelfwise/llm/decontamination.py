"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Test items are sorted by length and cut into blocks. Every block keeps, for each
of its words, the largest impact any of its items gives it; impacts are BM25
weights divided by the item's score for itself, so 1 is the whole item and one
threshold serves all. A block's commonest words are set aside as long as they
alone can't lift any of its items to the threshold; a passage is looked at in a
block only where the block maxima of its other words, plus what the words set
aside could add at most, reach the threshold. Items of the blocks left are
scored exactly; those at or above the threshold are verified by their five-word
shingles: ``OVERLAP`` of all shingles of the item, whichever part of it is missing,
or of both its question and its answer, which may stand apart.

Passages are windows of two strides, a stride being at least the length of the
block's longest item, so every item that stands in a text stands whole in some
passage. Items are indexed ``ITEMS`` at a time, which bounds the broadcast index
whatever the size of the benchmark; each such part costs one pass over the texts.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import Words, bounded, ragged, table

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.5
SHINGLE = 5
BLOCK = 32
ITEMS = 20_000
PUNCTUATION = r"[^\p{L}\p{M}\p{N}]+"
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def tokens(text: str | None) -> list[str]:
    """Words in lower case without punctuation, as ``matches`` reads them in texts."""
    flat = pc.utf8_lower(pc.ascii_split_whitespace(pa.array([text or ""])).flatten())
    return [w for w in pc.replace_substring_regex(flat, PUNCTUATION, "").to_pylist() if w]


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """An item's last sentence is its answer; one sentence alone is a question."""
    parts = SENTENCE.split((text or "").strip())
    return (tokens(" ".join(parts[:-1])), tokens(parts[-1])) if len(parts) > 1 else (tokens(text), [])


def shingles(words: list[str]) -> set[tuple]:
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def build_index(items: list[tuple], threshold: float = THRESHOLD) -> dict:
    """The index of ``(item_id, text)`` pairs; items without words are left out."""
    split = [(i, *question_and_answer(t)) for i, t in items]
    split = sorted(((i, q, a) for i, q, a in split if q or a), key=lambda x: (len(x[1]) + len(x[2]), str(x[0])))
    docs = [q + a for _, q, a in split]
    df = Counter(w for d in docs for w in set(d))
    mean = sum(map(len, docs)) / max(1, len(docs))
    vocabulary = {w: k for k, w in enumerate(sorted(df))}
    impacts = []
    for d in docs:
        raw = {w: np.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(d) / mean)) for w, n in Counter(d).items()}
        whole = sum(raw.values())
        impacts.append({vocabulary[w]: v / whole for w, v in raw.items()})
    blocks = []
    for at in range(0, len(docs), BLOCK):
        own = range(at, min(at + BLOCK, len(docs)))
        top: dict[int, float] = defaultdict(float)
        for i in own:
            for w, v in impacts[i].items():
                top[w] = max(top[w], v)
        names = list(vocabulary)
        common, spent = set(), dict.fromkeys(own, 0.0)
        for w in sorted(top, key=lambda w: (-df[names[w]], w)):
            after = {i: spent[i] + impacts[i].get(w, 0.0) for i in own}
            if max(after.values()) >= 0.8 * threshold:
                break
            common.add(w)
            spent = after
        rare = {w: v for w, v in top.items() if w not in common}
        order = sorted(rare)
        postings = [[(i - at, impacts[i][w]) for i in own if w in impacts[i]] for w in order]
        blocks.append(
            {
                "items": list(own),
                "stride": max(len(docs[i]) for i in own),
                "words": np.array(order, np.int64),
                "top": np.array([rare[w] for w in order]),
                "slack": np.array([spent[i] for i in own]),  # what the words set aside add to an item at most
                "first": np.cumsum([0, *map(len, postings)]),
                "item": np.array([i for p in postings for i, _ in p], np.int64),
                "impact": np.array([v for p in postings for _, v in p]),
            }
        )
    return {"vocabulary": vocabulary, "impacts": impacts, "blocks": blocks, "items": [i for i, _, _ in split], "question": [shingles(q) for _, q, _ in split], "answer": [shingles(a) for _, _, a in split], "whole": [shingles(d) for d in docs], "threshold": threshold}


def retrieve(index: dict, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """All ``(document, item, from, to, score)`` at or above the threshold.

    ``words`` holds vocabulary numbers, -1 for words of no item; document d owns
    ``offsets[d]:offsets[d + 1]``.
    """
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    size = max(1, len(index["vocabulary"]))
    threshold = index["threshold"] - 1e-9
    for block in index["blocks"]:
        place = np.full(size + 1, -1)
        place[block["words"]] = np.arange(len(block["words"]))
        rare = place[words]  # -1 picks the last, empty place
        at = np.flatnonzero(rare >= 0)
        if not len(at):
            continue
        stride = block["stride"]
        chunk = (at - offsets[doc_of[at]]) // stride
        # Passage c of a document covers its chunks c and c + 1.
        passage = np.concatenate([chunk, np.maximum(chunk - 1, 0)])
        span = int(passage.max()) + 1
        pairs = np.unique((np.tile(doc_of[at], 2) * span + passage) * len(block["words"]) + np.tile(rare[at], 2))
        where, word = np.divmod(pairs, len(block["words"]))
        found, group = np.unique(where, return_inverse=True)
        bound = np.bincount(group, weights=block["top"][word]) + block["slack"].max()
        open_ = bound[group] >= threshold
        group, word = group[open_], word[open_]
        # In the passages left, the postings of their words, summed by passage and item.
        many = block["first"][word + 1] - block["first"][word]
        posting = ragged(block["first"][word], many)
        cell, sums = np.unique(np.repeat(group, many) * BLOCK + block["item"][posting], return_inverse=True)
        partial = np.bincount(sums, weights=block["impact"][posting], minlength=len(cell))
        near = np.flatnonzero(partial + block["slack"][cell % BLOCK] >= threshold)
        for passage_at, i in zip(cell[near] // BLOCK, cell[near] % BLOCK):
            d, c = divmod(int(found[passage_at]), span)
            a = int(offsets[d]) + c * stride
            b = min(int(offsets[d + 1]), a + 2 * stride)
            own = block["items"][int(i)]
            present = set(words[a:b].tolist())
            score = sum(v for x, v in index["impacts"][own].items() if x in present)
            if score >= threshold:
                yield d, own, a, b, min(1.0, score)


def matches(index: dict, texts: pa.Array, overlap: float = OVERLAP) -> dict[tuple[int, int], tuple[float, float, float]]:
    """Verified ``(document, item)`` pairs with score, question share and answer share."""
    words = Words(texts, lower=True)
    flat = pc.replace_substring_regex(pc.utf8_lower(words.vocabulary), PUNCTUATION, "")
    number = pc.fill_null(pc.index_in(flat, pa.array(list(index["vocabulary"]), pa.string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    number[pc.equal(flat, "").to_numpy(zero_copy_only=False)] = -2
    ids = number[words.ids]
    keep = ids != -2
    ids, doc, source = ids[keep], words.doc[keep], words.ids[keep]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
    out: dict[tuple[int, int], tuple[float, float, float]] = {}
    for d, i, a, b, score in retrieve(index, ids, offsets):
        parts = [index[name][i] for name in ("question", "answer", "whole")]
        here = shingles_of(flat.take(pa.array(source[a:b])).to_pylist(), set().union(*parts))
        *share, whole = [len(part & here) / len(part) if part else 1.0 for part in parts]
        if whole >= overlap or min(share) >= overlap:
            out[d, i] = max(out.get((d, i), (0.0, 0.0, 0.0)), (score, *share))
    return out


def shingles_of(window: list[str], wanted: set[tuple]) -> set[tuple]:
    """The wanted shingles that stand in a window, of whatever length each is."""
    sizes = {len(s) for s in wanted}
    return {s for n in sizes for i in range(len(window) - n + 1) if (s := tuple(window[i : i + n])) in wanted}


def indexes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", items: int = ITEMS) -> Iterator[dict]:
    """Indexes of at most about ``items`` items each, together of all; a part is picked by the hash of its ids."""
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    parts = -(-rows.count() // items)
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("i"), F.lit(parts)) == part).distinct()
        yield build_index([(r.i, r.t) for r in own.collect()])


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document row and test item it holds.

    Null and empty texts hold nothing; null or empty items are never held. Equal
    rows of ``docs`` each give their own rows. No items, no rows.
    """
    spark, rows = docs.sparkSession, docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id long, item_id {kind}, score double, question_overlap double, answer_overlap double"
    out = None
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in bounded(batches, most=1 << 20):
                found = matches(shared.value, batch.column("text"))
                if found:
                    ids = batch.column("doc_id").to_pylist()
                    columns = zip(*((ids[d], shared.value["items"][i], *v) for (d, i), v in found.items()))
                    yield pa.RecordBatch.from_pydict(dict(zip(("doc_id", "item_id", "score", "question_overlap", "answer_overlap"), map(list, columns))))

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no test item."""
    spark = docs.sparkSession
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in bounded(batches, text, 1 << 20):
                clean = np.ones(batch.num_rows, bool)
                clean[[d for d, _ in matches(shared.value, batch.column(text))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a test item, with the item and how much of it."""
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
