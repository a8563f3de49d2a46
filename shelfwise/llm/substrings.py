"""Removing repeated substrings, found by recompression.

A text is a sequence of word names, its 64-bit hashes. One round of recompression
first joins every run of one symbol into a symbol, then splits the alphabet into
left and right symbols by a bit of their names and joins every neighbouring
(left, right) pair. A joined symbol's name is a hash of its parts, so all tasks
give equal strings equal names without talking to each other, and two equal
substrings get the same symbols but for those near their ends: what a symbol is
depends only on the words from ``low`` to ``high`` around it, its region, which
every round tracks. A window's anchor is the smallest region name among the
highest symbols whose region lies in the window; equal windows have equal anchors.

Windows travel to the bucket of their anchor in stretches that share it: the
anchor, document and place once, six bytes for each window's own hash. Windows
that a smaller document of the same slice has already are settled before they
travel, so a passage shared by very many documents goes out once a slice. In a
bucket, anchors of one document only are dropped; for the others the smallest
document of every (anchor, window hash) is found, and windows that stand in a
larger one go on as places to the bucket of their text, where the words they
cover are removed. Two windows are confused only if their anchors, 64 bits, and
their own hashes, 48 bits, agree. All that is shuffled is packed and compressed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import Words, bounded, fast_hashes, hash_strings, join_hashes, mix, ragged, table

WINDOW = 13
ROUNDS = 2
LONGEST = (1 << 16) - 1


def recompress(names: np.ndarray, first: np.ndarray, last: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray, level: int):
    """One round: runs, then pairs. ``first..last`` are a symbol's words, ``low..high`` those that decide it.

    A symbol that meets a text's end is decided by what lies beyond, marked by a
    place outside the text, so no window counts it as its own.
    """
    if not len(names):
        return names, first, last, low, high, doc
    # Runs: a run is decided by the symbols on both sides of it.
    cut = np.concatenate([[True], (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])])
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(names)) - 1
    length = tail - head + 1
    merged = np.where(length > 1, join_hashes(names[head], length.astype(np.uint64)), names[head])
    names2, doc2, first2, last2 = merged, doc[head], first[head], last[tail]
    same_left = np.concatenate([[False], doc2[1:] == doc2[:-1]])
    same_right = np.concatenate([doc2[1:] == doc2[:-1], [False]])
    low2 = np.minimum(low[head], np.where(same_left, low[np.maximum(head - 1, 0)], first2 - 1))
    high2 = np.maximum(high[tail], np.where(same_right, high[np.minimum(tail + 1, len(names) - 1)], last2 + 1))
    # Pairs: a right symbol looks to its left, a left symbol to its right.
    right = (mix(names2 ^ np.uint64(0xA5A5A5A5 + level)) & np.uint64(1)).astype(bool)
    n = len(names2)
    starts_pair = np.zeros(n, bool)
    starts_pair[:-1] = ~right[:-1] & right[1:] & (doc2[1:] == doc2[:-1])
    ends_pair = np.concatenate([[False], starts_pair[:-1]])
    before = np.maximum(np.arange(n) - 1, 0)
    after = np.minimum(np.arange(n) + 1, n - 1)
    low3 = np.where(right, np.minimum(low2, np.where(same_left, low2[before], first2 - 1)), low2)
    high3 = np.where(right, high2, np.maximum(high2, np.where(same_right, high2[after], last2 + 1)))
    keep = np.flatnonzero(~ends_pair)
    pair = starts_pair[keep]
    partner = np.minimum(keep + 1, n - 1)
    names3 = np.where(pair, join_hashes(names2[keep], names2[partner]), names2[keep])
    return (
        names3,
        first2[keep],
        np.where(pair, last2[partner], last2[keep]),
        np.where(pair, np.minimum(low3[keep], low3[partner]), low3[keep]),
        np.where(pair, np.maximum(high3[keep], high3[partner]), high3[keep]),
        doc2[keep],
    )


def anchors(names: np.ndarray, doc: np.ndarray, offsets: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The start of every window, its anchor's name, and whether it has no anchor.

    Symbols of a lower round stand in where a window has none of the last round
    to itself.
    """
    n = len(names)
    counts = np.diff(offsets)
    starts = ragged(offsets[:-1], np.maximum(counts - window + 1, 0))
    place = np.arange(n)
    state = (names, place, place, place, place, doc)
    levels = []
    for level in range(rounds):
        state = recompress(*state, level)
        levels.append(state)
    best = np.zeros(len(starts), np.uint64)
    open_ = np.ones(len(starts), bool)
    none = np.iinfo(np.uint64).max
    with np.errstate(over="ignore"):
        factors = np.cumprod(np.full(window + 1, 0x9E3779B97F4A7C15, np.uint64))
    for level in range(rounds - 1, -1, -1):
        if not open_.any():
            break
        _, _, _, low, high, symbol_doc = levels[level]
        fits = np.flatnonzero((high - low < window) & (low >= offsets[symbol_doc]) & (high < offsets[symbol_doc + 1]))
        low, size = low[fits], (high - low)[fits] + 1
        value = np.full(len(fits), level + 1, np.uint64)
        for k in range(window):
            value += np.where(k < size, mix(names[np.minimum(low + k, n - 1)]) * factors[k], np.uint64(0))
        value = mix(value)
        least = np.full(n, none, np.uint64)
        for step in range(window):  # windows from high - window + 1 to low hold the region
            inside = (step + size <= window) & (low - step >= 0)
            np.minimum.at(least, low[inside] - step, value[inside])
        here = least[starts]
        take = open_ & (here != none)
        best[take] = here[take]
        open_ &= ~take
    return starts, best, open_


def window_hashes(names: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A 64-bit hash of the words of every window."""
    factors = np.random.default_rng(13).integers(0, 1 << 63, window, np.uint64) * np.uint64(2) + np.uint64(1)
    total = np.zeros(len(starts), np.uint64)
    for k in range(window):
        total += mix(names[starts + k]) * factors[k]
    return mix(total)


def packed(*columns: np.ndarray) -> bytes:
    """Columns behind a header of their lengths and types, compressed."""
    head = b"".join(len(c).to_bytes(4, "little") + c.dtype.itemsize.to_bytes(1, "little") for c in columns)
    raw = len(columns).to_bytes(1, "little") + head + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return len(raw).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True)
    n, at = raw[0], 1 + 5 * raw[0]
    out = []
    for k in range(n):
        length, width = int.from_bytes(raw[1 + 5 * k : 5 + 5 * k], "little"), raw[5 + 5 * k]
        out.append(np.frombuffer(raw, f"<u{width}", length, at))
        at += length * width
    return out


def by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every value of ``group`` with the positions that have it."""
    order = np.argsort(group, kind="stable")
    cut = np.flatnonzero(np.diff(group[order])) + 1
    for part in np.split(order, cut) if len(order) else []:
        yield int(group[part[0]]), part


def smaller_elsewhere(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which entries have an equal key in an entry of a smaller document."""
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.empty(0, np.int64)
    out = np.zeros(len(key), bool)
    if len(key):
        low = np.minimum.reduceat(doc[order], heads)
        out[order] = doc[order] > np.repeat(low, np.diff(np.append(heads, len(key))))
    return out


def row_names(ids: np.ndarray, texts: pa.Array) -> np.ndarray:
    """A 64-bit name of each row; equal rows share it and are treated alike."""
    return join_hashes(mix(ids.view(np.uint64)), fast_hashes(pc.fill_null(texts, "")))


def emit_places(rows: np.ndarray, places: np.ndarray, lengths: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Stretches of covered windows, packed by the bucket of their text."""
    out = [(b, packed(rows[p], places[p].astype("<u4"), lengths[p].astype("<u2"))) for b, p in by_group((rows % np.uint64(buckets)).astype(np.int64))]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([d for _, d in out], pa.binary())], names=["bucket", "data"])


def stretches_of(starts: np.ndarray, doc: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heads and lengths of the stretches of windows that follow each other and agree in ``same``.

    Lengths travel in 16 bits, so longer stretches are cut into several.
    """
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = (np.diff(starts) != 1) | (np.diff(doc) != 0)
    for s in same:
        cut |= s[1:] != s[:-1]
    heads = np.concatenate([[0], np.flatnonzero(cut) + 1])
    lengths = np.diff(np.append(heads, len(starts)))
    pieces = -(-lengths // LONGEST)
    at = ragged(np.zeros(len(heads), np.int64), pieces) * LONGEST
    return np.repeat(heads, pieces) + at, np.minimum(np.repeat(lengths, pieces) - at, LONGEST)


def repeated_places(docs: DataFrame, buckets: int, text_buckets: int, window: int = WINDOW) -> DataFrame:
    """Packed places of all windows that a smaller document has too, by bucket of their text.

    Rows without an id neither lose words nor make others lose them: nothing is
    smaller than a missing id, and it is smaller than nothing.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            texts = batch.column("text")
            words = Words(texts, lower=False)
            if not len(words.ids):
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            rows = row_names(ids, texts)
            names = hash_strings(words.vocabulary)[words.ids]
            starts, anchor, alone = anchors(names, words.doc, words.offsets, window)
            own = window_hashes(names, starts, window)
            anchor = np.where(alone, own, anchor)
            own &= np.uint64((1 << 48) - 1)
            doc = words.doc[starts]
            place = starts - words.offsets[doc]
            settled = smaller_elsewhere(join_hashes(anchor, own), ids[doc])
            heads, lengths = stretches_of(place[settled], doc[settled], anchor[settled])
            for b, p in by_group((anchor[settled][heads] % np.uint64(buckets)).astype(np.int64)):
                yield tagged(b, 1, packed(rows[doc[settled][heads][p]], place[settled][heads][p].astype("<u4"), lengths[p].astype("<u2")))
            anchor, own, doc, place = anchor[~settled], own[~settled], doc[~settled], place[~settled]
            heads, lengths = stretches_of(place, doc, anchor)
            for b, p in by_group((anchor[heads] % np.uint64(buckets)).astype(np.int64)):
                members, local = np.unique(doc[heads[p]], return_inverse=True)
                inside = own[ragged(heads[p], lengths[p])]
                yield tagged(b, 0, packed(ids[members].view(np.uint64), rows[members], local.astype("<u4"), anchor[heads[p]], place[heads[p]].astype("<u4"), lengths[p].astype("<u2"), (inside >> np.uint64(32)).astype("<u2"), inside.astype("<u4")))

    def settle(table_: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        columns: list[list[np.ndarray]] = []
        for kind, data in zip(table_["kind"].to_pylist(), table_["data"].to_pylist()):
            if kind == 1:
                out += emit_places(*unpacked(data), text_buckets)
                continue
            ids, rows, local, anchor, place, lengths, high, low = unpacked(data)
            columns.append([ids[local].view(np.int64), rows[local], anchor, place.astype(np.int64), lengths.astype(np.int64), (high.astype(np.uint64) << np.uint64(32)) | low])
        if columns:
            ids, rows, anchor, place, lengths, own = (np.concatenate(c) for c in zip(*columns))
            # Anchors that only one document has are dropped before windows are compared.
            order = np.argsort(anchor, kind="stable")
            heads = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]]))
            several = np.minimum.reduceat(ids[order], heads) != np.maximum.reduceat(ids[order], heads)
            shared = np.zeros(len(anchor), bool)
            shared[order] = np.repeat(several, np.diff(np.append(heads, len(anchor))))
            own = own[ragged((np.cumsum(lengths) - lengths)[shared], lengths[shared])]
            ids, rows, anchor, place, lengths = ids[shared], rows[shared], anchor[shared], place[shared], lengths[shared]
            stretch = np.repeat(np.arange(len(lengths)), lengths)
            found = np.flatnonzero(smaller_elsewhere(join_hashes(anchor[stretch], own), ids[stretch]))
            at = place[stretch] + ragged(np.zeros(len(lengths), np.int64), lengths)
            heads, runs = stretches_of(at[found], stretch[found])
            out += emit_places(rows[stretch[found]][heads], at[found][heads], runs, text_buckets)
        return pa.Table.from_batches(out, pa.schema([("bucket", pa.int32()), ("data", pa.binary())]))

    sent = docs.where("doc_id is not null").mapInArrow(send, "bucket int, kind int, data binary")
    return sent.groupBy("bucket").applyInArrow(settle, "bucket int, data binary")


def tagged(bucket: int, kind: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([data], pa.binary())], names=["bucket", "kind", "data"])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row ``n_words``, ``n_removed`` and ``kept_text``, the words left joined by blanks.

    A word goes if a window of ``window`` words that covers it also starts in a
    row with a smaller id; windows are judged on the input. Null and empty texts
    have no words. Rows with equal ids are one document: they never count as
    smaller than each other.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, math.ceil(size / min(max(size / 4096, 1 << 20), 1 << 28)))
    text_buckets = max(64, buckets // 4)
    places = repeated_places(rows, buckets, text_buckets, window)

    def send_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            ids, texts = batch.column("doc_id"), batch.column("text")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy(zero_copy_only=False)
            names = row_names(values, texts)
            raw = pc.fill_null(texts, "").cast(pa.large_binary())
            for b, p in by_group((names % np.uint64(text_buckets)).astype(np.int64)):
                part = raw.take(pa.array(p))
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([packed(values[p].view(np.uint64), known[p].astype("<u1"), names[p], pc.binary_length(part).to_numpy(zero_copy_only=False).astype("<u8"), np.frombuffer(b"".join(part.to_pylist()), np.uint8))], pa.binary())], names=["bucket", "data"])

    def remove(texts: pa.Table, found: pa.Table) -> pa.Table:
        spots = [unpacked(d) for d in found["data"].to_pylist()]
        row, at, runs = (np.concatenate(c) for c in zip(*spots)) if spots else (np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint16))
        order = np.argsort(row, kind="stable")
        row, at, runs = row[order], at[order].astype(np.int64), runs[order].astype(np.int64)
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_text": []}
        for data in texts["data"].to_pylist():
            ids, known, names, lengths, raw = unpacked(data)
            edges = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
            whole = raw.tobytes()
            left, right = np.searchsorted(row, names, "left"), np.searchsorted(row, names, "right")
            for k in range(len(ids)):
                words = whole[edges[k] : edges[k + 1]].split()
                here = slice(left[k], right[k]) if known[k] else slice(0, 0)
                if here.start < here.stop:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, at[here], 1)
                    np.add.at(edge, at[here] + runs[here] + window - 1, -1)
                    kept = [w for w, gone in zip(words, np.cumsum(edge[:-1]) > 0) if not gone]
                else:
                    kept = words
                out["doc_id"].append(int(ids[k : k + 1].view(np.int64)[0]) if known[k] else None)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_text"].append(b" ".join(kept).decode())
        return pa.table(out, schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]))

    packed_texts = rows.mapInArrow(send_texts, "bucket int, data binary")
    return packed_texts.groupBy("bucket").cogroup(places.groupBy("bucket")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept_text string")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows of thirteen words that a smaller one has too."""
    out = without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
