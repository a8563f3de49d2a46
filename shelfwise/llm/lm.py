"""LM scoring with an Elias-Fano n-gram trie.

Level 1 holds the hashes of all training words in order, so a word's number is
its rank. Level n holds the successors of every node of the level below: for each
context a monotone pointer to the start of its range, and in the range the
successors' word numbers in order. A query finds its context's two pointers and
searches between them. Every node keeps its smoothed probability in eight bits
and its count, in 32 bits or, in blocks with larger counts, 64.

A level lies in blocks, one flat file each, which workers map into memory, a few at
a time. Level 1 is cut by the leading bits of the hashes. Above, all contexts of one
block below form a row of blocks, cut by word number into as many as their tokens
need: word numbers follow hashes, so a context with a third of all tokens is
spread over its row like any other. The driver holds a name and size for each block.

Counts are sums over the whole corpus. A slice of texts sends its distinct n-grams
to their blocks once, sorted and packed; a task merges one block at a time.
Levels 2 and 3 keep n-grams that occur ``LEAST`` times or more, at 1 all of them,
so that the probabilities after a context sum to one.

An n-gram's probability mixes its relative frequency with the probability after
a shorter context; where a context was never seen, the shorter one speaks alone.
Rows that repeat are learned and scored again; texts of any length are taken whole.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import eliasfano
from shelfwise.llm.common import BATCH_BYTES, Words, bounded, hash_strings, held_out, map_array, ragged, shared_path, table, write_bytes

LEAST = 1
ORDER = 3
WEIGHT = 0.6
END = np.uint64(0x5B1CE5A1F00D0E2D)  # the end's name among word hashes
QUANTUM = 0.06
BLOCK_TOKENS = 2 << 20
OPEN_BLOCKS = 64
READ_WHOLE, READ_LAST = 8, 256  # successors a key, and besides, that are read instead of searched
CODEC = "zstd"


def quantised(log_p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-log_p / QUANTUM), 0, 255).astype(np.uint8)


def unigram_log(count: np.ndarray, tokens: int, words: int) -> np.ndarray:
    return np.log10((count + 0.5) / (tokens + 0.5 * (words + 1)))


class Level:
    """One level of the trie, from the names and sizes of its blocks.

    ``blocks`` are in the order of their numbers. ``rows`` says, for each block of
    ``below``, how many blocks its contexts' successors are cut into; level 1
    is cut into ``2 ** bits``.
    """

    def __init__(self, blocks: list[dict], below: Level | None = None, bits: int = 0, rows: list[int] | None = None, words: int = 0):
        self.blocks, self.below, self.bits = blocks, below, bits
        self.rows = np.array(rows or [], np.int64)
        self.starts = np.cumsum(self.rows) - self.rows
        self.numbers = np.array([b["block"] for b in blocks], np.int64)
        sizes = np.array([b["n"] for b in blocks], np.int64)
        self.bases = np.cumsum(sizes) - sizes
        self.size, self.total = int(sizes.sum()), sum(b["total"] for b in blocks)
        self.words = words or self.size
        self.open: OrderedDict[int, dict] = OrderedDict()

    def shape(self) -> dict:
        """All that ``Level`` is made from, without the level below."""
        return {"blocks": self.blocks, "bits": self.bits, "rows": self.rows.tolist(), "words": self.words}

    def block(self, k: int) -> dict[str, np.ndarray]:
        """The arrays of the k-th block, mapped; the one not used for longest is let go."""
        if k not in self.open:
            self.open[k] = mapped(self.blocks[k]["file"])
            if len(self.open) > OPEN_BLOCKS:
                self.open.popitem(last=False)
        self.open.move_to_end(k)
        return self.open[k]

    def numbered(self, keys: np.ndarray) -> np.ndarray:
        """The number of the block each key belongs to."""
        if self.below is None:
            return (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        context, word = self.parts(keys)
        row = np.searchsorted(self.below.bases, context, "right") - 1
        return self.starts[row] + (word * self.rows[row]) // self.words

    def parts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and word number of every key of a level above the first."""
        context = keys // np.uint64(self.words)
        return context.astype(np.int64), (keys - context * np.uint64(self.words)).astype(np.int64)

    def encoded(self, keys: np.ndarray) -> dict[str, np.ndarray]:
        """Sorted keys of one block as arrays: hashes as they are, successors behind pointers."""
        if self.below is None:
            return eliasfano.encode(keys)
        context, word = np.divmod(keys, np.uint64(self.words))
        pointers = np.searchsorted(context, np.arange(context[0], context[-1] + np.uint64(2), dtype=np.uint64))
        code = eliasfano.encode(pointers.astype(np.uint64))
        width = max(1, int(self.words - 1).bit_length())
        return {**code, "range": np.array([context[0], len(pointers) - 1, width], np.uint64), "word": eliasfano.pack_bits(word, width)}

    def span(self, number: int) -> tuple[int, int]:
        """The word numbers from which and below which a block's successors lie."""
        row = np.searchsorted(self.starts, number, "right") - 1
        part, parts = int(number - self.starts[row]), int(self.rows[row])
        return -(-part * self.words // parts), -(-(part + 1) * self.words // parts)

    def search(self, code: dict[str, np.ndarray], keys: np.ndarray, span: tuple[int, int] | None = None) -> np.ndarray:
        """The place of each of the ascending keys in a block, -1 where it is absent; ``span`` is the block's."""
        if self.below is None:
            return eliasfano.find(code, keys)
        first, contexts, width = (int(x) for x in code["range"])
        out = np.full(len(keys), -1)
        context, word = self.parts(keys)
        start, end = np.searchsorted(context, [first, first + contexts])
        own, wanted = context[start:end] - first, word[start:end]
        new = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
        low, high = (x.astype(np.int64)[np.cumsum(new) - 1] for x in eliasfano.access_pairs(code, own[new]))
        # Word numbers follow hashes, so a range's lie evenly in the block's span: the place is guessed from
        # the value and then from the last value read, every sixth time halved. Short ranges are read whole.
        floor, ceiling = span or (0, self.words)
        live = np.flatnonzero(low < high)
        low, high, wanted = low[live], high[live], wanted[live]
        live, slope = live + start, (high - low) / (ceiling - floor)
        guess, step = low + (wanted - floor) * slope, 0
        while len(live):
            if int((high - low).sum()) <= READ_WHOLE * len(live) + READ_LAST:
                place, owner = ragged(low, high - low), np.repeat(np.arange(len(live)), high - low)
                hit = np.flatnonzero(eliasfano.low_bits(code["word"], width, place).astype(np.int64) == wanted[owner])
                out[live[owner[hit]]] = place[hit]
                break
            middle = guess.astype(np.int64) if step % 6 < 5 else (low + high) >> 1
            middle = np.minimum(np.maximum(middle, low), high - 1)
            off = wanted - eliasfano.low_bits(code["word"], width, middle).astype(np.int64)
            hit = np.flatnonzero(off == 0)
            out[live[hit]] = middle[hit]
            low, high = np.where(off > 0, middle + 1, low), np.where(off < 0, middle, high)
            going = np.flatnonzero((low < high) & (off != 0))
            guess = (middle + off * slope)[going]
            live, low, high, wanted, slope = live[going], low[going], high[going], wanted[going], slope[going]
            step += 1
        return out

    def find(self, keys: np.ndarray, names: tuple[str, ...] = ("count", "prob")) -> list[np.ndarray]:
        """Node number of every key, -1 where absent, and what ``names`` says of ``count`` and quantised ``prob``, 0 there."""
        distinct, back = np.unique(keys, return_inverse=True)
        found = [np.full(len(distinct), -1), *(np.zeros(len(distinct), np.int64) for _ in names)]
        number = self.numbered(distinct)
        order = np.argsort(number, kind="stable")
        cut = np.searchsorted(number[order], self.numbers)
        end = np.searchsorted(number[order], self.numbers, "right")
        for k in np.flatnonzero(cut < end):
            own = order[cut[k] : end[k]]
            code = self.block(int(k))
            at = self.search(code, distinct[own], self.span(int(self.numbers[k])) if self.below is not None else None)
            hit = np.flatnonzero(at >= 0)
            own, at = own[hit], at[hit]
            found[0][own] = at + self.bases[k]
            for name, values in zip(names, found[1:]):
                values[own] = code[name][at]
        return [x[back] for x in found]

    def values(self, node: np.ndarray, name: str) -> np.ndarray:
        """``count``, or ``word``, at every node number."""
        block = np.searchsorted(self.bases, node, "right") - 1
        out = np.zeros(len(node), np.int64)
        for k in np.unique(block):
            own = block == k
            code, at = self.block(int(k)), node[own] - self.bases[k]
            out[own] = eliasfano.low_bits(code["word"], int(code["range"][2]), at).astype(np.int64) if name == "word" else code[name][at]
        return out


def levels_of(shapes: list[dict]) -> list[Level]:
    levels: list[Level] = []
    for shape in shapes:
        levels.append(Level(below=levels[-1] if levels else None, **shape))
    return levels


def written(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays as one flat file: a line that says where each lies, then their bytes at multiples of eight."""
    layout, at = {}, 0
    for name, x in arrays.items():
        layout[name] = (x.dtype.str, at, len(x))
        at += -(-x.nbytes // 8) * 8
    line = json.dumps(layout).encode()
    line += b" " * (-(len(line) + 8) % 8)
    body = [x.tobytes().ljust(-(-x.nbytes // 8) * 8, b"\0") for x in arrays.values()]
    write_bytes(uri, b"".join([len(line).to_bytes(8, "little"), line, *body]))


def mapped(uri: str) -> dict[str, np.ndarray]:
    data = map_array(uri, "u1")
    size = int.from_bytes(data[:8].tobytes(), "little")
    layout = json.loads(data[8 : 8 + size].tobytes())
    return {name: np.asarray(data[8 + size + at : 8 + size + at + n * np.dtype(kind).itemsize]).view(kind) for name, (kind, at, n) in layout.items()}


class Tokens:
    """The tokens of all texts, each text's end behind it: distinct hashes, each token's number
    among them, its text and its place in it."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, lower=True)
        sizes = words.counts + 1
        self.hashes = np.append(hash_strings(words.vocabulary), END)
        self.ids = np.full(int(sizes.sum()), len(words.vocabulary))
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        ends = np.cumsum(sizes)
        inside = np.ones(len(self.ids), bool)
        inside[ends - 1] = False
        self.ids[inside] = words.ids
        self.place = np.arange(len(self.ids)) - (ends - sizes)[self.doc]


def successors(levels: list[Level], tokens: Tokens, names: list[tuple[str, ...]]) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """For every token its word number and, level by level, its node as the end of an n-gram with
    what ``names`` asks of the level."""
    found = [[x[tokens.ids] for x in levels[0].find(tokens.hashes, names[0])]]
    word = found[0][0]
    for n, level in enumerate(levels[1:], 1):
        context = np.concatenate([[-1], found[-1][0][:-1]])
        good = np.flatnonzero((tokens.place >= n) & (context >= 0) & (word >= 0))
        own = [np.full(len(word), -1), *(np.zeros(len(word), np.int64) for _ in names[n])]
        for values, x in zip(own, level.find(context[good].astype(np.uint64) * np.uint64(levels[0].size) + word[good].astype(np.uint64), names[n])):
            values[good] = x
        found.append(own)
    return word, found


PIECES = "block long, size long, keys binary, counts binary"


def packed(values: np.ndarray) -> bytes:
    """Numbers that are mostly small, byte plane by byte plane, compressed."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec=CODEC, asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, size * 8, codec=CODEC, asbytes=True), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pieces(level: Level, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Sorted distinct keys with their counts, as one packed row for each block of a level to be."""
    number = level.numbered(keys)
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[order], prepend=-1))
    out = []
    for own in np.split(order, cuts[1:]) if len(keys) else []:
        k = keys[own]
        out.append((int(number[own[0]]), len(own), packed(np.diff(k, prepend=np.uint64(0))), packed(n[own])))
    columns = list(zip(*out)) if out else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["block", "size", "keys", "counts"])


def planned(levels: list[Level], splits: int) -> Level:
    """The next level, without blocks yet: its cuts follow from the level below."""
    if not levels:
        return Level([], bits=max(0, (splits - 1).bit_length()))
    below = levels[-1]
    rows = [-(-b["total"] // BLOCK_TOKENS) for b in below.blocks]
    return Level([], below, rows=[min(r, levels[0].size) for r in rows], words=levels[0].size)


def counted(docs: DataFrame, levels: list[Level], plan: Level, least: int) -> DataFrame:
    """The n-grams one longer than the trie has, as far as they can reach ``least``, as ``PIECES``."""
    shapes, next_shape = [x.shape() for x in levels], plan.shape()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = levels_of(shapes)
        goal = Level(below=known[-1] if known else None, **next_shape)
        for batch in bounded(batches, most=BATCH_BYTES):
            tokens = Tokens(batch.column("text"))
            if not known:
                order = np.argsort(tokens.hashes)
                n = np.bincount(tokens.ids, minlength=len(order))[order]
                yield pieces(goal, tokens.hashes[order][n > 0], n[n > 0])
                continue
            word, found = successors(known, tokens, [("count",), *[()] * (len(known) - 1)])
            node = found[-1][0]
            # Of the levels only the words' may hold what is rarer than ``least``.
            often = (node >= 0) & (found[0][1] >= least) if len(known) == 1 else node >= 0
            pair = np.flatnonzero((tokens.place[1:] >= len(known)) & often[:-1] & often[1:]) + 1
            keys = node[pair - 1].astype(np.uint64) * np.uint64(known[0].size) + word[pair].astype(np.uint64)
            yield pieces(goal, *np.unique(keys, return_counts=True))

    return docs.select("text").mapInArrow(run, PIECES)


def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several pieces, their counts added."""
    keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first).astype(np.int64)


def add_level(arrived: DataFrame, levels: list[Level], plan: Level, folder: str, least: int = 1) -> Level:
    """Merge the pieces of every block of ``plan``, write the blocks and return the level."""
    shapes, next_shape = [x.shape() for x in levels], plan.shape()

    def smoothed(known: list[Level], keys: np.ndarray, n: np.ndarray) -> np.ndarray:
        words = np.uint64(known[0].size)
        context, word = (x.astype(np.int64) for x in np.divmod(keys, words))
        if len(known) == 1:
            p = 10.0 ** unigram_log(known[0].values(word, "count"), known[0].total, known[0].size)
        else:
            # The last two words' own node gives the mixture one level down.
            last = known[-1].values(context, "word").astype(np.uint64)
            p = 10.0 ** (-QUANTUM * known[1].find(last * words + word.astype(np.uint64), ("prob",))[1])
        share = n / np.maximum(known[-1].values(context, "count"), 1)
        return quantised(np.log10(WEIGHT * share + (1 - WEIGHT) * p))

    def block(known: list[Level], goal: Level, number: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys, n = merged(parts)
        if known:
            keys, n = keys[n >= least], n[n >= least]
        if len(keys):
            prob = smoothed(known, keys, n) if known else np.zeros(len(keys), np.uint8)
            file = f"{folder}/level{len(known) + 1}-{uuid.uuid4().hex}"
            written(file, {**goal.encoded(keys), "count": n.astype("<u4" if n.max() < 1 << 32 else "<u8"), "prob": prob})
            yield pa.RecordBatch.from_pydict({"block": [number], "n": [len(keys)], "total": [int(n.sum())], "file": [file]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = levels_of(shapes)
        goal = Level(below=known[-1] if known else None, **next_shape)
        number, parts, held = None, [], 0
        for batch in batches:
            for own, size, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if own != number and parts:
                    yield from block(known, goal, number, parts)
                    parts, held = [], 0
                number = own
                parts.append((np.cumsum(unpacked(keys, size)), unpacked(counts, size)))
                held += size
                if held > 2 * BLOCK_TOKENS:
                    # Pieces of a block repeat their frequent keys; merged, they are within its tokens.
                    parts = [merged(parts)]
                    held = len(parts[0][0])
        if parts:
            yield from block(known, goal, number, parts)

    dealt = arrived.select("block", "size", "keys", "counts").repartition("block").sortWithinPartitions("block")
    found = [r.asDict() for r in dealt.mapInArrow(run, "block long, n long, total long, file string").collect()]
    return Level(sorted(found, key=lambda b: b["block"]), levels[-1] if levels else None, plan.bits, plan.rows.tolist(), levels[0].size if levels else 0)


def trained(docs: DataFrame, folder: str | None = None, order: int = ORDER, least: int = LEAST) -> list[dict]:
    """The levels of a trie over ``docs(text)``; empty without rows."""
    folder = folder or shared_path(docs.sparkSession, "trie")
    levels: list[Level] = []
    for _ in range(order):
        plan = planned(levels, docs.rdd.getNumPartitions())
        level = add_level(counted(docs, levels, plan, least), levels, plan, folder, least)
        if not level.size:
            break
        if level.size * max(1, (levels or [level])[0].size) >= 1 << 63:
            raise OverflowError("node numbers times vocabulary exceed 63 bits")
        levels.append(level)
    return [x.shape() for x in levels]


def score(docs: DataFrame, trie: list[dict], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: tokens, known tokens, N, the base score and the model's log10 probability.

    Null and empty texts hold their end alone. With nothing learned every token
    has the probability of an unseen one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = levels_of(trie)
        tokens, words = (levels[0].total, levels[0].size) if levels else (0, 0)
        for batch in bounded(batches, most=BATCH_BYTES):
            rows = batch.num_rows
            text = Tokens(batch.column("text"))
            if levels:
                _, found = successors(levels, text, [("count",), *[("prob",)] * (len(levels) - 1)])
            else:
                found = [[np.full(len(text.ids), -1), np.zeros(len(text.ids))]]
            doc, seen = text.doc, np.zeros(len(text.hashes))
            seen[text.ids] = found[0][1]
            base = unigram_log(seen, tokens, words)[text.ids]
            total = base.copy()
            for n in range(1, len(found)):
                context = np.concatenate([[False], found[n - 1][0][:-1] >= 0]) & (text.place >= n)
                node, code = found[n]
                total = np.where(node >= 0, -QUANTUM * code, np.where(context, np.log10(1 - WEIGHT) + total, total))
            sums = lambda x: np.bincount(doc, weights=x, minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.bincount(doc, minlength=rows)), pa.array(sums(found[0][1] > 0).astype(np.int64)), pa.array(np.full(rows, tokens, np.int64)), pa.array(sums(base)), pa.array(sums(total))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a trie learned from those not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    trie = trained(docs.where(~held_out(5, 1)))
    return score(docs, trie).select("doc_id", held_out(5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
