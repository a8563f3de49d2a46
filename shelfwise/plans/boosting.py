"""Gradient-boosted trees for several classes at once, with a softmax over their margins.

Every round fits one regression tree for each class to the gradients and hessians
of the log loss. Features are cut into bins once; a level of all trees of a round
is one job: tasks add up gradients by tree, node, feature and bin over all their
rows, sums are merged by blocks of features, and the best split of each node comes
back. Where the sums of a level are too large for a task, its nodes take several
jobs. The driver holds trees only, whose size follows from the settings, never
rows or sums.

Vectors stay sparse: only stored values are counted, and what is left of a node's
total lies in the bin of zero. Rows carry their margins in a stored table, which
is written anew every ``refresh`` rounds; the trees since then are walked.

Early stopping watches the log loss of a stratified slice of the training rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.operators.sampling import assign_parts, sample_quotas
from shelfwise.session import cut_lineage
from shelfwise.sources.models import load_metadata, save_metadata

STORED = "label int, weight double, slice int, row long, idx array<int>, bins array<int>, margins array<double>"
SUMS = "tree int, node int, block int, totals binary, sums binary"
SPLITS = "tree int, node int, feature int, bin int, gain double, g double, h double, total_g double, total_h double"
TOTAL, LOSS = -1, -2
CHUNK = 1024
# Rows added up at a time, bins in one record of sums, and bytes of sums a task holds.
ROWS, BLOCK, HELD = 40_000, 16_384, 256 << 20


@dataclass(frozen=True)
class SoftmaxConfig:
    """Rounds, tree size, shrinkage and sampling of the joint model.

    ``validation_fraction`` above 0 needs the row key; training ends when that
    slice's log loss has not improved for ``patience`` rounds.
    """

    n_estimators: int = 200
    max_depth: int = 8
    learning_rate: float = 0.1
    subsample: float = 0.8
    feature_fraction: float = 0.8
    bins: int = 32
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    validation_fraction: float = 0.0
    patience: int = 20
    refresh: int = 8
    seed: int = 42


def vector_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stored values of an Arrow column of vectors: row lengths, feature numbers, values."""
    dense = column.field("type").to_numpy(zero_copy_only=False) != 0
    lists = column.field("values")
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lengths)), lengths)
    # Dense vectors have no list of feature numbers: theirs are the places in the row.
    idx = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    idx[~dense[row]] = column.field("indices").flatten().to_numpy()
    keep = np.flatnonzero(values)
    return np.bincount(row[keep], minlength=len(lengths)).astype(np.int64), idx[keep], values[keep]


def bin_edges(rows: DataFrame, features: str, bins: int) -> dict[int, list[float]]:
    """Cut points of each feature: quantiles of its stored values, and zero."""

    def stored_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, idx, values = vector_arrays(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(idx.astype(np.int32)), pa.array(values)], names=["feature", "value"])

    marks = [k / bins for k in range(1, bins)]
    values = rows.select(F.col(features).alias("v")).mapInArrow(stored_values, "feature int, value double")
    found = values.groupBy("feature").agg(F.percentile_approx("value", marks, 10_000).alias("marks")).collect()
    return {r.feature: sorted({0.0, *r.marks}) for r in found}


class Bins:
    """Cut points of all features end to end, for lookups by feature."""

    def __init__(self, edges: dict[int, list[float]], n_features: int):
        self.edges = [np.array(edges.get(f, [0.0])) for f in range(n_features)]
        self.zero = np.array([int(np.searchsorted(e, 0.0)) for e in self.edges])
        sizes = np.array([len(e) + 1 for e in self.edges])
        self.most = int(sizes.max(initial=1))
        # The place of each feature's first bin, and the features of each block of sums.
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.flatnonzero(np.diff(self.start[:-1] // BLOCK, prepend=-1))
        self.blocks = list(zip(starts, [*starts[1:], n_features]))

    def of(self, idx: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Bin b holds values above cut b-1 and up to cut b."""
        out = np.zeros(len(idx), np.int32)
        order = np.argsort(idx, kind="stable")
        cuts = np.flatnonzero(np.diff(idx[order], prepend=-1))
        for own in np.split(order, cuts[1:]) if len(idx) else []:
            out[own] = np.searchsorted(self.edges[idx[own[0]]], values[own])
        return out


@dataclass
class Tree:
    """Nodes in heap order: the children of node i are 2i+1 and 2i+2; ``feature`` -1 marks a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = (2 << depth) - 1
        return cls(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size))


def walk(trees: list[Tree], depth: int, lengths: np.ndarray, idx: np.ndarray, bins: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """The node each row reaches in each tree, rows by trees."""
    out = np.zeros((len(lengths), len(trees)), np.int64)
    feature = np.concatenate([t.feature for t in trees] or [np.empty(0, np.int64)])
    cut = np.concatenate([t.bin for t in trees] or [np.empty(0, np.int64)])
    used = np.unique(feature[feature >= 0])
    if not len(used):
        return out
    place = np.full(len(zero) + 1, -1)
    place[used] = np.arange(len(used))
    inner, column = feature >= 0, np.maximum(place[feature], 0)
    first = np.arange(len(trees)) * len(trees[0].feature)
    ends = np.cumsum(lengths)
    for a in range(0, len(lengths), CHUNK):
        b = min(a + CHUNK, len(lengths))
        lo, hi = (ends[a] - lengths[a]), ends[b - 1]
        dense = np.repeat(zero[used][None, :], b - a, axis=0)
        row = np.repeat(np.arange(b - a), lengths[a:b])
        at = place[idx[lo:hi]]
        dense[row[at >= 0], at[at >= 0]] = bins[lo:hi][at >= 0]
        rows = (np.arange(b - a) * len(used))[:, None]
        node = out[a:b]
        for _ in range(depth):
            own = node + first
            open_ = inner.take(own)
            if not open_.any():
                break
            right = dense.take(rows + column.take(own)) > cut.take(own)
            node = np.where(open_, 2 * node + 1 + right, node)
        out[a:b] = node
    return out


def softmax(margins: np.ndarray) -> np.ndarray:
    powers = np.exp(margins - margins.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


def drawn(row: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """A share of the rows, the same on every run."""
    if share >= 1:
        return np.ones(len(row), bool)
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + turn) * 2 + 1)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


def drawn_features(n: int, seed: int, turn: int, tree: int, share: float) -> np.ndarray:
    return np.random.default_rng([seed, turn, tree]).random(n) < share if share < 1 else np.ones(n, bool)


@dataclass
class SoftmaxModel:
    """Fitted trees, round by round; scores batches and streams."""

    n_classes: int
    n_features: int
    edges: dict[int, list[float]]
    rounds: list[list[Tree]]
    depth: int
    learning_rate: float
    gains: dict[int, float] = field(default_factory=dict)
    history: list[tuple[float, float | None]] = field(default_factory=list)

    @property
    def featureImportances(self) -> SparseVector:
        """Summed gains by feature, scaled to a sum of 1."""
        total = sum(self.gains.values()) or 1.0
        return SparseVector(self.n_features, {f: g / total for f, g in self.gains.items()})

    def with_probabilities(self, df: DataFrame, column: str, features: str = "features") -> DataFrame:
        """Adds the probability array; map-only."""
        model = self
        inner = df.select(F.struct("*").alias("_all"), F.col(features).alias("_v"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins = Bins(model.edges, model.n_features)
            trees = [t for r in model.rounds for t in r]
            for batch in batches:
                lengths, idx, values = vector_arrays(batch.column("_v"))
                node = walk(trees, model.depth, lengths, idx, bins.of(idx, values), bins.zero)
                p = softmax(margins_of(trees, node, model.n_classes, np.zeros((len(lengths), model.n_classes))))
                yield pa.RecordBatch.from_arrays([batch.column("_all"), margin_lists(p)], names=["_all", "_p"])

        from pyspark.sql import types as T

        schema = T.StructType([T.StructField("_all", inner.schema["_all"].dataType), T.StructField("_p", T.ArrayType(T.DoubleType()))])
        return inner.mapInArrow(run, schema).select("_all.*", F.col("_p").alias(column))

    def save(self, spark: SparkSession, path: str) -> None:
        trees = [[[t.feature.tolist(), t.bin.tolist(), t.value.tolist()] for t in r] for r in self.rounds]
        settings = {k: getattr(self, k) for k in ("n_classes", "n_features", "depth", "learning_rate", "history")}
        save_metadata(spark, {**settings, "edges": list(self.edges.items()), "gains": list(self.gains.items())}, f"{path}/settings")
        rows = [(i, json.dumps(r)) for i, r in enumerate(trees)]
        spark.createDataFrame(rows, "round int, trees string").write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SoftmaxModel:
        s = load_metadata(spark, f"{path}/settings")
        rows = spark.read.parquet(f"{path}/trees").orderBy("round").collect()
        rounds = [[Tree(np.array(f), np.array(b), np.array(v)) for f, b, v in json.loads(r.trees)] for r in rows]
        return cls(s["n_classes"], s["n_features"], dict(s["edges"]), rounds, s["depth"], s["learning_rate"], dict(s["gains"]), [tuple(h) for h in s["history"]])


def margins_of(trees: list[Tree], node: np.ndarray, classes: int, start: np.ndarray) -> np.ndarray:
    """Margins after all the trees, which are in turn those of each class."""
    out = start.copy()
    for a in range(0, len(trees), classes):
        values = np.concatenate([t.value for t in trees[a : a + classes]])
        out += values.take(node[:, a : a + classes] + np.arange(classes) * len(trees[0].value))
    return out


def margin_lists(margins: np.ndarray) -> pa.Array:
    """A matrix as an Arrow column of lists."""
    offsets = np.arange(len(margins) + 1, dtype=np.int32) * margins.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.ascontiguousarray(margins).ravel()))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches."""
    held, rows = [], 0
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows >= ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class NodeSums:
    """Sums of some figures of rows by tree, node, feature and bin, added up over a task.

    ``pairs`` are the (tree, node) to add up, ordered by tree.
    """

    def __init__(self, bins: Bins, pairs: list[tuple[int, int]], figures: int):
        self.bins, self.pairs = bins, pairs
        self.size = int(bins.start[-1])
        self.table = np.zeros((len(pairs), figures, self.size))
        self.totals = np.zeros((len(pairs), figures))
        self.own: dict[int, dict[int, int]] = {}
        for i, (tree, node) in enumerate(pairs):
            self.own.setdefault(tree, {})[node] = i

    def add(self, tree: int, node: np.ndarray, row: np.ndarray, code: np.ndarray, figures: list[np.ndarray]) -> None:
        """Add rows at their ``node`` of a tree; ``row`` and ``code`` are the stored values' rows and bins."""
        own = self.own[tree]
        n, first = len(own), min(own.values())
        # Rows of other nodes go to one more place, which is dropped.
        place = np.full(int(max(node.max(initial=0), *own)) + 1, n)
        for number, i in own.items():
            place[number] = i - first
        slot = place[node]
        key = (slot * self.size)[row] + code if n > 1 or (slot > 0).any() else code
        for j, figure in enumerate(figures):
            sums = np.bincount(key, figure[row], (n + 1) * self.size)
            self.table[first : first + n, j] += sums[: n * self.size].reshape(n, self.size)
            self.totals[first : first + n, j] += np.bincount(slot, figure, n + 1)[:n]

    def records(self) -> Iterator[pa.RecordBatch]:
        for (tree, node), table, totals in zip(self.pairs, self.table, self.totals):
            blocks = [np.ascontiguousarray(table[:, self.bins.start[a] : self.bins.start[b]]).tobytes() for a, b in self.bins.blocks]
            yield sums_batch([(tree, node, i, totals.tobytes(), sums) for i, sums in enumerate(blocks)])


def sums_batch(records: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*records), kinds)], names=[c.split()[0] for c in SUMS.split(", ")])


def merged(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int, int], list[np.ndarray]]:
    """Totals and sums of each (tree, node, block), added up over the tasks that sent them."""
    out: dict = {}
    for batch in batches:
        for r in batch.to_pylist():
            found = [np.frombuffer(r["totals"]), np.frombuffer(r["sums"])]
            held = out.setdefault((r["tree"], r["node"], r["block"]), None)
            if held is None:
                out[r["tree"], r["node"], r["block"]] = [x.copy() for x in found]
            else:
                for x, y in zip(held, found):
                    x += y
    return out


def up_to_each_cut(bins: Bins, block: int, totals: np.ndarray, sums: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """First feature, sums up to each cut (figures, features, cuts), and which cuts there are.

    What is left of the totals lies in the bin of zero.
    """
    a, b = bins.blocks[block]
    sizes = np.diff(bins.start[a : b + 1])
    at = np.arange(bins.start[b] - bins.start[a]) + np.repeat(np.arange(b - a) * bins.most - (bins.start[a:b] - bins.start[a]), sizes)
    table = np.zeros((len(totals), (b - a) * bins.most))
    table[:, at] = sums.reshape(len(totals), -1)
    table = table.reshape(len(totals), b - a, bins.most)
    table[:, np.arange(b - a), bins.zero[a:b]] += totals[:, None] - table.sum(2)
    return a, np.cumsum(table, 2)[:, :, :-1], np.arange(bins.most - 1) < (sizes - 1)[:, None]


def in_groups(pairs: list[tuple[int, int]], bins: Bins, figures: int) -> list[list[tuple[int, int]]]:
    """The pairs of each pass, whose sums fit into a task."""
    most = max(1, HELD // (8 * figures * int(bins.start[-1])))
    return [pairs[a : a + most] for a in range(0, len(pairs), most)]


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column("idx")
    return np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy().astype(np.int64), batch.column("bins").flatten().to_numpy().astype(np.int64)


def _margins(batch: pa.RecordBatch, classes: int) -> np.ndarray:
    return batch.column("margins").flatten().to_numpy().reshape(batch.num_rows, classes)


class _Fit:
    """The state of one training run."""

    def __init__(self, config: SoftmaxConfig, rows: DataFrame, classes: int, bins: Bins):
        self.config, self.rows, self.classes, self.bins = config, rows, classes, bins
        self.since: list[Tree] = []

    def refresh(self) -> None:
        """Write the rows anew with the margins of all trees so far."""
        classes, depth, trees, zero = self.classes, self.config.max_depth, self.since, self.bins.zero

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node = walk(trees, depth, *_entries(batch), zero)
                margins = margins_of(trees, node, classes, _margins(batch, classes))
                yield batch.set_column(batch.schema.get_field_index("margins"), "margins", margin_lists(margins))

        self.rows, self.since = cut_lineage(self.rows.mapInArrow(run, STORED), "margins"), []

    def sums(self, turn: int, level: int, growing: list[Tree], pairs: list[tuple[int, int]], losses: bool) -> DataFrame:
        """Gradient sums of some (tree, node) of one level, added up in tasks; also the log loss of both slices."""
        config, classes, since, bins = self.config, self.classes, self.since, self.bins

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, loss = NodeSums(bins, pairs, 2), np.zeros((2, 2))
            for batch in gathered(batches):
                part = batch.column("slice").to_numpy()
                live = (part == 0) & drawn(batch.column("row").to_numpy(), config.seed, turn, config.subsample)
                if not losses:
                    batch, live = batch.filter(pa.array(live)), np.ones(int(live.sum()), bool)
                lengths, idx, own = _entries(batch)
                margins = _margins(batch, classes)
                if since:
                    margins = margins_of(since, walk(since, config.max_depth, lengths, idx, own, bins.zero), classes, margins)
                p = softmax(margins)
                label = batch.column("label").to_numpy()
                weight = batch.column("weight").to_numpy()
                if losses:
                    each = -weight * np.log(np.maximum(p[np.arange(len(label)), label], 1e-15))
                    loss += [[each[part == s].sum(), weight[part == s].sum()] for s in (0, 1)]
                if not pairs:
                    continue
                row = np.repeat(np.arange(len(label)), lengths)
                code = bins.start[idx] + own
                node = walk(growing, level, lengths, idx, own, bins.zero)
                if not live.all():
                    kept = live[row]
                    row, code = (np.cumsum(live) - 1)[row[kept]], code[kept]
                    p, label, weight, node = p[live], label[live], weight[live], node[live]
                for k in found.own:
                    g = weight * (p[:, k] - (label == k))
                    h = weight * np.maximum(p[:, k] * (1 - p[:, k]), 1e-16)
                    found.add(k, node[:, k], row, code, [g, h])
            if losses:
                yield sums_batch([(-1, s, LOSS, loss[s].tobytes(), b"") for s in (0, 1)])
            yield from found.records()

        return self.rows.mapInArrow(run, SUMS).repartition("tree", "node", "block")

    def best_splits(self, sums: DataFrame, turn: int) -> list:
        """The best split of each node and block: most gain, then the smallest feature and bin; also losses and totals."""
        config, bins = self.config, self.bins

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            for (tree, node, block), (totals, sums) in merged(batches).items():
                if block == LOSS:
                    rows.append((tree, node, LOSS, 0, 0.0, 0.0, 0.0, *totals))
                    continue
                if block == 0:
                    rows.append((tree, node, TOTAL, 0, 0.0, 0.0, 0.0, *totals))
                first, (g, h), cuts = up_to_each_cut(bins, block, totals, sums)
                total_g, total_h = totals
                lam = config.reg_lambda
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = g**2 / (h + lam) + (total_g - g) ** 2 / (total_h - h + lam) - total_g**2 / (total_h + lam)
                chosen = drawn_features(len(bins.zero), config.seed, turn, tree, config.feature_fraction)[first : first + len(gain)]
                allowed = cuts & chosen[:, None] & (h >= config.min_child_weight) & (total_h - h >= config.min_child_weight)
                gain = np.where(allowed, gain, -np.inf)
                if gain.size and gain.max() > 1e-9:
                    feature, cut = divmod(int(gain.argmax()), gain.shape[1])
                    rows.append((tree, node, first + feature, cut, gain[feature, cut], g[feature, cut], h[feature, cut], total_g, total_h))
            if rows:
                kinds = [pa.int32()] * 4 + [pa.float64()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in SPLITS.split(", ")])

        return sums.mapInArrow(run, SPLITS).collect()

    def losses(self, turn: int) -> list:
        """The log losses before a round."""
        return [r for r in self.best_splits(self.sums(turn, 0, [], [], True), turn)]

    def round(self, turn: int, gains: dict[int, float]) -> tuple[list[Tree], list]:
        """The trees of one round, and the losses before it."""
        config = self.config
        trees = [Tree.empty(config.max_depth) for _ in range(self.classes)]
        losses: list = []
        leaf = lambda g, h: -config.learning_rate * g / (h + config.reg_lambda)
        pairs = [(k, 0) for k in range(self.classes)]
        for level in range(config.max_depth):
            found: list = []
            for i, group in enumerate(in_groups(pairs, self.bins, 2)):
                found += self.best_splits(self.sums(turn, level, trees, group, level == 0 and i == 0), turn)
            best: dict = {}
            for r in found:
                if r.feature == LOSS:
                    losses.append(r)
                elif r.feature == TOTAL:
                    if level == 0:
                        trees[r.tree].value[0] = leaf(r.total_g, r.total_h)
                elif (r.gain, -r.feature) > (best[r.tree, r.node].gain, -best[r.tree, r.node].feature) if (r.tree, r.node) in best else True:
                    best[r.tree, r.node] = r
            for (k, node), s in best.items():
                tree = trees[k]
                tree.feature[node], tree.bin[node] = s.feature, s.bin
                tree.value[2 * node + 1] = leaf(s.g, s.h)
                tree.value[2 * node + 2] = leaf(s.total_g - s.g, s.total_h - s.h)
                gains[s.feature] = gains.get(s.feature, 0.0) + s.gain
            pairs = [(k, child) for k, node in sorted(best) for child in (2 * node + 1, 2 * node + 2)]
            if not pairs:
                break
        return trees, losses


def _means(losses: list) -> tuple[float, float | None]:
    by = {r.node: (r.total_g, r.total_h) for r in losses}
    mean = lambda s: by[s][0] / by[s][1] if s in by and by[s][1] else None
    return mean(0), mean(1)


def train_softmax(rows: DataFrame, config: SoftmaxConfig = SoftmaxConfig(), label: str = "label", weight: str | None = None, key: list[str] | None = None, features: str = "features") -> SoftmaxModel:
    """Fit the joint model on ``features`` and a label index from 0.

    Without a round that improves the validation slice the first one is kept.
    """
    first = rows.select(features).first()
    if first is None:
        raise ValueError("the training frame has no rows")
    n_features = first[0].size
    classes = int(rows.agg(F.max(label)).first()[0]) + 1
    edges = bin_edges(rows, features, config.bins)
    bins = Bins(edges, n_features)
    frame = rows
    if config.validation_fraction > 0:
        if not key:
            raise ValueError("a validation slice needs the row key")
        ends = sample_quotas(rows, label, config.validation_fraction).select(label, "upto")
        frame = assign_parts(rows, label, key, ends, config.seed).withColumn("_slice", (F.col("part") == 0).cast("int"))
    slice_ = F.col("_slice") if config.validation_fraction > 0 else F.lit(0)
    plain = frame.select(F.col(label).cast("int").alias("label"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"), slice_.alias("slice"), F.monotonically_increasing_id().alias("row"), F.col(features).alias("v"))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, idx, values = vector_arrays(batch.column("v"))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (idx, bins.of(idx, values))]
            margins = margin_lists(np.zeros((len(lengths), classes)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "weight", "slice", "row")), *lists, margins], names=[c.split()[0] for c in STORED.split(", ")])

    fit = _Fit(config, cut_lineage(plain.mapInArrow(binned, STORED), "binned"), classes, bins)
    rounds: list[list[Tree]] = []
    history: list = []
    gains: dict[int, float] = {}
    best, best_loss = 0, np.inf
    for turn in range(config.n_estimators):
        trees, losses = fit.round(turn, gains)
        if turn:
            history.append(_means(losses))
            if history[-1][1] is not None and history[-1][1] < best_loss - 1e-12:
                best, best_loss = turn, history[-1][1]
            if history[-1][1] is not None and turn - best >= config.patience:
                break
        rounds.append(trees)
        fit.since = fit.since + trees
        if len(fit.since) >= config.refresh * classes:
            fit.refresh()
    if len(history) < len(rounds):
        history.append(_means(fit.losses(len(rounds))))
        if history[-1][1] is not None and history[-1][1] < best_loss - 1e-12:
            best = len(rounds)
    if config.validation_fraction > 0:
        rounds = rounds[: max(1, best)]
    return SoftmaxModel(classes, n_features, edges, rounds, config.max_depth, config.learning_rate, gains, history)
