"""CSV with line breaks inside quotes, read by many tasks a file.

A file is scanned as plain lines, which Spark cuts at any line break. A line
either starts inside quotes or not, and each of the two leads to one state at its
end; such steps can be chained, so three scans find the true rows:

1. every split chains its lines; chained again over the splits of a file, this
   tells each split whether it starts inside quotes;
2. splits at whose edges a row is open hand on its pieces, two a split at
   most (or all of a split that lies inside one row), which are put together in order;
3. every split joins its own lines into rows, batch by batch.

The rows then go through Spark's own CSV parser. Only one row for each split, and
the pieces, are shuffled; broadcast is one row for each split with an open edge.
A quote opens a value only at its start, inside a value it is doubled; elsewhere it
is a plain character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
VALUE = '(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|(?:[^",][^,]*)?)'
CLOSED = f"^{VALUE}(?:,{VALUE})*$"
STATES = "file string, block long, from_out boolean, from_in boolean"
PIECES = "file string, block long, place int, row string"
PIECE, WHOLE, START = 0, 1, 2


def _steps(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line ends inside quotes if it starts outside, and if it starts inside."""
    outside, inside = np.zeros(len(values), bool), np.ones(len(values), bool)
    some = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
    if len(some):
        lines = values.take(pa.array(some))
        for start, out in (("", outside), ('"', inside)):
            out[some] = ~pc.match_substring_regex(pc.binary_join_element_wise(start, lines, ""), CLOSED).to_numpy(zero_copy_only=False)
    return outside, inside


def _walk(values: pa.Array, start: bool) -> np.ndarray:
    """Whether each line ends inside quotes, the first one starting in ``start``."""
    outside, inside = _steps(values)
    # A line that ends alike from both starts fixes the state; others keep or turn it.
    turns = np.cumsum(outside & ~inside)
    fixed = np.where(outside == inside, np.arange(len(values)), -1)
    last = np.maximum.accumulate(fixed) if len(values) else fixed
    base = np.where(last >= 0, outside[last], start)
    return base ^ ((turns - np.where(last >= 0, turns[last], 0)) % 2 == 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The batches cut where the split changes. A task reads the lines of a split in order."""
    for batch in batches:
        change = np.zeros(batch.num_rows, bool)
        for name in ("file", "block"):
            codes = batch.column(name).dictionary_encode().indices.to_numpy()
            change |= np.diff(codes, prepend=codes[:1]) != 0
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield (batch.column("file")[a].as_py(), batch.column("block")[a].as_py()), batch.slice(a, b - a)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The end of every split from either start."""
    ends: dict[tuple, list[bool]] = {}
    for key, batch in _by_split(batches):
        state = ends.setdefault(key, [False, True])
        ends[key] = [bool(_walk(batch.column("value"), s)[-1]) for s in state]
    files, blocks = [k[0] for k in ends], [k[1] for k in ends]
    yield pa.RecordBatch.from_arrays(
        [pa.array(files, pa.string()), pa.array(blocks, pa.int64()), *(pa.array([v[i] for v in ends.values()], pa.bool_()) for i in (0, 1))],
        names=["file", "block", "from_out", "from_in"],
    )


def split_states(lines: DataFrame) -> DataFrame:
    """``(file, block, inside, open)``: whether each split starts and ends inside quotes."""
    ends = lines.mapInArrow(_chained, STATES)
    order = W.partitionBy("file").orderBy("block")
    turned = F.sum((F.col("from_out") & ~F.col("from_in")).cast("int")).over(order)
    ends = ends.withColumn("turned", turned)
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.struct("from_out", "turned"))
    ends = ends.withColumn("fixed", F.last(fixed, ignorenulls=True).over(order))
    since = F.col("turned") - F.coalesce("fixed.turned", F.lit(0))
    ends = ends.withColumn("open", (F.coalesce(F.col("fixed.from_out").cast("int"), F.lit(0)) + since) % 2 == 1)
    inside = F.coalesce(F.lag("open").over(order), F.lit(False))
    return ends.select("file", "block", inside.alias("inside"), "open")


def _joined(values: pa.Array, starts: np.ndarray) -> pa.Array:
    """Rows from lines: the i-th from line ``starts[i]`` up to the next start."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int64()), values.cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines, with ``inside`` for their split's start, to rows and pieces; a file's first row, the header, is left out."""

    def emit(place: int, rows: pa.Array) -> Iterator[pa.RecordBatch]:
        nonlocal header
        if header and place != PIECE:
            rows, header = rows.slice(1), False
        n = len(rows)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array([place] * n, pa.int32()), rows], names=["file", "block", "place", "row"])

    def last() -> Iterator[pa.RecordBatch]:
        if tail:
            yield from emit(PIECE if not begun else START if inside else WHOLE, pa.array(["\n".join(tail)], pa.string()))

    key, inside, begun, header, tail = None, False, False, False, []
    for own, batch in _by_split(batches):
        if own != key:
            yield from last()
            key, inside, tail = own, batch.column("inside")[0].as_py(), []
            begun, header = not inside, own[1] == 0
        values = batch.column("value")
        after = _walk(values, inside)
        starts = np.flatnonzero(~np.concatenate([[inside], after[:-1]]))
        inside = bool(after[-1])
        if not len(starts):
            tail += values.to_pylist()
            continue
        # What lies before the first start ends the row that is open.
        tail += values.slice(0, starts[0]).to_pylist()
        if tail:
            yield from emit(WHOLE if begun else PIECE, pa.array(["\n".join(tail)], pa.string()))
        begun = True
        if len(starts) > 1:
            yield from emit(WHOLE, _joined(values.slice(0, starts[-1]), starts[:-1]))
        tail = values.slice(starts[-1]).to_pylist()
    yield from last()


def true_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the files but their headers as one text column ``row``, in no set order."""
    from shelfwise.session import cut_lineage

    lines = _lines(spark, path)
    states = cut_lineage(split_states(lines), "splits")
    edges = F.broadcast(states.where("inside or open"))
    # A broadcast join leaves the lines of a split in order.
    whole = lines.join(edges.select("file", "block", "inside"), ["file", "block"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    whole = whole.mapInArrow(_pieces, PIECES).where(F.col("place") == WHOLE).select("row")
    cut = lines.join(edges.select("file", "block", "inside"), ["file", "block"]).mapInArrow(_pieces, PIECES).where(F.col("place") != WHOLE)
    order = W.partitionBy("file").orderBy("block", "place")
    cut = cut.withColumn("owner", F.sum((F.col("place") == START).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "row")))
    closed = cut.groupBy("file", "owner").agg(parts.alias("parts"))
    return whole.unionByName(closed.select(F.array_join(F.transform("parts", lambda p: p["row"]), "\n").alias("row")))


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header of the first file."""
    names = spark.read.options(header=True, multiLine=True, **OPTIONS).csv(path).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    rows = true_rows(spark, path).select(F.rtrim("row", F.lit("\r")).alias("row")).where("row <> ''")
    return rows.select(F.from_csv("row", schema, OPTIONS).alias("r")).select("r.*")
