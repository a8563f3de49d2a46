"""What the operators share: words, hashes, bounded batches, shared files."""

from __future__ import annotations

import contextlib
import itertools
import json
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

# White space that separates words: blank and \x09 to \x0D.
SPACES = " \t\n\x0b\f\r"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
_OWN_ROOTS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table.

    Arrow batches are held to ``BATCH_BYTES`` from here on, so that a worker's
    memory follows neither the number of rows nor the longest texts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


# --- shared folder -------------------------------------------------------------


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOTS:
        _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="shelfwise-llm-")
        spark.sparkContext.setCheckpointDir(_OWN_ROOTS[app])
    return _OWN_ROOTS[app]


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once nothing reads them any more."""
    for df in frames:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            fs, path = open_fs(folder)
            fs.delete_dir(path)


@contextlib.contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system behind a path or URI, and the path inside it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_bytes(uri: str, data) -> None:
    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def map_array(uri: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where local, else read."""
    fs, path = open_fs(uri)
    if fs.get_file_info(path).size == 0:
        return np.empty(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def write_json(uri: str, value) -> None:
    write_bytes(uri, json.dumps(value).encode())


def read_json(uri: str):
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return json.loads(f.read())


# --- batches and words ----------------------------------------------------------


def bounded(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of ``column``; one long text may be more."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // most
        starts = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else []
        for a, b in zip(starts, [*starts[1:], len(group)]):
            yield batch.slice(a, b - a)


class Words:
    """The words of a batch of texts, laid end to end.

    ``vocabulary`` lists the distinct words, ``ids`` points into it, document
    ``d`` owns positions ``offsets[d]:offsets[d + 1]``.
    """

    def __init__(self, texts: pa.Array, lower: bool):
        filled = pc.fill_null(texts, "")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(filled) if lower else filled)
        flat = lists.flatten()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        if not full.all():
            flat, row = flat.filter(pa.array(full)), row[full]
        coded = flat.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.doc = row
        self.counts = np.bincount(row, minlength=len(lists)).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.counts)])

    def hashes(self, seed: int = 42) -> np.ndarray:
        """XXH64 of every word, in text order."""
        return hash_strings(self.vocabulary, seed)[self.ids]


def hash_strings(values: pa.Array, seed: int = 42) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    words = values.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    return np.fromiter(map(digest, words, itertools.repeat(seed)), np.uint64, len(values))


def fast_hashes(values: pa.Array, seed: int = 1) -> np.ndarray:
    """64-bit hashes of strings without a Python loop: a random multiplier for each byte position.

    For tables inside a task; contracts that name XXH64 use ``hash_strings``.
    """
    values = values.cast(pa.large_binary())
    if len(values) == 0:
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    place = ragged(np.zeros(len(values), np.int64), lengths)
    factors = np.random.default_rng(seed).integers(0, 1 << 63, max(1, int(lengths.max())), np.uint64) * np.uint64(2) + np.uint64(1)
    terms = np.append((data.astype(np.uint64) + np.uint64(1)) * factors[place], np.uint64(0))
    total = np.add.reduceat(terms, np.minimum(offsets[:-1] - offsets[0], len(terms) - 1))
    total[lengths == 0] = 0
    return mix(total + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def kept_in_worker(name: str) -> dict:
    """A dictionary that lives as long as the worker process, shared by its tasks."""
    return sys.modules.setdefault("_shelfwise_worker", types.ModuleType("_shelfwise_worker")).__dict__.setdefault(name, {})


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit name for each ordered pair."""
    with np.errstate(over="ignore"):
        return mix(mix(a + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0x9FB21C651E98DF25) + b)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, in order."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def word_count(text: str = "text"):
    """Number of words of a text column as a Spark expression; null counts 0."""
    trimmed = F.btrim(F.col(text), F.lit(SPACES))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, 0).otherwise(F.size(F.split(trimmed, WORD_BREAK))).cast("long")


def held_out(modulus: int, remainder: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo ``modulus``, is ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
