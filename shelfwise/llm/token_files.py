"""Token-ID files: flat unsigned integers, 64-bit document offsets, prefix-summed bases.

Documents are range-partitioned and sorted by id. Every task encodes its
documents as they stream by and writes three flat files: the token ids (16 or
32 bits, whichever holds the vocabulary), the offsets of its documents (n + 1
unsigned 64-bit integers) and their ids (signed 64-bit integers, null ids first
and counted). Only the number of documents and tokens of each file reaches the
driver, whose running sums are the bases that make local offsets global. A file
counts only if its task's row reached the manifest, so a retried or speculative
task leaves nothing behind that is read.

Words of a text never share a token with their neighbours (the tokenizer drops
white space), so every distinct word of a slice is encoded once and its ids are
copied to wherever the word stands.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import (
    Words,
    bounded,
    fast_hashes,
    kept_in_worker,
    map_array,
    open_fs,
    ragged,
    read_json,
    shared_path,
    table,
    write_bytes,
    write_json,
)

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
CACHED_WORDS = 2_000_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of words, remembered in sorted arrays of at most about ``cached_words`` entries.

    A word of letters with punctuation behind it is looked up as two pieces,
    which the tokenizer always separates.
    """

    PIECES = r"^(?P<core>\p{L}+)(?P<tail>[.,;:!?|$%&*#]*)$"

    def __init__(self, path: str, dtype: str, cached_words: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.dtype, self.most = dtype, cached_words
        self.state = kept_in_worker(f"token ids of {path}")
        if "tokenizer" not in self.state:
            self.state["tokenizer"] = Tokenizer.from_file(path)
            self.forget()

    def forget(self) -> None:
        self.state.update(keys=np.empty(0, np.uint64), starts=np.empty(0, np.int64), lengths=np.empty(0, np.int32), flat=np.empty(0, self.dtype))

    def learn(self, words: pa.Array, keys: np.ndarray) -> None:
        codes = self.state["tokenizer"].encode_batch_fast(words.to_pylist(), add_special_tokens=False)
        ids = [c.ids for c in codes]
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), self.dtype, int(lengths.sum()))
        starts = len(self.state["flat"]) + np.cumsum(lengths, dtype=np.int64) - lengths
        order = np.argsort(np.concatenate([self.state["keys"], keys]), kind="stable")
        for name, new in (("keys", keys), ("starts", starts), ("lengths", lengths)):
            self.state[name] = np.concatenate([self.state[name], new])[order]
        self.state["flat"] = np.concatenate([self.state["flat"], flat])

    def places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each of these distinct strings stand in ``flat``, and how many they are."""
        if len(self.state["keys"]) > self.most:
            self.forget()
        keys = fast_hashes(words)
        at = np.searchsorted(self.state["keys"], keys)
        known = at < len(self.state["keys"])
        known[known] = self.state["keys"][at[known]] == keys[known]
        if not known.all():
            self.learn(words.filter(pa.array(~known)), keys[~known])
            at = np.searchsorted(self.state["keys"], keys)
        return self.state["starts"][at], self.state["lengths"][at].astype(np.int64)

    def documents(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts end to end, each with ``end_id`` behind it, and the texts' lengths."""
        # The tokenizer lower-cases too; names of special tokens count only as written.
        words = Words(texts, lower=not pc.any(pc.match_substring(texts, "<|")).as_py())
        split = pc.extract_regex(words.vocabulary, self.PIECES)
        tail = pc.fill_null(pc.struct_field(split, "tail"), "")
        pieces = pa.concat_arrays([pc.coalesce(pc.struct_field(split, "core"), words.vocabulary), tail]).dictionary_encode()
        starts, lengths = self.places(pieces.dictionary)
        piece = pieces.indices.to_numpy().astype(np.int64).reshape(2, -1)
        has_tail = pc.greater(pc.binary_length(tail), 0).to_numpy(zero_copy_only=False)
        per_word = 1 + has_tail[words.ids]
        first = np.cumsum(per_word) - per_word
        sequence = np.empty(int(per_word.sum()), np.int64)
        sequence[first] = piece[0][words.ids]
        more = per_word == 2
        sequence[first[more] + 1] = piece[1][words.ids[more]]
        piece_lengths = lengths[sequence]
        piece_doc = np.repeat(words.doc, per_word)
        per_doc = np.bincount(piece_doc, weights=piece_lengths, minlength=len(texts)).astype(np.int64) + 1
        out = np.full(int(per_doc.sum()), end_id, self.dtype)
        within = np.ones(len(out), bool)
        within[np.cumsum(per_doc) - 1] = False
        out[within] = self.state["flat"][ragged(starts[sequence], piece_lengths)]
        return out, per_doc


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode ``docs`` into ``folder``; returns the manifest, one row per file, with bases.

    Nulls and empty texts hold the end id alone. Null ids come first, equal ids
    in the order of their texts' hashes. An empty table gives an empty manifest.
    """
    vocabulary = json.load(open(path))["model"]["vocab"]
    dtype = "<u2" if max(max(vocabulary.values()), end_id) < 1 << 16 else "<u4"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, chunks, lengths, ids, nulls = Encoder(path, dtype), [], [], [], 0
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        stem, sink = f"{folder}/{name}", None
        fs, target = open_fs(f"{stem}.ids")
        for batch in bounded(batches):
            if sink is None:
                fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                sink = fs.open_output_stream(target)
            tokens, counts = encoder.documents(batch.column("text"), end_id)
            sink.write(tokens.tobytes())
            lengths.append(counts)
            column = batch.column("doc_id")
            nulls += column.null_count
            ids.append(column.fill_null(0).to_numpy(zero_copy_only=False))
        if sink is not None:
            sink.close()
            counts = np.concatenate(lengths)
            write_bytes(f"{stem}.offsets", np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes())
            write_bytes(f"{stem}.docs", np.concatenate(ids).astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [stem], "dtype": [dtype], "n_docs": [len(counts)], "n_null": [nulls], "n_tokens": [int(counts.sum())]}, schema=MANIFEST_ARROW)

    found = sorted(ordered.mapInArrow(write, "part int, file string, dtype string, n_docs long, n_null long, n_tokens long").collect(), key=lambda r: r.part)
    manifest, base, doc_base = [], 0, 0
    for r in found:
        manifest.append({**r.asDict(), "base": base, "doc_base": doc_base})
        base, doc_base = base + r.n_tokens, doc_base + r.n_docs
    write_json(f"{folder}/manifest.json", manifest)
    return manifest_frame(docs.sparkSession, manifest)


MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("file", pa.string()), ("dtype", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, file string, dtype string, n_docs long, n_null long, n_tokens long, base long, doc_base long"


def manifest_frame(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    columns = [c.split()[0] for c in MANIFEST.split(", ")]
    frame = spark.createDataFrame([tuple(m[c] for c in columns) for m in manifest], MANIFEST)
    return frame.repartition(max(1, len(manifest)))


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_frame(spark, read_json(f"{folder}/manifest.json"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the memory-mapped files: its start, length and checksum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                ids, offsets, docs = map_array(f"{m['file']}.ids", m["dtype"]), map_array(f"{m['file']}.offsets", "<u8"), map_array(f"{m['file']}.docs", "<i8")
                for at in range(0, m["n_docs"], 20_000):
                    edges = offsets[at : at + 20_001].astype(np.int64)
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(edges[:-1], edges[1:])]
                    known = docs[at : at + 20_000]
                    none = np.arange(at, at + len(known)) < m["n_null"]
                    yield pa.RecordBatch.from_arrays([pa.array(known, pa.int64(), mask=none), pa.array(edges[:-1] + m["base"]), pa.array(np.diff(edges)), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, folder: str | None = None, path: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and read them back, one row per document."""
    folder = folder or shared_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, path or tokenizer_path()))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-ID files over all documents, read back as one row per document."""
    return token_table(table(spark, sf_dir, "documents", "doc_id", "text"))
