"""Runs of wanted bytes in a batch of texts, found on the raw UTF-8 without a loop over rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(values: bytes) -> np.ndarray:
    """A table of 256 flags with the given bytes set."""
    out = np.zeros(256, bool)
    out[np.frombuffer(values, np.uint8)] = True
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts end to end, and where each text starts, the end last; null counts as empty."""
    filled = pc.fill_null(texts, "").cast(pa.large_binary())
    if len(filled) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data`` as a string array."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class Runs:
    """Maximal runs of kept bytes inside each text, coded by their distinct values.

    ``vocabulary`` holds the values, ``ids`` points into it, ``doc`` and
    ``start`` (in all bytes) say where each run lies.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, keep: np.ndarray):
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], keep[:-1]]) & ~edge[:-1] if len(data) else keep
        after = np.concatenate([keep[1:], [False]]) & ~edge[1:] if len(data) else keep
        self.start = np.flatnonzero(keep & ~before)
        lengths = np.flatnonzero(keep & ~after) - self.start + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        coded = strings(data[keep], lengths).dictionary_encode()
        self.vocabulary, self.ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
