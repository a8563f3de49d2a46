"""Elias-Fano sequences: sorted 64-bit numbers in near-minimal space, searched in place.

A sequence of n numbers below u keeps the low bits of each number in a fixed
width and marks the high parts in a bit vector of at most 2n bits and some. All
searches are vectorised over their queries.
"""

from __future__ import annotations

import numpy as np

EACH_BYTE, TOP_BITS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


def _in_byte() -> np.ndarray:
    """At ``rank * 256 + byte`` the place of the byte's one with that rank."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(bool)
    rank = np.cumsum(bits, axis=1) - 1
    table = np.zeros((8, 256), np.int64)
    byte, place = np.nonzero(bits)
    table[rank[byte, place], byte] = place
    return table.ravel()


IN_BYTE = _in_byte()


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted unsigned values, relative to the first of them, as flat arrays."""
    n, base = len(values), values[0]
    rest = values - base
    width = max(0, int(rest[-1]).bit_length() - max(1, n).bit_length())
    high = (rest >> np.uint64(width)).astype(np.int64)
    bits = np.zeros((int(high[-1]) + n + 1 + 63) // 64 * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))]).astype("<u4")
    return {"head": np.array([n, base, width], "<u8"), "words": words, "zeros": zeros, "low": pack_bits(rest, width)}


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of every value, end to end, as ``low_bits`` reads them."""
    # In pieces of whole bytes: a plane of bits takes many times the room of its number.
    places = np.arange(width, dtype=np.uint64)
    planes = [np.packbits(((values[a : a + 65536, None] >> places) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") for a in range(0, len(values), 65536)] if width else []
    return np.concatenate([*planes, np.zeros(16, np.uint8)])


def low_bits(low: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The ``width`` low bits of the numbers at the given positions."""
    if not width:
        return np.zeros(len(at), np.uint64)
    first = at * width
    byte, shift = first >> 3, (first & 7).astype(np.uint64)
    # Eight bytes from any place in one step: the array's padding covers the last ones.
    eight = np.ndarray(len(low) - 8, "<u8", low, strides=(1,))
    out = eight[byte] >> shift
    if width > 57:
        out |= np.where(shift > 0, low[byte + 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
    return out & np.uint64((1 << width) - 1)


def select_zero(words: np.ndarray, zeros: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Positions of the zeros with the given ranks, from 0."""
    return select_one(words, zeros, rank, flip=True)


def select_one(words: np.ndarray, before: np.ndarray, rank: np.ndarray, flip: bool = False) -> np.ndarray:
    """Positions of the ones (``flip``: zeros) with the given ranks; ``before`` counts them ahead of each word."""
    word = np.searchsorted(before, rank, "right") - 1
    left = (rank - before[word].astype(np.int64)).astype(np.uint64)
    value = words[np.minimum(word, len(words) - 1)]
    value = ~value if flip else value
    # All eight bytes of a word at once: ones up to and with each byte, bytes that end before the one sought.
    sums = np.bitwise_count(value.view(np.uint8)).view(np.uint64) * EACH_BYTE
    place = np.bitwise_count(((left * EACH_BYTE | TOP_BITS) - sums) & TOP_BITS).astype(np.uint64) << np.uint64(3)
    left -= ((sums << np.uint64(8)) >> place) & np.uint64(255)
    at = place.astype(np.int64) + IN_BYTE[(left << np.uint64(8)) | ((value >> place) & np.uint64(255))]
    return word * 64 + at


def next_one(words: np.ndarray, before: np.ndarray, rank: np.ndarray, at: np.ndarray, flip: bool = False) -> np.ndarray:
    """Positions of the ones (``flip``: zeros) that follow those with the given ranks, which lie ``at``."""
    value = words[at >> 6]
    rest = (~value if flip else value) & (np.uint64(2**64 - 2) << (at & 63).astype(np.uint64))
    out = (at & ~63) + np.bitwise_count((rest & (~rest + np.uint64(1))) - np.uint64(1))
    far = np.flatnonzero(rest == 0)
    out[far] = select_one(words, before, rank[far] + 1, flip)
    return out


def ones_before(code: dict[str, np.ndarray]) -> np.ndarray:
    """Ones before each word, from the stored zeros."""
    return 64 * np.arange(len(code["zeros"]), dtype=np.int64) - code["zeros"]


def behind(code: dict[str, np.ndarray], at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The values at the given positions of the sequence, whose ones lie at ``place``."""
    base, width = code["head"][1], int(code["head"][2])
    return (((place - at).astype(np.uint64) << np.uint64(width)) | low_bits(code["low"], width, at)) + base


def access(code: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """The values at the given positions of the sequence."""
    return behind(code, at, select_one(code["words"], ones_before(code), at))


def access_pairs(code: dict[str, np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values at the given positions and at those behind them."""
    ones = ones_before(code)
    place = select_one(code["words"], ones, at)
    return behind(code, at, place), behind(code, at + 1, next_one(code["words"], ones, at, place))


def find(code: dict[str, np.ndarray], queries: np.ndarray) -> np.ndarray:
    """The position of each query in the sequence, -1 where it is not in it."""
    n, base, width = int(code["head"][0]), code["head"][1], int(code["head"][2])
    out = np.full(len(queries), -1, np.int64)
    high_all = ((queries - base) >> np.uint64(width)).astype(np.int64)
    total = int(code["zeros"][-1])
    ok = np.flatnonzero((queries >= base) & (high_all >= 0) & (high_all < total))
    high, low = high_all[ok], (queries[ok] - base) & np.uint64((1 << width) - 1)
    # Numbers with this high part lie between the zero before them and their own.
    own = np.maximum(high - 1, 0)
    place = select_zero(code["words"], code["zeros"], own)
    start = np.where(high > 0, place - own, 0)
    end = np.minimum(np.where(high > 0, next_one(code["words"], code["zeros"], own, place, flip=True), place) - high, n)
    live = np.flatnonzero(start < end)
    while len(live):
        middle = (start[live] + end[live]) // 2
        value = low_bits(code["low"], width, middle)
        hit = value == low[live]
        out[ok[live[hit]]] = middle[hit]
        below = value < low[live]
        start[live] = np.where(below, middle + 1, start[live])
        end[live] = np.where(below, end[live], middle)
        live = live[~hit & (start[live] < end[live])]
    return out
