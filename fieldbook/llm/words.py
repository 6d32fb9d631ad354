"""Words and shingles of many texts at once, as 64-bit hashes, with numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return; A to Z count as a to z.
Hashes are polynomials over random byte values with an odd base, then mixed; unequal words meet with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Texts are taken together up to so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def series(n: int, seed: int) -> np.ndarray:
    """The same n 64-bit values everywhere."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * GOLDEN)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
VALUES = series(256, 1)[LOWER]
VALUES[SPACE] = 0
BASE = np.uint64(0x2545F4914F6CDD1D)
PLACES = series(64, 2) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and where each starts; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    return data[first : offsets[-1] if len(offsets) else 0], offsets - first


def blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first text, bytes and offsets of runs of texts."""
    data, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start, and which text each is in."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    black = ~SPACE[data]
    opens = black.copy()
    opens[1:] &= ~black[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    opens[edges] = black[edges]
    starts = np.flatnonzero(opens)
    return starts, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each word, over its lower-case bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        data = data[starts[0] :]
        starts = starts - starts[0]
        lengths = np.diff(starts, append=len(data))
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), BASE, np.uint64))
        sums = np.add.reduceat(VALUES[data] * powers[place], starts)
        return mix(sums * GOLDEN + np.uint64(1))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words of one text; of all its words where there are fewer; none without words."""
    n = min(n, len(hashes))
    if not n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        places = PLACES[:n] if n <= len(PLACES) else series(n, 2) | np.uint64(1)
        out = hashes[: len(hashes) - n + 1] * places[0]
        for j in range(1, n):
            out += hashes[j : len(hashes) - n + 1 + j] * places[j]
        return mix(out + np.uint64(n) * GOLDEN)


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text in turn."""
    for _, data, offsets in blocks(column):
        starts, owner = word_spans(data, offsets)
        hashes = word_hashes(data, starts)
        cuts = np.searchsorted(owner, np.arange(len(offsets)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield np.unique(shingles(hashes[a:b], n))
