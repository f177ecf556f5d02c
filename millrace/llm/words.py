"""Words and word shingles of many texts at once, as numpy arrays over the Arrow buffers.

A word is a maximal run of bytes that are not separators. Words are named by 64-bit hashes:
a multilinear hash over the bytes (a random odd factor for each place in the word), then mixed.
Work goes through chunks of about a megabyte of text, so memory does not grow with the batch;
a single longer text is a chunk by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: Bytes that separate words: white space of ASCII (space, tab to carriage return).
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Lower case of A-Z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def factors(n: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64)) * _GOLDEN) | np.uint64(1)


_FACTORS = factors(256)


@dataclass
class Texts:
    """Some consecutive texts: their bytes, and where each begins and ends (``bounds``, one more than texts)."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of ``Texts``: first byte, length and hash of each; ``bounds`` gives each text's slice of them."""

    starts: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def text_chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        bounds = offsets[at : to + 1]
        yield Texts(at, data[bounds[0] : bounds[-1]], bounds - bounds[0])
        at = to


def words_of(texts: Texts, separators: np.ndarray = WHITE_SPACE) -> Words:
    """Words of each text with A-Z in lower case."""
    global _FACTORS
    kept = ~separators[texts.data]
    size = len(kept)
    if size == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    begins = kept.copy()
    begins[1:] &= ~kept[:-1]
    edges = texts.bounds[:-1]
    edges = edges[edges < size]
    begins[edges] = kept[edges]
    ends = kept.copy()
    ends[:-1] &= ~kept[1:]
    lasts = edges[edges > 0] - 1
    ends[lasts] = kept[lasts]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) - starts + 1
    bounds = np.searchsorted(starts, texts.bounds)
    if len(starts) == 0:
        return Words(starts, lengths, np.zeros(0, np.uint64), bounds)
    if lengths.max() > len(_FACTORS):
        _FACTORS = factors(int(lengths.max()) * 2)
    at = np.flatnonzero(kept)
    begin_of = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(begin_of, lengths)
    values = (LOWER[texts.data[at]].astype(np.uint64) + np.uint64(1)) * _FACTORS[place]
    hashes = mix(np.add.reduceat(values, begin_of) + lengths.astype(np.uint64) * _GOLDEN)
    return Words(starts, lengths, hashes, bounds)


def word_list_hashes(words: list[str]) -> np.ndarray:
    """Hashes of separate words, equal to those that ``words_of`` gives."""
    column = pa.array(words, pa.string())
    parts = [words_of(t).hashes for t in text_chunks(column)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def joined(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros_like(parts[0])
    for k, part in enumerate(parts):
        out = mix(out * _M2 + part + np.uint64((k + 1) * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF))
    return out


def shingles_of(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in order, and each text's bounds in them.

    A text with fewer words than ``width`` has its whole sequence as one; one without words has none.
    """
    counts = np.diff(words.bounds)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(bounds[-1], np.uint64)
    first = np.repeat(words.bounds[:-1], n) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
    full = np.repeat(counts >= width, n)
    at = first[full]
    out[full] = joined([words.hashes[at + k] for k in range(width)]) if len(at) else np.zeros(0, np.uint64)
    for size in range(1, width):
        picked = np.flatnonzero(counts == size)
        if len(picked):
            start = words.bounds[picked]
            out[bounds[picked]] = joined([words.hashes[start + k] for k in range(size)]) ^ np.uint64(size)
    return out, bounds


def distinct_sets(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
