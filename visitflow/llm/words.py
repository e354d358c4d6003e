"""Words of whole text columns, vectorised over Arrow batches (inside tasks).

A word is a run of bytes other than the six ASCII white-space characters
(``[^\\x20\\x09-\\x0D]+``). UTF-8 keeps these six bytes out of every multi-byte
character, so words are found on bytes without decoding the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 21
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Words(NamedTuple):
    """Words of several texts: byte bounds in ``raw``, and the word range
    ``first[i]:first[i + 1]`` of text ``i``."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each text; NULL is ''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again in slices of about ``size`` bytes of text, whole rows each."""
    for batch in batches:
        _, at = text_buffer(batch.column(column))
        row = 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(at, at[row] + size, side="right")) - 1
            stop = min(max(stop, row + 1), batch.num_rows)
            yield batch.slice(row, stop - row)
            row = stop


BYTE = np.arange(256)
NOT_SPACE = (BYTE != 32) & ((BYTE < 9) | (BYTE > 13))
# Letters and digits of ASCII and every byte of other characters.
LETTERS = (BYTE >= 128) | ((BYTE >= 48) & (BYTE <= 57)) | ((BYTE >= 65) & (BYTE <= 90)) | ((BYTE >= 97) & (BYTE <= 122))
TO_LOWER = np.where((BYTE >= 65) & (BYTE <= 90), BYTE + 32, BYTE).astype(np.uint8)


def find_words(column: pa.Array, lower: bool = False, bytes_of_words: np.ndarray = NOT_SPACE) -> Words:
    """All words of every text, in order. ``lower`` maps A-Z to a-z first."""
    raw, at = text_buffer(column)
    if lower:
        raw = TO_LOWER[raw]
    inside = bytes_of_words[raw]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return Words(raw, none, none, np.zeros(len(at), np.int64))
    cut = np.zeros(len(raw) + 1, bool)
    cut[at] = True  # a text begins here, whatever byte stands before
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(raw, start, end, np.searchsorted(start, at))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser, so that every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


class WordHasher:
    """64-bit hash of each word: a polynomial over its bytes modulo 2**64,
    taken from prefix sums over the whole buffer. Powers are kept per task."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, words: Words) -> np.ndarray:
        n = len(words.raw) + 1
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            self.up, self.down = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
        sums = np.zeros(n, np.uint64)
        np.cumsum((words.raw.astype(np.uint64) + np.uint64(1)) * self.up[:n - 1], out=sums[1:])
        return mix((sums[words.end] - sums[words.start]) * self.down[words.start])


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive words from each word on (the last size - 1
    positions have none); sequences that cross texts are the caller's to skip."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out *= np.uint64(BASE)
        out += hashes[j:j + n]
    return mix(out)


def row_of_word(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (length[0] of them), then the next range."""
    ends = np.cumsum(length)
    out = np.arange(ends[-1] if len(ends) else 0)
    return out + np.repeat(start - (ends - length), length)
