"""Words and rolling hashes of many texts at once, on the bytes of an Arrow column.

Work goes by slices of a few MB of text, so memory does not depend on the
size of a batch; only one text longer than that makes a larger slice.
A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
# The bytes that separate words, 20 and 09 to 0D.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_BYTE_ROOT = 0xD1342543DE82EF95
_WORD_ROOT = 0xAF251AF3B0F025B5
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ROOT)


def _powers(root: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``root`` and of its inverse, modulo 2**64."""
    have = _POWERS.get(root)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for base in (root, pow(root, -1, 1 << 64)):
            values = np.full(size, base, dtype=np.uint64)
            values[0] = 1
            both.append(np.cumprod(values))
        have = _POWERS[root] = (both[0], both[1])
    return have


def span_hashes(
    values: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice, root: int, lengths: np.ndarray | None = None
) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each span, independent of its place.

    Spans of one length can be given by slices and that length.
    """
    power, inverse = _powers(root, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    if lengths is None:
        lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + lengths * _ROOT)


@dataclass
class Texts:
    """Some rows: ``rows`` are their numbers in the batch, ``offsets`` their bytes in ``data``."""

    rows: range
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode()


@dataclass
class Words:
    """Byte spans of all words; words ``offsets[i]:offsets[i + 1]`` belong to row ``i``."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a string column, a few MB at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + 60_000, len(column))
        yield Texts(range(first, last), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def split_words(texts: Texts, separators: np.ndarray = SEPARATORS) -> Words:
    inside = ~separators[texts.data]
    borders = texts.offsets[texts.offsets < len(inside)]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[borders] = inside[borders]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    before = texts.offsets[texts.offsets > 0] - 1
    end[before] = inside[before]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


def lower_ascii(texts: Texts) -> Texts:
    data = texts.data
    capital = (data >= 65) & (data <= 90)
    return Texts(texts.rows, np.where(capital, data + np.uint8(32), data), texts.offsets)


def word_hashes(texts: Texts, words: Words) -> np.ndarray:
    return span_hashes(_BYTE_VALUES[texts.data], words.starts, words.ends, _BYTE_ROOT)


def window_hashes(hashes: np.ndarray, words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words of one row, and the numbers of their first words."""
    counts = words.counts
    left = np.repeat(words.offsets[1:], counts) - np.arange(len(hashes))
    first = np.flatnonzero(left >= width)
    return span_hashes(hashes, first, first + width, _WORD_ROOT), first


def whole_hashes(hashes: np.ndarray, words: Words) -> np.ndarray:
    """One hash of the whole word sequence of each row."""
    return span_hashes(hashes, words.offsets[:-1], words.offsets[1:], _WORD_ROOT)


def pack(values: np.ndarray) -> bytes:
    """Bytes of an integer array, all lowest bytes first, which compresses well."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpack(raw: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
