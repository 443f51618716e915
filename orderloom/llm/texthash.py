"""Array-at-a-time word and window hashes for Arrow text columns.

Words are maximal runs of characters other than space and U+0009-U+000D. A word's hash is a polynomial over its
bytes modulo 2**64 read off one running sum, so no Python code runs per word; windows of words are hashed the same
way from the word hashes. Texts are handled in chunks of a few megabytes, a longer text forms a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000
_U = np.uint64
_BYTE_BASE, _WORD_BASES = 0x9E3779B97F4A7C15, (0xD1342543DE82EF95, 0xA0761D6478BD642F)
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _spans(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(pow(base, -1, 2**64), len(values) + 1)[starts])


@dataclass
class Words:
    """Words of some rows: hashes, byte spans, and the words of row i at offsets[i]:offsets[i + 1]."""

    rows: slice
    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def windows(self, size: int, which: int = 0) -> np.ndarray:
        """Hash of the `size` words from each position; meaningless where a row ends before."""
        n = len(self.hashes)
        at = np.arange(n)
        return _spans(self.hashes, _WORD_BASES[which], at, np.minimum(at + size, n))

    def room(self) -> np.ndarray:
        """Words from each position to the end of its row."""
        return np.repeat(self.offsets[1:], np.diff(self.offsets)) - np.arange(len(self.hashes))

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def word_chunks(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of all rows, in chunks of rows. `lower` turns A-Z to lower case; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    everything = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        data = everything[offsets[row] : offsets[stop]]
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        edges = offsets[row : stop + 1] - offsets[row]
        word = ~_SPACE[data]
        first = word.copy()
        if len(data):
            inner = edges[:-1][edges[:-1] < len(data)]
            before = np.empty(len(data), bool)
            before[0], before[1:] = False, word[:-1]
            before[inner] = False
            first &= ~before
            after = np.empty(len(data), bool)
            after[-1], after[:-1] = False, word[1:]
            after[inner[inner > 0] - 1] = False
            last = word & ~after
        else:
            last = word
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes = _spans(_BYTE_VALUE[data], _BYTE_BASE, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        yield Words(slice(row, stop), data, hashes, starts, ends, np.searchsorted(starts, edges))
        row = stop


def packed(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of each 64-bit value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel().astype(np.uint64, copy=False)


#: Bits of a hash that `packed_sorted` keeps; the bucket that a hash falls into adds its own.
SET_BITS = 36


def packed_sorted(values: np.ndarray) -> bytes:
    """Sorted values below 2**SET_BITS: how many share their upper bits, then the lower bits of each.

    Large sets take a little over three bytes a value, small ones a little over four.
    """
    low_bytes = 3 if len(values) >= 2048 else 4
    low = 8 * low_bytes
    heads = np.bincount((values >> _U(low)).astype(np.int64), minlength=1 << (SET_BITS - low)).astype("<u4")
    return bytes([low_bytes]) + heads.tobytes() + packed(values, low_bytes)


def unpacked_sorted(raw: bytes) -> np.ndarray:
    low_bytes = raw[0]
    n = 1 << (SET_BITS - 8 * low_bytes)
    heads = np.frombuffer(raw, "<u4", n, 1)
    return unpacked(raw[1 + 4 * n :], low_bytes) + (np.repeat(np.arange(n, dtype=np.uint64), heads) << _U(8 * low_bytes))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper 32 bits, which `packed_sorted` does not keep."""
    return ((hashes >> _U(32)) * _U(buckets)) >> _U(32)


def cuts(sorted_buckets: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted bucket numbers, and the end."""
    return np.searchsorted(sorted_buckets, np.arange(buckets + 1, dtype=sorted_buckets.dtype))


def joined(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    """All values of a column of raw arrays."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)
