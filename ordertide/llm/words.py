"""Words of whole Arrow text columns as numpy arrays: boundaries, exact ids, hashes.

Texts stay bytes: a column's UTF-8 buffer is cut at separator bytes, so no Python
string is made per word. Every separator set used here is ASCII, and bytes from 0x80
up always belong to a word, so cutting bytes equals cutting code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_RANDOM = np.random.default_rng(20240611)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """Words of several texts, in order; words of text ``d`` are ``first[d]:first[d + 1]``."""

    data: np.ndarray  # bytes of all words, without separators
    off: np.ndarray  # word i is data[off[i]:off[i + 1]]
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.off) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def arrow(self) -> pa.Array:
        """The words as a binary Arrow array over the same bytes."""
        return binary_array(self.data, self.off)

    def encode(self) -> tuple[np.ndarray, pa.Array]:
        """Exact word ids and the distinct words they index."""
        d = self.arrow().dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False), d.dictionary


def binary_array(data: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)])


def buffer_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):  # several chunks beyond 2 GB, or none at all
        texts = pa.concat_arrays([c.cast(pa.large_binary()) for c in texts.chunks]) if texts.num_chunks else pa.array([], pa.large_binary())
    texts = texts.cast(pa.large_string()).cast(pa.large_binary()) if pa.types.is_string(texts.type) else texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def _mapped(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[raw]`` for a byte table; bytes.translate makes no index array."""
    return np.frombuffer(raw.tobytes().translate(table.astype(np.uint8).tobytes()), np.uint8)


def cut(raw: np.ndarray, off: np.ndarray, separators: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts ``raw[off[d]:off[d + 1]]``."""
    if lower:
        raw = _mapped(raw, LOWER)
    inside = _mapped(raw, ~separators).view(bool)
    edges = off[(off > 0) & (off < len(raw))]
    # a word begins (ends) where the byte before (after) is a separator or another text's
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    word_off = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends + 1 - begins, out=word_off[1:])
    return Words(raw[inside], word_off, np.searchsorted(begins, off))


def mix(h: np.ndarray) -> np.ndarray:
    """Finisher of 64-bit hashes (splitmix)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def hashes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64-bit hash of each (non-empty) byte string ``data[off[i]:off[i + 1]]``."""
    if len(off) < 2:
        return np.zeros(0, np.uint64)
    lens = np.diff(off)
    powers = np.full(int(lens.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    place = np.arange(len(data)) - np.repeat(off[:-1], lens)
    return mix(np.add.reduceat(_BYTE[data] * powers[place], off[:-1]) + lens.astype(np.uint64) * _BASE)


def dictionary_hashes(words: pa.Array) -> np.ndarray:
    return hashes(*buffer_of(words))


def windows(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of k consecutive hashes; runs across texts are the caller's to leave out."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for j in range(k):
        out *= _BASE
        out += h[j : j + n]
    return mix(out)


def within(first: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which of the windows of k words at each position lie in one text."""
    n = max(0, total - k + 1)
    ok = np.ones(n, bool)
    ends = first[1:-1]
    for j in range(1, k):  # a window starting up to k - 1 words before a boundary crosses it
        at = ends - j
        ok[at[(at >= 0) & (at < n)]] = False
    return ok


def slices(batch: pa.RecordBatch | pa.Table, texts: pa.Array | pa.ChunkedArray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each, one row at least: whole texts, bounded work."""
    if batch.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) if isinstance(texts, pa.Array) else pc.fill_null(pc.binary_length(texts), 0).to_numpy(), np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield at, to
        at = to
