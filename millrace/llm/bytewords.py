"""Words of a batch of texts as flat numpy arrays.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` over UTF-8 bytes; those
separators are ASCII, so byte-level and code-point-level words agree.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def release() -> None:
    """Gives memory that this worker has freed back to the system, as workers stay while other tasks run beside them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
LOWER_BYTES = bytes(_LOWER)

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 20)

        def run(base: int) -> np.ndarray:
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        _powers, _inverses = run(_BASE), run(pow(_BASE, -1, 1 << 64))
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words:
    """Word boundaries of texts: ``starts``/``ends`` index ``data``; words of text i are ``first[i]:first[i + 1]``."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.data = np.frombuffer(b" ".join([*texts, b""]) or b" ", dtype=np.uint8)
        if lower:
            self.data = _LOWER[self.data]
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        inside = np.concatenate([np.zeros(1, np.int8), (~_SPACE[self.data]).view(np.int8), np.zeros(1, np.int8)])
        steps = np.diff(inside)
        self.starts = np.flatnonzero(steps == 1)
        self.ends = np.flatnonzero(steps == -1)
        self.first = np.searchsorted(self.starts, self.offsets)
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
        powers, inverses = _tables(len(self.data) + 1)
        if self._sums is None:
            sums = np.empty(len(self.data) + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[: len(self.data)], out=sums[1:])
            self._sums = sums
        return mix((self._sums[ends] - self._sums[starts]) * inverses[starts])

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, and where each text's begin.

    A text of one to k - 1 words has its whole sequence as its only shingle; without words it has none.
    """
    h, first = words.hashes(), words.first
    n_words = np.diff(first)
    n = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
    at = np.arange(begins[-1]) - np.repeat(begins[:-1], n) + np.repeat(first[:-1], n)
    size = np.repeat(np.minimum(n_words, k), n)
    out = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    for j in range(k):
        weight = np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64))
        out += np.where(j < size, padded[at + j] * weight, np.uint64(0))
    return mix(out + size.astype(np.uint64)), begins


def sub_batches(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with about max_bytes of text, as (slice, UTF-8 texts); null texts are empty."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    start, size, held = 0, 0, []
    for i in range(len(texts)):
        held.append(texts[i].as_py() or b"")
        size += len(held[-1])
        if size >= max_bytes or i + 1 == len(texts):
            yield batch.slice(start, len(held)), held
            start, size, held = i + 1, 0, []
