"""Batch text kernels: words, lines and 64-bit hashes of spans, in NumPy over many documents at once.

Texts are UTF-8 bytes. A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``, which is also the code-point
definition, since all bytes of other characters lie above. Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
LONG_SPAN = 256
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the process and grown by doubling."""
    if not _powers or len(_powers[0]) < size:
        size = max(1 << 21, 1 << (size - 1).bit_length())
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


class Batch:
    """Several texts laid out in one byte array, each closed by a line feed that belongs to none of them."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.size = len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, self.size)
        self.data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.data = LOWER[self.data]
        self.bounds = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])
        self.lengths = lengths
        space = SPACE[self.data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first_word = np.searchsorted(self.starts, self.bounds)
        self.n_words = np.diff(self.first_word)
        self.word_doc = np.repeat(np.arange(self.size), self.n_words)
        self.space = space
        self._sums: np.ndarray | None = None

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each span, equal for equal bytes wherever they stand."""
        powers, inverse = _power_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * powers[: len(self.data)], out=self._sums[1:])
        out = mix((self._sums[ends] - self._sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        # A polynomial modulo 2**64 is no hash for long spans: Thue-Morse texts of 2**q bytes collide once q(q+1)/2
        # reaches 64. Spans of LONG_SPAN bytes or more take a cryptographic digest instead; shorter ones cannot be such.
        for k in np.flatnonzero(np.asarray(ends - starts) >= LONG_SPAN):
            digest = hashlib.blake2b(self.data[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
            out[k] = U(int.from_bytes(digest, "little"))
        return out

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[self.bounds[1:] - 1] - sums[self.bounds[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and documents of the lines that \\n splits the texts into."""
        ends = np.flatnonzero(self.data[1:] == 10) + 1
        starts = np.concatenate([[1], ends[:-1] + 1])
        return starts, ends, np.searchsorted(self.bounds, starts, "right") - 1


def ngram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes; the caller drops windows that cross documents."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out = (out + words[k : k + size]) * U(_BASE + 2 * k)
        out ^= out >> U(29)
    return mix(out)


def inside(owner: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n consecutive words lie in one document."""
    return owner[: len(owner) - n + 1] == owner[n - 1 :] if len(owner) >= n else np.zeros(0, bool)


def encoded(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    values = column.cast(pa.binary()).to_pylist()
    return [v or b"" for v in values]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``limit`` text bytes: the working memory of a task doesn't depend on Arrow's batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum([n or 0 for n in pc.binary_length(batch.column("text")).to_pylist()])
        cuts = [0, *(np.flatnonzero(np.diff(sizes // limit)) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield batch.slice(lo, hi - lo)
