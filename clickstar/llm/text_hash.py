"""Word and shingle hashes of many texts at once, as numpy arrays over their joined bytes.

A word's hash is a polynomial over its bytes modulo 2^64, read off one running sum for all
words, and then mixed; any leading part of a word has its hash read off the same sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

MULTIPLIER = 0x9E3779B97F4A7C15 | 5
_RANDOM = np.random.default_rng(20240229)
_VALUES = _RANDOM.integers(1, 2 ** 64 - 1, 256, dtype=np.uint64, endpoint=True)
_PLACES = _RANDOM.integers(1, 2 ** 64 - 1, 64, dtype=np.uint64, endpoint=True) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
# Bytes of text hashed at once; the arrays over them take about 80 times as much.
CHUNK = 1 << 18


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's and its inverse's powers below ``n``."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((MULTIPLIER, pow(MULTIPLIER, -1, 2 ** 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of some texts: ``hashes``, and ``offsets`` of each text's first word."""

    def __init__(self, texts: Sequence[bytes], separators: np.ndarray = WHITE) -> None:
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        gap = separators[joined]
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        self.starts, self.ends = edge[::2], edge[1::2]
        if len(self.ends) < len(self.starts):
            self.ends = np.append(self.ends, len(joined))
        up, self._down = powers(len(joined))
        self._sums = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(_VALUES[_LOWER[joined]] * up, out=self._sums[1:])
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        text_starts = np.concatenate(([0], np.cumsum(lengths)))
        self.offsets = np.searchsorted(self.starts, text_starts)
        self.hashes = self.leading(None)

    def leading(self, n_bytes: int | None) -> np.ndarray:
        """Hashes of the words' first ``n_bytes``; shorter words are taken whole."""
        ends = self.ends if n_bytes is None else np.minimum(self.ends, self.starts + n_bytes)
        raw = (self._sums[ends] - self._sums[self.starts]) * self._down[self.starts]
        return mix(raw + (ends - self.starts).astype(np.uint64) * _PLACES[63])


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few texts, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_chunks(texts: Sequence[str | None], size: int = CHUNK) -> Iterator[list[bytes]]:
    """Runs of texts of about ``size`` bytes; null is empty."""
    run, held = [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if run and held + len(data) > size:
            yield run
            run, held = [], 0
        run.append(data)
        held += len(data)
    if run:
        yield run


def shingle_sets(texts: Sequence[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; below ``width`` words, of all its words."""
    for run in in_chunks(texts):
        words = Words(run)
        h, offsets = words.hashes, words.offsets
        n = max(0, len(h) - width + 1)
        rolled = np.zeros(n, np.uint64)
        for j in range(width):
            rolled += h[j:j + n] * _PLACES[j]
        rolled = mix(rolled)
        for a, b in zip(offsets[:-1], offsets[1:]):
            if b - a >= width:
                yield np.unique(rolled[a:b - width + 1])
            elif b > a:
                part = (h[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64)
                yield mix(part + np.uint64(b - a) * _PLACES[62:63])
            else:
                yield np.zeros(0, np.uint64)


def set_class(shingles: np.ndarray) -> int:
    """One signed 64-bit hash of a set."""
    spread = mix(shingles)
    parts = np.array([spread.sum(dtype=np.uint64), np.bitwise_xor.reduce(spread), len(shingles)],
                     np.uint64)
    return int(mix((parts * _PLACES[59:62]).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])
