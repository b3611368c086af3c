"""Word shingles of a whole Arrow column of texts, as 64-bit hashes, without a Python loop per word."""

import numpy as np
import pyarrow as pa

_U = np.uint64
_RNG = np.random.default_rng(20240229)
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so that powers have inverses modulo 2**64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes handled at a time; a longer text is handled alone and whole.
SLICE = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of a public splitmix generator)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    if not _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, SLICE + 1)
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            all_ = np.full(size, base, dtype=np.uint64)
            all_[0] = 1
            _POWERS[name] = np.multiply.accumulate(all_)
    return _POWERS["up"], _POWERS["down"]


class Rolling:
    """Hashes of any stretches of one byte array, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data))
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        values = _VALUE[data]
        values *= up[: len(data)]
        np.cumsum(values, out=self._sums[1:])
        if len(_POWERS["up"]) > 2 * SLICE:  # one huge text must not pin its tables
            _POWERS.clear()

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """The hash of every stretch of ``width`` bytes."""
        n = max(0, len(self._sums) - width)
        h = (self._sums[width:width + n] - self._sums[:n]) * self._down[:n]
        h ^= h >> _U(31)
        h *= _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(29)
        return h


def text_slices(texts: pa.Array):
    """``(first row, bytes, offsets)`` of runs of rows of about SLICE bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1)
        yield row, data[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row]
        row = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, words before each row)`` of words between white space; none crosses a row."""
    solid = ~_BLANK[data]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    starts[edges] = solid[edges]
    edges = edges[edges > 0]
    ends[edges - 1] = solid[edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int, *, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row as ``(hashes, bounds)``: row i has hashes[bounds[i]:bounds[i + 1]],
    sorted. With ``short``, a row of fewer words has one shingle, its whole sequence; else none."""
    lowered = _LOWER[data]
    starts, ends, first = words(lowered, offsets)
    hashed = Rolling(lowered).of(starts, ends)
    counts = np.diff(first)
    n = max(0, len(hashed) - width + 1)
    joined = hashed[:n].copy()
    for k in range(1, width):
        joined = (joined ^ (joined >> _U(29))) * _BASE + hashed[k:k + n]
    joined = mix(joined)
    row = np.repeat(np.arange(len(counts)), counts)
    inside = row[:n] == row[width - 1:width - 1 + n]
    joined, row = joined[inside], row[:n][inside]
    if short:
        few = np.flatnonzero((counts > 0) & (counts < width))
        extra = hashed[first[:-1][few]].copy()
        for k in range(1, width - 1):
            more = counts[few] > k
            extra[more] = (extra[more] ^ (extra[more] >> _U(29))) * _BASE + hashed[first[:-1][few][more] + k]
        extra = mix(extra ^ _U(0x5851F42D4C957F2D) * counts[few].astype(np.uint64))
        joined, row = np.concatenate([joined, extra]), np.concatenate([row, few])
    order = np.argsort(joined)
    order = order[np.argsort(row[order].astype(np.uint16 if len(counts) < 65536 else np.int64), kind="stable")]
    joined, row = joined[order], row[order]
    new = np.ones(len(joined), dtype=bool)
    new[1:] = (joined[1:] != joined[:-1]) | (row[1:] != row[:-1])
    joined, row = joined[new], row[new]
    return joined, np.searchsorted(row, np.arange(len(counts) + 1))
