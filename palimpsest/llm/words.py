"""Words of Arrow text columns as numpy offsets and hashes, many documents at a time.

A word is ``[^\\x20\\x09-\\x0D]+``. Null texts have no words. Memory follows the
slice (a few megabytes of text, or one document), whatever the batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CHUNK = 1 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1F83D9ABFB41BD6B) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd number, and of its inverse, modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.size = base, 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            size = max(n, 1 << 16)
            tables = []
            for base in (self.base, pow(self.base, -1, 2**64)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                tables.append(np.cumprod(table, dtype=np.uint64))
            if size > 2 * _CHUNK:  # one very long word or document: not kept
                return tables[0], tables[1]
            self.up, self.down, self.size = *tables, size
        return self.up, self.down


_BYTES = {lane: _Powers(base) for lane, base in enumerate((0x5851F42D4C957F2D, 0x369DEA0F31A53F85))}
_ITEMS = {lane: _Powers(base) for lane, base in enumerate((0xD1342543DE82EF95, 0xAF251AF3B0F025B5))}


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes; starts and ends ascend."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, "right")))
        up, down = _BYTES[lane].upto(int(ends[to - 1]) - base + 1)
        sums = np.zeros(int(ends[to - 1]) - base + 1, np.uint64)
        part = data[base : int(ends[to - 1])].astype(np.uint64)
        part += np.uint64(1)
        part *= up[: len(part)]
        np.cumsum(part, out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(out, lane + 1)


def hash_runs(items: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` items; empty if there are too few."""
    count = len(items) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(count, np.uint64)
    for at in range(0, count, _CHUNK):
        to = min(count, at + _CHUNK)
        up, down = _ITEMS[lane].upto(to - at + length)
        sums = np.zeros(to - at + length, np.uint64)
        np.cumsum(items[at : to + length - 1] * up[: to - at + length - 1], out=sums[1:])
        out[at:to] = (sums[length:] - sums[:-length]) * down[: to - at]
    return mix(out, 64 + lane)


@dataclass
class Words:
    """The words of some documents, in order."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # of each word
    ends: np.ndarray
    first: np.ndarray  # of each document its first word; one more at the end

    def hashes(self, lane: int = 0) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends, lane)

    def run_starts(self, length: int) -> np.ndarray:
        """Words that begin a run of ``length`` words of one document."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        return np.flatnonzero(np.arange(len(self.starts)) + length <= last)


def words_of(texts: pa.Array) -> Words:
    """The words of a (slice of a) string column."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    low, high = int(offsets[0]), int(offsets[-1])
    if texts.buffers()[2] is None or high == low:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint8), none, none, np.zeros(len(texts) + 1, np.int64))
    data = np.frombuffer(texts.buffers()[2], np.uint8, high - low, low)
    offsets = offsets - low
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    edges = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    begins[edges] = word[edges]
    stops[edges - 1] = word[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column with about ``limit`` bytes each, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield at, to
        at = to
    _release()


def _release() -> None:
    """Gives memory of freed arrays back: a worker outlives its tasks."""
    if _TRIM is not None:
        _TRIM(0)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def grams(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...], buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Byte n-grams of words: the word and the bucket of each.

    A word's first and last gram of each size counts once more as its affix, and
    the whole word is a gram as well.
    """
    lengths = ends - starts
    owners, found = [np.arange(len(starts))], [hash_spans(data, starts, ends)]
    for n in sizes:
        counts = np.maximum(lengths - n + 1, 0)
        owner = np.repeat(np.arange(len(starts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[owner] + place
        code = np.full(len(at), n, np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + data[at + k]
        for part, salt in ((slice(None), 0), (place == 0, 1), (place == counts[owner] - 1, 2)):
            owners.append(owner[part])
            found.append(mix(code[part], 31 + salt))
    return np.concatenate(owners), (np.concatenate(found) % np.uint64(buckets)).astype(np.int64)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def has_letters(words: Words) -> np.ndarray:
    """Words with a byte of a letter: ASCII letters or anything beyond ASCII."""
    letter = (words.data >= 0x80) | ((words.data | 0x20) - np.uint8(0x61) < 26)
    sums = np.concatenate([[0], np.cumsum(letter)])
    return sums[words.ends] > sums[words.starts]


def kinds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct hash, ascending, and which of them each one is."""
    _, spot, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(spot)
    rank = np.empty(len(spot), np.int64)
    rank[order] = np.arange(len(spot))
    return spot[order], rank[inverse]
