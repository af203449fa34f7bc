"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary file.

Two tiers. A pre-token that is in the vocabulary is one id: a minimal perfect hash
(hash and displace, a slot for each entry and none to spare) finds it with two
gathers, for all pre-tokens of a slice at once. The others are merged from bytes: a
heap of candidate merges over a doubly linked list. Each different miss of a slice is
merged once, and a worker keeps the latest ``KEPT`` of them.

Pre-tokens follow ``PATTERN``: they are cut by numpy from the classes of the
characters. Null texts are empty: no ids, empty bytes. Columns of the input that are
called like those added are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.words import column, hash_spans, kinds, mix, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
KEPT = 150_000
SLICE_BYTES = 1 << 18
#: What the pattern's \s stands for.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
OTHER, LETTER, NUMBER, SPACE = range(4)


@lru_cache
def character_classes() -> np.ndarray:
    """The class of every code point, by the properties that the pattern names."""
    classes = np.full(0x110000, OTHER, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    every = "".join(map(chr, points))
    points = np.array(points)
    for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for found in regex.finditer(name, every):
            classes[points[found.start() : found.end()]] = kind
    classes[WHITE_SPACE] = SPACE
    return classes


def pretokens(texts: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts; starts and ends of their pre-tokens; each text's first pre-token."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    low, high = int(offsets[0]), int(offsets[-1])
    none = np.empty(0, np.int64)
    if low == high:
        return np.empty(0, np.uint8), none, none, np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8, high - low, low)
    offsets = offsets - low
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[chars].astype(np.int32)
    wide = np.flatnonzero(points >= 0x80)
    if len(wide):
        lead, at = points[wide], chars[wide]
        last = len(data) - 1
        b1, b2, b3 = (data[np.minimum(at + k, last)].astype(np.int32) & 0x3F for k in (1, 2, 3))
        two, three = (lead & 0x1F) << 6 | b1, (lead & 0x0F) << 12 | b1 << 6 | b2
        four = (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3
        points[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    kind = classes[points]
    opens = np.zeros(len(chars) + 1, bool)  # the first characters of texts
    opens[np.searchsorted(chars, offsets)] = True
    opens = opens[:-1]
    run = opens.copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    follows = np.zeros(len(chars), bool)  # white space right before something else
    follows[:-1] = space[:-1] & ~space[1:] & ~opens[1:]
    prefixed = np.zeros(len(chars), bool)
    prefixed[1:] = (points[:-1] == 0x20) & follows[:-1]
    starts = run & (space | ~prefixed) | follows
    mark = np.flatnonzero((points == 0x27) & run & ~prefixed)
    mark = mark[mark + 1 < len(chars)]
    mark = mark[(kind[mark + 1] == LETTER) & ~opens[mark + 1]]
    if len(mark):
        one = points[mark + 1]
        next_ = np.minimum(mark + 2, len(chars) - 1)
        more = (mark + 2 < len(chars)) & ~opens[next_] & (kind[next_] == LETTER)
        two = np.where(more, points[next_], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(mark), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        for which, size in ((short, 1), (long, 2)):
            head = mark[which]
            starts[head + 1] = False
            after = head + 1 + size
            after = after[after < len(chars)]
            starts[after[(kind[after] == LETTER) & ~opens[after]]] = True
    begins = chars[starts]
    return data, begins, np.append(begins[1:], len(data)), np.searchsorted(begins, offsets)


class Vocabulary:
    """Entries by id, a minimal perfect hash of them, and the classes of characters."""

    def __init__(self, lines: bytes):
        entries = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines.splitlines())}
        self.ranks = {entry: rank for rank, entry in entries.items()}
        self.bytes = np.frombuffer(b"".join(entries[k] for k in sorted(entries)), np.uint8)
        self.ids = np.array(sorted(entries), np.uint32)
        self.lengths = np.array([len(entries[k]) for k in sorted(entries)])
        self.ends = np.cumsum(self.lengths)
        keys = hash_spans(self.bytes, self.ends - self.lengths, self.ends)
        self.buckets = max(1, len(keys) // 2)
        self._displace(keys)
        self.classes = character_classes()

    def _displace(self, keys: np.ndarray) -> None:
        """Finds a displacement for each bucket, the fullest first, that lands on free slots."""
        size = len(keys)
        bucket = (keys % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.displacement = np.zeros(self.buckets, np.int64)
        slot_of = np.full(size, -1)  # slot -> entry
        for b in np.argsort(-np.diff(cuts), kind="stable"):
            own = order[cuts[b] : cuts[b + 1]]
            if len(own) < 2:
                break
            tries = 0
            while True:
                some = np.repeat(np.arange(tries + 1, tries + 17), len(own))
                slots = self._slots(np.tile(keys[own], 16), some).reshape(16, -1)
                ordered = np.sort(slots, axis=1)
                good = (slot_of[slots] < 0).all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    break
                tries += 16
            first = int(np.argmax(good))
            self.displacement[b] = tries + 1 + first
            slot_of[slots[first]] = own
        alone = np.flatnonzero(np.diff(cuts) == 1)
        free = np.flatnonzero(slot_of < 0)
        self.displacement[alone] = -1 - free  # a bucket of one entry names its slot
        slot_of[free] = order[cuts[alone]]
        self.slot_key, self.slot_entry = keys[slot_of], slot_of

    def _slots(self, keys: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        moved = mix(keys + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 51)
        return np.where(displacement < 0, -1 - displacement, (moved % np.uint64(len(self.ids))).astype(np.int64))

    def find(self, keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The entry of each pre-token, by hash and length, or -1."""
        slots = self._slots(keys, self.displacement[(keys % np.uint64(self.buckets)).astype(np.int64)])
        entry = self.slot_entry[slots]
        return np.where((self.slot_key[slots] == keys) & (self.lengths[entry] == lengths), entry, -1)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: merges of least rank first, the leftmost of equals."""
        ranks = self.ranks
        size = len(piece)
        stop = list(range(1, size + 1))  # where the part that starts here ends; 0 if merged away
        before = list(range(-1, size))
        heap = []
        for k in range(size - 1):
            rank = ranks.get(piece[k : k + 2])
            if rank is not None:
                heap.append((rank, k, k + 2))
        heapq.heapify(heap)
        while heap:
            rank, left, end = heapq.heappop(heap)
            middle = stop[left]
            if not middle or middle >= size or stop[middle] != end:
                continue
            stop[left], stop[middle] = end, 0
            if end < size:
                before[end] = left
                found = ranks.get(piece[left : stop[end]])
                if found is not None:
                    heapq.heappush(heap, (found, left, stop[end]))
            prior = before[left]
            if prior >= 0:
                found = ranks.get(piece[prior:end])
                if found is not None:
                    heapq.heappush(heap, (found, prior, end))
        out, at = [], 0
        while at < size:
            out.append(ranks[piece[at : stop[at]]])
            at = stop[at]
        return out


@lru_cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary(lines.read())


_MERGED: dict[int, bytes] = {}


def encode_slice(texts: pa.Array, words: Vocabulary, merged: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where each text's ids end."""
    data, starts, ends, first = pretokens(texts, words.classes)
    if not len(starts):
        return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
    keys = hash_spans(data, starts, ends)
    entry = words.find(keys, ends - starts)
    hit = entry >= 0
    counts = np.ones(len(starts), np.int64)
    missed = np.flatnonzero(~hit)
    spot, inverse = kinds(keys[missed])
    parts = []
    for at in missed[spot]:
        key = int(keys[at])
        ids = merged.get(key)
        if ids is None:
            if len(merged) >= KEPT:
                merged.clear()
            ids = merged[key] = np.array(words.merge(bytes(data[starts[at] : ends[at]])), np.uint32).tobytes()
        parts.append(ids)
    if parts:
        sizes = np.array([len(x) // 4 for x in parts])
        flat, begin = np.frombuffer(b"".join(parts), np.uint32), np.cumsum(sizes) - sizes
        counts[missed] = sizes[inverse]
    stop = np.cumsum(counts)
    out = np.empty(int(stop[-1]), np.uint32)
    out[(stop - counts)[hit]] = words.ids[entry[hit]]
    if parts:
        own = counts[missed]
        step = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        out[np.repeat((stop - counts)[missed], own) + step] = flat[np.repeat(begin[inverse], own) + step]
    return out, np.concatenate([[0], stop])[first[1:]]


def decode_ids(ids: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ids, and where the bytes of each end."""
    entry = np.searchsorted(words.ids, ids)
    lengths = words.lengths[entry]
    stop = np.cumsum(lengths)
    total = int(stop[-1]) if len(stop) else 0
    shift = (words.ends[entry] - lengths) - (stop - lengths)
    return words.bytes[np.arange(total) + np.repeat(shift, lengths)], stop


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of consecutive pieces of an array."""
    width = values.dtype.itemsize
    offsets = np.concatenate([[0], ends]).astype(np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


def _encoded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    words = shared.value
    for batch in batches:
        texts = column(batch, "text")
        for low, high in slices(texts, SLICE_BYTES):
            ids, ends = encode_slice(texts[low:high], words, _MERGED)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc")[low:high], _binary(ids.astype("<u4"), ends),
                 pa.array(np.diff(ends, prepend=0))],
                names=["doc", "ids", "n_tokens"],
            )


def _round_trip(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """As _encoded, and what the ids decode to, in one pass over the texts."""
    words = shared.value
    for batch in _encoded(batches, shared):
        values, ends = _ids(column(batch, "ids"))
        found, stop = decode_ids(values, words)
        yield batch.append_column("decoded", _binary(found, np.concatenate([[0], stop])[ends]))


def _ids(column_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and where those of each row end."""
    part = pc.fill_null(column_.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(part.buffers()[1], np.int64, len(part) + 1, part.offset * 8)
    count = int(offsets[-1] - offsets[0]) // 4
    values = np.frombuffer(part.buffers()[2], "<u4", count, int(offsets[0])) if count else np.empty(0, "<u4")
    return values, (offsets[1:] - offsets[0]) // 4


def _decoded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    words = shared.value
    for batch in batches:
        ids = column(batch, "ids")
        for low, high in slices(ids):
            values, ends = _ids(ids[low:high])
            found, stop = decode_ids(values, words)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc")[low:high], _binary(found, np.concatenate([[0], stop])[ends])],
                names=["doc", "decoded"],
            )


def _shared(frame: DataFrame, path: str | None):
    """The vocabulary and its hash, built once and broadcast; bounded by the file."""
    return frame.sparkSession.sparkContext.broadcast(vocabulary(path or public_tokenizers.path(VOCABULARY)))


def _schema(whole: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(
        [T.StructField("doc", whole.schema["doc"].dataType), *(T.StructField(*field) for field in fields)]
    )


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The documents with ``ids`` (little-endian unsigned 32-bit) and ``n_tokens``."""
    shared = _shared(docs, path)
    docs = docs.drop("ids", "n_tokens")
    whole = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"), "text")
    schema = _schema(whole, ("ids", T.BinaryType()), ("n_tokens", T.LongType()))
    return whole.mapInArrow(lambda it: _encoded(it, shared), schema).select("doc.*", "ids", "n_tokens")


def decode(frame: DataFrame, path: str | None = None) -> DataFrame:
    """The rows with ``decoded``, the bytes of their ``ids``."""
    shared = _shared(frame, path)
    whole = frame.drop("decoded").select(F.struct("*").alias("doc"), "ids")
    schema = _schema(whole, ("decoded", T.BinaryType()))
    return whole.mapInArrow(lambda it: _decoded(it, shared), schema).select("doc.*", "decoded")


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``encode``, then ``decode``, in one pass: ids, n_tokens and decoded."""
    shared = _shared(docs, path)
    docs = docs.drop("ids", "n_tokens", "decoded")
    whole = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"), "text")
    schema = _schema(whole, ("ids", T.BinaryType()), ("n_tokens", T.LongType()), ("decoded", T.BinaryType()))
    rows = whole.mapInArrow(lambda it: _round_trip(it, shared), schema)
    return rows.select("doc.*", "ids", "n_tokens", "decoded")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to."""
    return encode_and_decode(docs.select("doc_id", "text")).select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
