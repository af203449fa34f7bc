"""Token ids as files of canonical, length-limited Huffman codes.

Format: a table of independent blocks, in the order of doc_id. A block holds up to
``BLOCK_TOKENS`` ids of whole documents (one document, if it has more): the documents'
ids and lengths, the code words as one bit string, and for every ``EVERY`` ids the bit
at which they start, as steps. A codebook beside the blocks has the length of each
id's code word; canonical codes follow from the lengths alone. Code words have at most
``LONGEST`` bits, so a decoder needs one table of 2**LONGEST entries, and it decodes
all checkpoints of a block abreast.

Counts cover all documents and are taken in the pass that makes the ids. Ids come from
the tokenizers library: whole texts are cut at ASCII white space, which the vocabulary's
own rules drop and never merge across, and before a sign behind a word, and each
different piece goes to the library once while a worker remembers it.

Null texts are empty. Rows without a doc_id come first. Repeated rows are documents of
their own, in a stable order. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from json import loads as json_of

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.components import staged
from palimpsest.llm.words import Words, column, hash_spans, kinds, mix, slices, words_of
from palimpsest.workspace import new_location

VOCABULARY = "word_bpe_49k.json"
END = 1
LONGEST = 16
EVERY = 64
BLOCK_TOKENS = 1 << 16
#: Pieces a worker remembers, and pieces in one call of the library.
KEPT, TOGETHER = 1 << 21, 256
#: Bytes of text that are worked on at once; repeated pieces are looked up once in them.
SLICE_BYTES = 1 << 22


class Places:
    """Where 64-bit keys stand in a list: open addressing, many keys at a time."""

    def __init__(self, most: int):
        bits = (2 * most).bit_length()
        self.keys, self.at = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.mask = np.uint64((1 << bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 of unknown ones. No key is 0."""
        slot = (keys & self.mask).view(np.int64)
        there = self.keys[slot]
        hit = there == keys
        out = np.where(hit, self.at[slot], np.int32(-1))
        rest = np.flatnonzero(~hit & (there != 0))
        slot = slot[rest]
        while len(rest):
            slot = (slot + 1) & self.mask.view(np.int64)
            there = self.keys[slot]
            hit = there == keys[rest]
            out[rest[hit]] = self.at[slot[hit]]
            going = ~hit & (there != 0)
            rest, slot = rest[going], slot[going]
        return out

    def add(self, keys: np.ndarray, at: np.ndarray) -> None:
        """Different keys that are not there yet."""
        slot = (keys & self.mask).view(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]  # of several the last stays
            won = self.keys[slot] == keys
            self.at[slot[won]] = at[won]
            keys, at = keys[~won], at[~won]
            slot = (slot[~won] + 1) & self.mask.view(np.int64)


#: Fixed value: how the vocabulary's rules cut normal text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that the vocabulary's rules leave as they are, and together.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


class Pieces:
    """Ids of pieces of text, by the library, with a memory.

    A piece is a word. Where the vocabulary has the rules of ``VOCABULARY``, it is a word
    in small letters (they make letters small first), or the sign behind one: a single
    ``.,;:!?`` after an ASCII letter always begins a token. Words of letters that no rule
    changes or cuts then go to the library's model without those rules.
    The pieces of one call are told apart by a piece between them that is always one
    id. Where texts hold that piece themselves, the library's offsets tell.
    """

    BETWEEN, BETWEEN_PLAIN = "\n\0\n", " ! "

    def __init__(self, json: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(json)
        self.mark = self._alone(self.tokenizer, self.BETWEEN)
        self.known_rules = _has_known_rules(json)
        self.plain = Tokenizer.from_str(json)
        self.plain.normalizer = normalizers.Sequence([])
        split = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(split)
        self.plain_mark = self._alone(self.plain, self.BETWEEN_PLAIN)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._forget()

    def _forget(self) -> None:
        self.known = Places(KEPT)
        # of each piece its first id in ``pool``, one more at the end; the first piece is END
        self.first = np.array([0, 1], np.int32)
        self.pool = np.array([END], self.kind)

    @staticmethod
    def _alone(tokenizer, text: str) -> int | None:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        return ids[0] if len(ids) == 1 else None

    def _call(self, texts: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some pieces, and how many each has."""
        tokenizer, between, mark = self.tokenizer, self.BETWEEN, self.mark
        if plain and self.plain_mark is not None:
            tokenizer, between, mark = self.plain, self.BETWEEN_PLAIN, self.plain_mark
        if mark is not None:
            whole = between.join(texts)
            ids = np.array(tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, np.uint32)
            marks = np.flatnonzero(ids == mark)
            if len(marks) == len(texts) - 1:
                ends = np.append(marks - np.arange(len(marks)), len(ids) - len(marks))
                return np.delete(ids, marks), np.diff(ends, prepend=0)
        found = self.tokenizer.encode("\n".join(texts), add_special_tokens=False)
        ends = np.cumsum([len(x) + 1 for x in texts])
        starts = np.array([s for s, _ in found.offsets], np.int64)
        owner = np.searchsorted(ends, starts, "right")
        return np.array(found.ids, np.uint32), np.bincount(owner, minlength=len(texts))

    def learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        plain = np.array([self.known_rules and _PLAIN.fullmatch(x) is not None for x in pieces], bool)
        order = np.argsort(~plain, kind="stable")
        keys, at = keys[order], int(plain.sum())
        pieces = [pieces[k] for k in order.tolist()]
        found = [
            self._call(own[low : low + TOGETHER], is_plain)
            for own, is_plain in ((pieces[:at], True), (pieces[at:], False))
            for low in range(0, len(own), TOGETHER)
        ]
        self.known.add(keys, np.arange(len(self.first) - 1, len(self.first) - 1 + len(keys), dtype=np.int32))
        self.pool = np.concatenate([self.pool, *(ids.astype(self.kind) for ids, _ in found)])
        sizes = np.concatenate([x for _, x in found])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes, dtype=np.int32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with END behind, and where each text's end."""
        words = words_of(texts)
        if not len(words.starts):
            return np.full(len(texts), END, self.kind), np.arange(1, len(texts) + 1)
        data, starts, ends, first = words.data, words.starts, words.ends, words.first
        if self.known_rules:
            data = _SMALL[data]
            starts, ends, first = _with_signs(data, words)
        keys = hash_spans(data, starts, ends)
        keys[keys == 0] = 1
        place = self.known.find(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            spot, inverse = kinds(keys[new])
            if len(self.first) + len(spot) > KEPT:
                self._forget()
                new = np.arange(len(keys))
                spot, inverse = kinds(keys)
            at = new[spot]
            raw = data.tobytes()
            self.learn(keys[at], [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            place[new] = self.known.find(keys[at])[inverse]
        place = np.insert(place, first[1:], 0)  # END behind each document
        begin = self.first[place]
        own = self.first[place + 1] - begin
        stop = np.cumsum(own)
        source = np.repeat(begin - (stop - own), own)
        source += np.arange(len(source))
        return self.pool[source], stop[first[1:] + np.arange(len(texts))]


def _has_known_rules(vocabulary: str) -> bool:
    rules = json_of(vocabulary)
    normal = (rules.get("normalizer") or {}).get("normalizers") or []
    cut = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
    pattern = cut[0].get("pattern", {}).get("Regex") if cut else None
    return [n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"] and pattern == SPLIT and [
        c["type"] for c in cut
    ] == ["Split", "ByteLevel"]


_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[ord("A") : ord("Z") + 1] += 32
_SIGN, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_SIGN[list(b".,;:!?")] = True
_LETTER[ord("a") : ord("z") + 1] = True


def _with_signs(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces, and the first piece of each document: signs stand apart."""
    before = data[np.maximum(words.ends - 2, 0)]
    tail = _SIGN[data[words.ends - 1]] & _LETTER[before] & (words.ends - words.starts > 1)
    earlier = np.concatenate([[0], np.cumsum(tail)])
    at = np.arange(len(tail)) + earlier[:-1]
    starts, ends = (np.empty(len(tail) + int(earlier[-1]), np.int64) for _ in range(2))
    starts[at], ends[at] = words.starts, words.ends - tail
    signs = words.ends[tail]
    starts[at[tail] + 1], ends[at[tail] + 1] = signs - 1, signs
    return starts, ends, words.first + earlier[words.first]


@lru_cache(maxsize=2)
def _pieces(json: str) -> Pieces:
    return Pieces(json)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64) * values.dtype.itemsize
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), buffers).cast(pa.binary())


TOKENIZED = "doc_id long, ids binary, tie long, counts binary"


def _tokenized(batches: Iterator[pa.RecordBatch], json, narrow: bool) -> Iterator[pa.RecordBatch]:
    """Ids of each document, and a last row with how often the task met each id."""
    pieces = _pieces(json.value)
    total = np.zeros(0, np.int64)
    names = [x.split()[0] for x in TOKENIZED.split(", ")]
    for batch in batches:
        texts = column(batch, "text")
        for low, high in slices(texts, SLICE_BYTES):
            ids, ends = pieces.encode(texts[low:high])
            counts = np.bincount(ids)
            if len(counts) > len(total):
                counts, total = total, counts
            total[: len(counts)] += counts
            binary = _binary(ids.astype(np.uint16 if narrow else np.uint32, copy=False), ends)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id")[low:high], binary, _ties(ids, ends), pa.nulls(high - low, pa.binary())],
                names=names,
            )
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([total.tobytes()])],
        names=names,
    )


def _ties(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A number from each document's ids: rows of one doc_id are spread and ordered by it."""
    if not len(ends):
        return pa.array([], pa.int64())
    starts = np.concatenate([[0], ends[:-1]])
    middle = (starts + ends) // 2
    own = (ends - starts).astype(np.uint64) << np.uint64(32)
    return pa.array(mix(own ^ ids[starts].astype(np.uint64) ^ (ids[middle].astype(np.uint64) << np.uint64(16))).view(np.int64))


def _values(ids: pa.Array, narrow: bool) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and where each row's end."""
    kind = np.dtype(np.uint16 if narrow else np.uint32)
    wide = ids.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, wide.offset * 8)
    raw = wide.buffers()[2]
    count = int(offsets[-1] - offsets[0]) // kind.itemsize
    values = np.frombuffer(raw, kind, count, int(offsets[0])) if count else np.empty(0, kind)
    return values, (offsets[1:] - offsets[0]) // kind.itemsize


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for counts in batch.column(0):
            total = np.frombuffer(counts.as_buffer(), np.int64)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["id", "count"])


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of optimal code words of at most ``longest`` bits; 0 for counts of 0.

    Coin collecting: packages of two are merged with the single ids, level by level;
    an id's length is the number of levels at which it is among the chosen.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit in codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order].astype(np.float64)
    levels = [(single, np.arange(len(order)))]
    for _ in range(longest - 1):
        weights = levels[-1][0]
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([single, pairs])
        what = np.concatenate([np.arange(len(order)), np.full(len(pairs), -1)])
        rank = np.argsort(both, kind="stable")
        levels.append((both[rank], what[rank]))
    take = 2 * len(order) - 2
    for _, what in reversed(levels):
        chosen = what[:take]
        lengths[order[chosen[chosen >= 0]]] += 1
        take = 2 * int((chosen < 0).sum())
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code words by length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    code = 0
    last = 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for k in order[np.searchsorted(lengths[order], 1) :].tolist():
        code <<= int(lengths[k]) - last
        last = int(lengths[k])
        codes[k] = code
        code += 1
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The code words of the ids as bits, and how many bits each EVERY of them take."""
    size = lengths[ids].astype(np.int64)
    stop = np.cumsum(size)
    start = stop - size
    words = np.zeros(int(stop[-1]) // 32 + 2 if len(ids) else 1, np.uint64)
    if len(ids):
        shifted = codes[ids].astype(np.uint64) << (64 - (start & 31) - size).astype(np.uint64)
        word = start >> 5
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[heads]] += np.bitwise_or.reduceat(shifted >> np.uint64(32), heads)
        words[word[heads] + 1] += np.bitwise_or.reduceat(shifted & np.uint64(0xFFFFFFFF), heads)
    marks = start[::EVERY]
    steps = np.diff(np.append(marks, stop[-1] if len(ids) else 0)).astype("<u2") if len(ids) else np.empty(0, "<u2")
    return words.astype(">u4").tobytes(), steps


class Decoder:
    def __init__(self, lengths: np.ndarray):
        self.longest = longest = max(1, int(lengths.max(initial=1)))
        codes = canonical(lengths)
        self.symbol = np.zeros(1 << longest, np.uint32)
        self.size = np.ones(1 << longest, np.uint8)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[np.searchsorted(lengths[order], 1) :]
        spans = np.int64(1) << (longest - lengths[order].astype(np.int64))
        first = codes[order].astype(np.int64) << (longest - lengths[order].astype(np.int64))
        if len(order):
            filled = int(spans.sum())
            at = np.repeat(first, spans) + np.arange(filled) - np.repeat(np.cumsum(spans) - spans, spans)
            self.symbol[at] = np.repeat(order, spans)
            self.size[at] = np.repeat(lengths[order], spans)

    def unpack(self, payload: bytes, steps: np.ndarray, count: int) -> np.ndarray:
        """``count`` ids; all checkpoints are decoded side by side."""
        data = np.frombuffer(payload, np.uint8).astype(np.uint32)
        data = np.concatenate([data, np.zeros(4, np.uint32)])
        peek = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        at = np.concatenate([[0], np.cumsum(steps.astype(np.int64))])[: len(steps)]
        out = np.empty((len(steps), EVERY), np.uint32)
        shift = np.uint32(32 - self.longest)
        for k in range(EVERY):
            if k == count - (len(steps) - 1) * EVERY:
                at = at[:-1]  # the last checkpoint has fewer
            code = peek[at >> 3] << (at & 7).astype(np.uint32) >> shift
            out[: len(at), k] = self.symbol[code]
            at = at + self.size[code]
        return out.reshape(-1)[:count]


BLOCK = "part int, before long, n_tokens long, doc_ids binary, known binary, sizes binary, steps binary, bits binary"


def _blocks(batches: Iterator[pa.RecordBatch], book, narrow: bool) -> Iterator[pa.RecordBatch]:
    lengths, codes = book.value
    before = 0
    held: list[tuple] = []
    size = 0

    def written() -> pa.RecordBatch:
        ids = np.concatenate([x[3] for x in held])
        bits, steps = pack(ids, lengths, codes)
        doc_ids = np.array([x[1] or 0 for x in held], "<i8")
        known = np.array([x[1] is not None for x in held])
        sizes = np.array([len(x[3]) for x in held], "<i8")
        row = [held[0][0], before, len(ids), doc_ids.tobytes(), known.tobytes(), sizes.tobytes(), steps.tobytes(), bits]
        kinds_ = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], kind) for x, kind in zip(row, kinds_)], names=[x.split()[0] for x in BLOCK.split(", ")]
        )

    for batch in batches:
        part, docs = column(batch, "part").to_pylist(), column(batch, "doc_id").to_pylist()
        values, ends = _values(column(batch, "ids"), narrow)
        for k, ids in enumerate(np.split(values, ends[:-1])):
            if held and size + len(ids) > BLOCK_TOKENS:
                yield written()
                before, held, size = before + size, [], 0
            held.append((part[k], docs[k], None, ids))
            size += len(ids)
    if held:
        yield written()


READ = "doc_id long, start long, n_tokens long, ids binary"


def _read(batches: Iterator[pa.RecordBatch], book, before) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(book.value[0])
    for batch in batches:
        for row in batch.to_pylist():
            ids = decoder.unpack(row["bits"], np.frombuffer(row["steps"], "<u2"), row["n_tokens"])
            sizes = np.frombuffer(row["sizes"], "<i8")
            ends = np.cumsum(sizes)
            doc_ids, known = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["known"], bool)
            start = before.value[row["part"]] + row["before"] + ends - sizes
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, mask=~known), pa.array(start), pa.array(sizes), _binary(ids.astype("<u4"), ends)],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def write(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Writes ``path/blocks`` and ``path/codebook``."""
    spark = docs.sparkSession
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        json = file.read()
    from tokenizers import Tokenizer

    narrow = Tokenizer.from_str(json).get_vocab_size() <= 1 << 16
    shared = spark.sparkContext.broadcast(json)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    both = staged(rows.mapInArrow(lambda it: _tokenized(it, shared, narrow), TOKENIZED), "token-ids")
    counted = (
        both.where("counts is not null").select("counts").mapInArrow(_counted, "id int, count long")
        .groupBy("id").agg(F.sum("count").alias("count")).collect()
    )  # fmt: skip  # a row for each id of the vocabulary at most
    counts = np.zeros(max((r.id for r in counted), default=0) + 1, np.int64)
    for row in counted:
        counts[row.id] = row["count"]
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    book = spark.createDataFrame([(int(k), int(lengths[k])) for k in used], "id int, bits int")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    code = spark.sparkContext.broadcast((lengths, canonical(lengths)))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    (
        both.where("counts is null").select("doc_id", "tie", "ids").repartitionByRange(*order)
        .sortWithinPartitions(*order, F.xxhash64("ids"))
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(lambda it: _blocks(it, code, narrow), BLOCK)
        .write.parquet(f"{path}/blocks")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document's), n_tokens and ids, from the files.

    A block knows how many ids stand before it in its part; of every part (a task's
    output) one number goes to the driver.
    """
    lengths = np.zeros(1, np.uint8)
    for row in spark.read.parquet(f"{path}/codebook").collect():
        if row.id >= len(lengths):
            lengths = np.concatenate([lengths, np.zeros(row.id + 1 - len(lengths), np.uint8)])
        lengths[row.id] = row.bits
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    before, total = {}, 0
    for row in sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).collect()):
        before[row.part] = total
        total += row.n_tokens
    book, starts = (spark.sparkContext.broadcast(x) for x in ((lengths, None), before))
    return blocks.mapInArrow(lambda it: _read(it, book, starts), READ)


def round_trip(docs: DataFrame) -> DataFrame:
    """Writes the files of all documents and says what is in them."""
    path = new_location(docs.sparkSession, "token-files")
    write(docs, path)
    return read(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
