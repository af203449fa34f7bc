"""Remove passages that occur more than once, by a count-min prefilter.

A window is a run of ``window`` words of one document. Every word in a window
whose word sequence also starts anywhere else goes, in all its places.

1. Each window has an anchor: its run of ``ANCHOR`` words with the smallest hash.
   Equal windows have equal anchors at different places, so an anchor's count is
   never below the count of a window that has it. Tasks count anchors (about one
   place in eleven) in count-min sketches of two rows; merged, they say which
   anchors may occur twice. Counters saturate at 2, so a merged sketch is a bit
   for each counter.
2. A second pass takes only windows whose anchor is estimated repeated, and groups
   them exactly, by 128 bits of hash. Windows that one task has seen twice are
   settled there and stand for one row in the shuffle, so a passage that a third
   of all documents share gives each task's share a row, not each document.

The sketch is broadcast; ``MOST_COUNTERS`` bounds it (2 x 128 MB). Beyond some
sixty billion words it fills up: the second pass then groups more windows than it
need, and still loses none.

Documents of one id, or without any, are told apart by 64-bit hashes of their texts.
Null texts have no words. Repeated rows are documents like any other. Columns of
the input that are called like those added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from palimpsest.llm.words import Words, column, hash_runs, mix, slices, words_of
from palimpsest.workspace import new_location

WINDOW = 35
#: Words of an anchor; a window of fewer words is its own anchor.
ANCHOR = 15
#: Bytes of text for each counter of a sketch row: about eight counters an anchor.
BYTES_PER_COUNTER = 8
LEAST_COUNTERS, MOST_COUNTERS = 1 << 20, 1 << 30
BLOCK = 1 << 16
#: Anchors or windows that a task gathers before it groups them.
GATHER = 1 << 19


def _anchors(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows, the place of each one's anchor, hashes of all runs."""
    size = min(ANCHOR, window)
    runs = hash_runs(hashes, size)
    begins = words.run_starts(window)
    if not len(begins):
        return begins, begins, runs
    span = window - size + 1
    least, place = runs, np.arange(len(runs))
    width = 1
    while width < span:
        step = min(width, span - width)
        left, right = least[:-step], least[step:]
        take = right < left
        place = np.where(take, place[step:], place[:-step])
        least = np.where(take, right, left)
        width += step
    return begins, place[begins], runs


def _counters(hashes: np.ndarray, counters: int) -> list[np.ndarray]:
    shift = np.uint64(64 - (counters.bit_length() - 1))
    return [(mix(hashes, 7) >> shift).astype(np.int64), (mix(hashes, 8) >> shift).astype(np.int64)]


def _sketch_rows(gathered: list[np.ndarray], counters: int) -> Iterator[pa.RecordBatch]:
    hashes = np.concatenate(gathered)
    for row, at in enumerate(_counters(hashes, counters)):
        at, counts = np.unique(at, return_counts=True)
        block = at // BLOCK
        cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))[: len(np.unique(block))]
        local = (at % BLOCK).astype(np.uint16)
        once, twice = np.split(local, cuts[1:]), np.split(counts > 1, cuts[1:])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block[cuts] + row * (counters // BLOCK), pa.int32()),
                pa.array([x.tobytes() for x in once], pa.binary()),
                pa.array([x[y].tobytes() for x, y in zip(once, twice)], pa.binary()),
            ],
            names=["block", "once", "twice"],
        )


def _sketch(batches: Iterator[pa.RecordBatch], window: int, counters: int) -> Iterator[pa.RecordBatch]:
    gathered: list[np.ndarray] = []
    held = 0
    for batch in batches:
        texts = column(batch, "text")
        for low, high in slices(texts):
            words = words_of(texts[low:high])
            _, places, runs = _anchors(words, words.hashes(), window)
            gathered.append(runs[np.unique(places)])
            held += len(gathered[-1])
            if held >= GATHER:
                yield from _sketch_rows(gathered, counters)
                gathered, held = [], 0
    if held:
        yield from _sketch_rows(gathered, counters)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds sketches up, block by block, as they come; counts above 2 are 2."""
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, once, twice in zip(*(column(batch, x).to_pylist() for x in ("block", "once", "twice"))):
            counts = seen.setdefault(block, np.zeros(BLOCK, np.uint8))
            once, twice = np.frombuffer(once, np.uint16), np.frombuffer(twice, np.uint16)
            counts[once] = np.minimum(counts[once] + 1, 2)
            counts[twice] = 2
    for block, counts in seen.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())],
            names=["block", "repeated"],
        )


def repeated_sketch(texts: DataFrame, window: int = WINDOW) -> tuple[np.ndarray, int]:
    """For each counter whether it reached 2, as bits; and the counters of a row."""
    spark = texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = total // BYTES_PER_COUNTER
    counters = min(MOST_COUNTERS, max(LEAST_COUNTERS, 1 << int(wanted).bit_length()))
    blocks = 2 * counters // BLOCK
    where = new_location(spark, "sketch")
    (
        texts.select("text")
        .mapInArrow(lambda it: _sketch(it, window, counters), "block int, once binary, twice binary")
        .repartition(max(1, blocks // 256), "block")
        .mapInArrow(_merge, "block int, repeated binary")
        .write.parquet(where)
    )
    bits = np.zeros((blocks, BLOCK // 8), np.uint8)
    for row in spark.read.parquet(where).toLocalIterator():
        bits[row.block] = np.frombuffer(row.repeated, np.uint8)
    return bits.reshape(2, -1), counters


def _maybe_repeated(hashes: np.ndarray, bits: np.ndarray, counters: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for row, at in enumerate(_counters(hashes, counters)):
        found &= (bits[row][at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return found


#: What rows of one document have in common first, what differs last: it compresses best.
CANDIDATES = "doc_id long, tag long, length int, n int, d1 long, d2 long, start int"


def _settle(gathered: list[tuple], window: int) -> Iterator[pa.RecordBatch]:
    """Windows seen twice are settled as ranges, with one row to stand for them."""
    d1, d2, ids, known, tags, starts = (np.concatenate(x) for x in zip(*gathered))
    given = d1, d2, ids, known, tags, starts
    order = np.lexsort((d2, d1))
    d1, d2, ids, known, tags, starts = (x[order] for x in given)
    new = np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])])
    group = np.cumsum(new) - 1
    twice = np.bincount(group)[group] > 1
    stand = twice & new
    # in the order of the documents, which compresses far better than that of the hashes
    alone = np.sort(order[~twice])

    def rows(d1, d2, ids, known, tags, starts, lengths, n):
        size = len(d1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, mask=~known),
                pa.array(tags),
                pa.array(lengths.astype(np.int32)) if lengths is not None else pa.nulls(size, pa.int32()),
                pa.array(np.full(size, n, np.int32)),
                pa.array(d1.view(np.int64)),
                pa.array(d2.view(np.int64)),
                pa.array(starts.astype(np.int32)) if starts is not None else pa.nulls(size, pa.int32()),
            ],
            names=[x.split()[0] for x in CANDIDATES.split(", ")],
        )

    *single, begins = (x[alone] for x in given)
    yield from rows(*single, begins, np.full(len(begins), window), 1)
    yield from rows(d1[stand], d2[stand], ids[stand], known[stand], tags[stand], None, None, 2)
    ids, known, tags, starts = (x[twice] for x in (ids, known, tags, starts))
    order = np.lexsort((starts, tags, ids, known))
    ids, known, tags, starts = (x[order] for x in (ids, known, tags, starts))
    if len(ids):
        same = (ids[1:] == ids[:-1]) & (known[1:] == known[:-1]) & (tags[1:] == tags[:-1])
        head = np.concatenate([[True], ~same | (starts[1:] > starts[:-1] + window)])
        tail = np.concatenate([head[1:], [True]])
        keys = ids[head].view(np.uint64) ^ mix(tags[head].view(np.uint64), 5)
        yield from rows(mix(keys, 3), mix(starts[head].astype(np.uint64) + keys, 4), ids[head],
                        known[head], tags[head], starts[head], starts[tail] + window - starts[head], 2)


def _candidates(batches: Iterator[pa.RecordBatch], window: int, sketch) -> Iterator[pa.RecordBatch]:
    bits, counters = sketch.value
    gathered: list[tuple] = []
    held = 0
    for batch in batches:
        texts = column(batch, "text")
        all_ids = column(batch, "doc_id")
        valid = all_ids.is_valid().to_numpy(zero_copy_only=False)
        all_ids = all_ids.fill_null(0).to_numpy()
        all_tags = column(batch, "tag").to_numpy()
        for low, high in slices(texts):
            words = words_of(texts[low:high])
            hashes = words.hashes()
            begins, places, runs = _anchors(words, hashes, window)
            if not len(begins):
                continue
            maybe = np.zeros(len(runs), bool)
            used = np.unique(places)
            maybe[used] = _maybe_repeated(runs[used], bits, counters)
            begins = begins[maybe[places]]
            if not len(begins):
                continue
            doc = np.searchsorted(words.first, begins, "right") - 1
            starts = begins - words.first[doc]
            doc += low
            gathered.append((hash_runs(hashes, window, 0)[begins],
                             hash_runs(words.hashes(1), window, 1)[begins],
                             all_ids[doc], valid[doc], all_tags[doc], starts))
            held += len(begins)
            if held >= GATHER:
                yield from _settle(gathered, window)
                gathered, held = [], 0
    if held:
        yield from _settle(gathered, window)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "kept_text", "n_words", "n_removed"]
    for batch in batches:
        docs, ranges = column(batch, "doc"), column(batch, "ranges")
        texts = docs.field("text")
        for low, high in slices(texts):
            found = words_of(texts[low:high])
            kept, counts, removed = [], [], []
            for k, pairs in enumerate(ranges[low:high].to_pylist()):
                first, last = int(found.first[k]), int(found.first[k + 1])
                gone = np.zeros(last - first + 1, np.int32)
                if pairs:
                    pairs = np.array([(x["start"], x["stop"]) for x in pairs])
                    np.add.at(gone, pairs[:, 0], 1)
                    np.add.at(gone, pairs[:, 1], -1)
                stay = np.cumsum(gone[:-1]) == 0
                if stay.all() and first < last:
                    part = bytes(found.data[found.starts[first] : found.ends[last - 1]])
                    kept.append(b" ".join(part.split()))
                else:
                    spans = zip(found.starts[first:last][stay], found.ends[first:last][stay])
                    kept.append(b" ".join(bytes(found.data[s:e]) for s, e in spans))
                counts.append(last - first)
                removed.append(int(len(stay) - stay.sum()))
            yield pa.RecordBatch.from_arrays(
                [docs[low:high], pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                names=names,
            )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with ``kept_text``, ``n_words`` and ``n_removed``.

    docs: at least ``doc_id`` and ``text``. kept_text has the words that stay, joined
    by one space, and is empty where none stays.
    """
    spark: SparkSession = docs.sparkSession
    added = ("kept_text", "n_words", "n_removed")
    docs = docs.drop(*added).withColumn("doc_id", F.col("doc_id").cast("long"))
    bits = repeated_sketch(docs, window)
    sketch = spark.sparkContext.broadcast(bits)
    tag = F.xxhash64("text")
    windows = docs.select("doc_id", "text", tag.alias("tag")).mapInArrow(
        lambda it: _candidates(it, window, sketch), CANDIDATES
    )
    repeated = (
        windows.withColumn("total", F.sum("n").over(Window.partitionBy("d1", "d2")))
        .where((F.col("total") > 1) & F.col("start").isNotNull())
        .groupBy("doc_id", "tag")
        .agg(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("stop"))).alias("ranges"))
    )
    whole = docs.select(F.struct("*").alias("doc"))
    keyed = whole.withColumn("own_tag", F.xxhash64("doc.text"))
    joined = keyed.join(
        repeated,
        keyed["doc.doc_id"].eqNullSafe(repeated["doc_id"]) & (keyed["own_tag"] == repeated["tag"]),
        "left",
    ).select("doc", "ranges")
    schema = T.StructType(
        [
            T.StructField("doc", whole.schema["doc"].dataType),
            T.StructField("kept_text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    return joined.mapInArrow(_cut, schema).select("doc.*", *added)
