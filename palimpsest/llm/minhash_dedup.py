"""Near-duplicate documents by order MinHash, verified by banded alignment.

Documents are sequences of five-word shingles (all words, if there are fewer). The
similarity of two is the ordered Jaccard similarity of these sequences: M shingles
aligned in order of a + b - M. Pairs at 0.8 or more are links; a group is what links
connect. Reordered text is not similar, as edit similarity has it.

1. Every shingle is labelled with its occurrence in the document. Each of
   ``SKETCHES`` orders of the labelled shingles picks the ``PICKS`` smallest, and
   the sketch is their sequence in text order. Of U shingles that two documents have,
   M in common, one agrees with probability C(M, 6) / C(U, 6), if none repeats. At 0.8
   that is 0.239 for 36 of 45, so all 40 miss 18 such pairs in a million, and 0.262
   for long texts, 5 in a million. For short ones it would be far less, so pairs of at most
   ``SHORT`` shingles have ``SHORT_SKETCHES`` of their own, of the ``SHORT_PICKS``
   smallest in any order: 0.4 for 4 of 5, the fewest that can be similar and differ,
   and more for all others, so that they miss 1 pair in 4 million at most.
2. Documents of the same words are one node, whatever their number.
3. Nodes that share a sketch and whose lengths allow 0.8 are candidates. First each
   is aligned with one hub of its bucket. Then those not in the hub's group are
   compared with the hub's other nodes, blocks against blocks, where a matrix product
   of shingle counts rules most pairs out. Only links that join groups come out: a
   large group of near copies gives rows in proportion to its size, and no link that
   would join two groups is left out.
4. The alignment is a longest common subsequence within the band that a similarity
   of 0.8 allows, exact at that threshold, over 32-bit shingle hashes.

Documents without words (null, empty, blank) stay alone. Word sequences are told
apart by 64-bit hashes. Input columns called like those added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.components import bitmap, connected, is_set, staged
from palimpsest.llm.words import column, hash_runs, mix, slices, words_of

SHINGLE = 5
PICKS = 6
SKETCHES = 40
#: Pairs of up to SHORT shingles: fewer picks, as they are drawn without replacement.
SHORT, SHORT_PICKS, SHORT_SKETCHES = 40, 3, 30
SIMILARITY = 0.8
#: Nodes of a hub in one block of a task, and in one matrix product; columns of it.
HUB_BLOCK, TOGETHER, COLUMNS = 1024, 256, 1 << 13
_GENERATOR = np.random.Generator(np.random.PCG64(5))
_ODD = _GENERATOR.integers(0, 2**63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _GENERATOR.integers(0, 2**63, PICKS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT_ODD = _GENERATOR.integers(0, 2**63, SHORT_SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
#: A place for documents without an id, above all others.
NO_ID = 2**63 - 1


def shingles(words: np.ndarray) -> np.ndarray:
    if len(words) >= SHINGLE:
        return hash_runs(words, SHINGLE)
    return hash_runs(words, len(words)) if len(words) else words


def labelled(items: np.ndarray) -> np.ndarray:
    """Hashes of the items and of how often each came before."""
    order = np.argsort(items, kind="stable")
    ranked = items[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    place = np.arange(len(items))
    occurrence = np.empty(len(items), np.uint64)
    occurrence[order] = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    return mix(items + occurrence * np.uint64(0x9E3779B97F4A7C15), 21)


def order_sketch(own: np.ndarray) -> np.ndarray:
    """SKETCHES hashes of the smallest of PICKS or more labelled items in text order."""
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 21) // len(own))
    for low in range(0, SKETCHES, step):
        odd = _ODD[low : low + step, None]
        chosen = np.argpartition(own[None, :] * odd, PICKS - 1, axis=1)[:, :PICKS]
        chosen.sort(axis=1)
        out[low : low + step] = (own[chosen] * _STEP).sum(axis=1, dtype=np.uint64)
    return mix(out + np.arange(SKETCHES, dtype=np.uint64) * _STEP[0], 22)


def short_sketch(own: np.ndarray) -> np.ndarray:
    """SHORT_SKETCHES hashes of the smallest of SHORT_PICKS or more labelled items, as a set."""
    chosen = np.argpartition(own[None, :] * _SHORT_ODD[:, None], SHORT_PICKS - 1, axis=1)[:, :SHORT_PICKS]
    out = mix(own[chosen], 23).sum(axis=1, dtype=np.uint64)
    return mix(out + np.arange(SHORT_SKETCHES, dtype=np.uint64) * _STEP[0], 24)


def sketches(items: np.ndarray) -> np.ndarray:
    """A document's sketches: the short pairs' and, if it can be in a longer pair, the others.

    Documents of up to three shingles have none: only equal ones are similar to them.
    """
    if len(items) <= SHORT_PICKS:
        return np.empty(0, np.uint64)
    own = labelled(items)
    found = []
    if len(items) <= SHORT:
        found.append(short_sketch(own))
    if 10 * len(items) >= 8 * (SHORT + 1):
        found.append(order_sketch(own))
    return np.concatenate(found)


SKETCHED = "id long, tag long, node long, n int, sketch array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = column(batch, "text")
        for low, high in slices(texts):
            words = words_of(texts[low:high])
            hashes = words.hashes()
            nodes, sizes, found, rows = [], [], [], []
            for k in range(high - low):
                own = hashes[words.first[k] : words.first[k + 1]]
                if not len(own):
                    continue
                items = shingles(own)
                rows.append(low + k)
                nodes.append(hash_runs(own, len(own))[0])
                sizes.append(len(items))
                found.append(sketches(items))
            if not rows:
                continue
            flat = np.concatenate(found).view(np.int64)
            ends = np.cumsum([0, *(len(x) for x in found)])
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "id").take(pa.array(rows)),
                    column(batch, "tag").take(pa.array(rows)),
                    pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                names=["id", "tag", "node", "n", "sketch"],
            )


def _sequences(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = column(batch, "id").to_numpy(zero_copy_only=False)
        mask = is_set(ids, *wanted.value)
        if not mask.any():
            continue
        texts = column(batch, "text").filter(pa.array(mask))
        for low, high in slices(texts):
            words = words_of(texts[low:high])
            hashes = words.hashes()
            nodes, rows = [], []
            for k in range(high - low):
                own = hashes[words.first[k] : words.first[k + 1]]
                if len(own):
                    nodes.append(hash_runs(own, len(own))[0])
                    rows.append((shingles(own) >> np.uint64(32)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(rows, pa.binary())],
                names=["node", "items"],
            )


def aligned_at_least(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Do a and b align in at least ``least`` places in order?

    Fewer than len(a) + len(b) - 2 * least places stay unaligned then, which is the
    band: no other place can be part of such an alignment.
    """
    band = len(a) + len(b) - 2 * least
    if band < 0 or min(len(a), len(b)) < least:
        return False
    short = min(len(a), len(b))
    same = a[:short] == b[:short]
    head = short if same.all() else int(np.argmin(same))
    a, b, short = a[head:], b[head:], short - head
    same = a[len(a) - short :][::-1] == b[len(b) - short :][::-1]
    tail = short if same.all() else int(np.argmin(same))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    least -= head + tail
    if least <= 0:
        return True
    if min(np.isin(a, b).sum(), np.isin(b, a).sum()) < least:
        return False
    at: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        at[x] = at.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    width = (1 << 2 * band + 1) - 1
    open_ = every
    for i, x in enumerate(a.tolist()):
        match = at.get(x, 0)
        if match:
            match &= width << i - band if i >= band else width >> band - i
            taken = open_ & match
            open_ = (open_ + taken | open_ - taken) & every
    return len(b) - open_.bit_count() >= least


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    # M / (len(a) + len(b) - M) >= 8 / 10 in whole numbers: M >= 8 (len(a) + len(b)) / 18
    return aligned_at_least(a, b, -(-8 * (len(a) + len(b)) // 18))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (column(batch, x) for x in ("items_a", "items_b"))
        good = [
            similar(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32))
            for x, y in zip(*columns)
        ]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _links(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """Of the pairs a, b those similar. The sequences of a, the hubs, are joined last."""
    with_b = pairs.join(sequences.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
    both = with_b.join(sequences.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
    return staged(both.select("a", "b", "items_a", "items_b").mapInArrow(_verified, "a long, b long"), "links")


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by task; of each task the links that join its groups."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([column(batch, x).to_numpy() for x in ("hub", "i", "j")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            key = tuple(keys[low].tolist())
            if held and key != last:
                yield _joining(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield _joining(held)


def _joining(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    node, group = rows["node"].to_numpy(), rows["group"].to_numpy()
    apart = rows["apart"].to_numpy(zero_copy_only=False)
    items = [np.frombuffer(x, np.uint32) for x in rows["items"].to_pylist()]
    size = np.array([len(x) for x in items])
    ones, others = np.flatnonzero(apart), np.flatnonzero(~apart)
    parent = {int(g): int(g) for g in np.unique(group)}

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    found: list[tuple[int, int]] = []
    for low in range(0, len(ones), TOGETHER):
        left = ones[low : low + TOGETHER]
        for at in range(0, len(others), TOGETHER):
            right = others[at : at + TOGETHER]
            least = -(-8 * (size[left][:, None] + size[right]) // 18)
            open_ = (group[left][:, None] != group[right]) & (np.minimum.outer(size[left], size[right]) >= least)
            if open_.sum() > len(left) + len(right):
                open_ &= _in_common([items[k] for k in left], [items[k] for k in right]) >= least
            for x, y in zip(*np.nonzero(open_)):
                a, b = left[x], right[y]
                one, other = root(int(group[a])), root(int(group[b]))
                if one != other and similar(items[a], items[b]):
                    parent[one] = other
                    found.append((int(node[a]), int(node[b])))
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _in_common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """For all pairs how many items they have in common at most: a matrix product.

    An item that one holds repeatedly counts as often as that, at either side.
    """
    sides = []
    ranks, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    cuts = np.cumsum([len(x) for x in [*left, *right]])
    total = np.zeros((len(left), len(right)))
    parts = np.split(place, cuts[:-1])
    for low in range(0, len(ranks), COLUMNS):
        sides = []
        for part in (parts[: len(left)], parts[len(left) :]):
            matrix = np.zeros((len(part), COLUMNS), np.float32)
            for k, x in enumerate(part):
                own = x[(x >= low) & (x < low + COLUMNS)] - low
                np.add.at(matrix[k], own, 1)
            sides.append(matrix)
        one, other = sides
        total += np.minimum((one > 0) @ other.T, one @ (other.T > 0)) if (one.max() > 1 or other.max() > 1) else one @ other.T
    return total


def _links_apart(named: DataFrame, sequences: DataFrame) -> DataFrame:
    """Links between nodes that are not in their hub's group and others of the hub.

    named: hub, node, group, apart. All that share a bucket have its hub in common, so
    comparing within hubs leaves out nothing. A hub's nodes are cut into blocks of
    about HUB_BLOCK, and each pair of blocks is a task's work of its own; pairs are
    compared inside it and only links that join groups come out.
    """
    count = named.groupBy("hub").agg(F.count("*").alias("all"), F.sum(F.col("apart").cast("int")).alias("some"))
    blocks = count.where("some > 0 AND all > 1").select(
        "hub", F.ceil(F.col("some") / HUB_BLOCK).cast("int").alias("left"), F.ceil(F.col("all") / HUB_BLOCK).cast("int").alias("right")
    )
    rows = named.join(blocks, "hub").join(sequences, "node")
    to = lambda many: F.sequence(F.lit(0), F.col(many) - 1)
    own = lambda many: F.pmod(F.xxhash64("node"), F.col(many)).cast("int")
    ones = rows.where("apart").select("hub", own("left").alias("i"), F.explode(to("right")).alias("j"), "node", "group",
                                      F.lit(True).alias("apart"), "items")
    others = rows.select("hub", F.explode(to("left")).alias("i"), own("right").alias("j"), "node", "group",
                         F.lit(False).alias("apart"), "items")
    keys = ["hub", "i", "j"]
    tasks = ones.union(others).repartition(*keys).sortWithinPartitions(*keys)
    return staged(tasks.mapInArrow(_tested, "a long, b long"), "links")


def _lengths_allow(one: str, other: str):
    return (F.least(one, other) * 10 >= F.greatest(one, other) * 8)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, tag, ``component_id`` (the group's least doc_id), ``kept``.

    docs: ``doc_id`` and ``text``. tag is Spark's 64-bit hash of the text, which tells
    documents of one id apart. Of each group the document of the least id is kept;
    repeated rows are all marked kept, see ``keep_one``.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("tag"), "text"
    )
    members = staged(keyed.mapInArrow(_sketched, SKETCHED), "sketches")
    nodes = members.groupBy("node").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    rows = staged(nodes.select("node", "id", "n", F.explode("sketch").alias("bucket")), "buckets")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = staged(rows.join(sizes, "bucket"), "shared")
    # the text that others are copies of shares most sketches with them: the best hub
    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    hubs = (
        shared.join(degrees, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node", "n")).alias("hub"))
        .select("bucket", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    shared = staged(shared.join(hubs, "bucket"), "shared")
    wanted = shared.select("id").distinct()
    bits = spark.sparkContext.broadcast(bitmap(wanted, shared.select("node").distinct().count()))
    sequences = staged(
        keyed.select("id", "text").mapInArrow(lambda it: _sequences(it, bits), "node long, items binary")
        .groupBy("node").agg(F.first("items").alias("items")),
        "sequences",
    )
    first = (
        shared.where((F.col("node") != F.col("hub")) & _lengths_allow("n", "hub_n"))
        .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    )
    links = _links(first, sequences)
    groups = staged(connected(links), "groups")
    left = groups.select(F.col("node").alias("node"), F.col("component").alias("group"))
    named = shared.join(left, "node", "left").withColumn("group", F.coalesce("group", "node"))
    hub_group = left.select(F.col("node").alias("hub"), F.col("group").alias("hub_group"))
    named = named.join(hub_group, "hub", "left").withColumn("hub_group", F.coalesce("hub_group", "hub"))
    named = named.where("node <> hub").select("hub", "node", "group", (F.col("group") != F.col("hub_group")).alias("apart"))
    named = staged(named.distinct(), "named")
    links = links.union(_links_apart(named, sequences))
    groups = connected(links)
    grouped = (
        members.select("id", "tag", "node")
        .join(groups, "node", "left")
        .select("id", "tag", F.coalesce("component", "node").alias("group"))
    )
    grouped = staged(grouped, "grouped")
    least = grouped.groupBy("group").agg(F.min(F.struct("id", "tag")).alias("least"))
    out = grouped.join(least, "group").select(
        "id", "tag", F.col("least.id").alias("component"), (F.col("least") == F.struct("id", "tag")).alias("kept")
    )
    alone = keyed.where("text IS NULL OR NOT text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").select(
        "id", "tag", F.col("id").alias("component"), F.lit(True).alias("kept")
    )
    named_id = lambda name: F.when(F.col(name) != NO_ID, F.col(name))
    return out.union(alone).select(
        named_id("id").alias("doc_id"), "tag", named_id("component").alias("component_id"), "kept"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay: one of each group; columns as they were.

    Of rows with the same id and text, the one whose columns have the least hash.
    """
    kept = near_duplicates(docs).where("kept").select("doc_id", "tag").distinct()
    whole = docs.select(F.struct("*").alias("doc"))
    keyed = whole.select(F.col("doc.doc_id").cast("long").alias("own"), F.xxhash64("doc.text").alias("own_tag"), "doc")
    words = F.col("doc.text").rlike("[^\\x20\\x09-\\x0D]")
    some, none = keyed.where(words), keyed.where(~F.coalesce(words, F.lit(False)))
    some = some.join(kept, some["own"].eqNullSafe(kept["doc_id"]) & (some["own_tag"] == kept["tag"]), "left_semi")
    one = some.groupBy("own", "own_tag").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return one.unionByName(none.select(*one.columns)).select("doc.*")
