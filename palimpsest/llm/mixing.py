"""Mix sources to target weights by Sainte-Lague apportionment of equal-token blocks.

A source's share of the mix is cut into blocks of equally many words. Blocks are
seats: sources get them by highest quotients (words wanted over 1, 3, 5, ...), and so
do, within a source, its shards. A shard is a hash class of about ``SHARD_DOCS``
documents of one source, in a seeded order, cut into blocks of its own. It takes its
quota as whole passes over its words and, of the blocks, as many more as are left over:
block ``j`` is one of them if ``(step * j + offset) % blocks`` is below their number,
with seeded step and offset, the step prime to the number of blocks. That is a
permutation, so exactly as many are chosen, each document finds its own without looking
at others, and none is taken more than twice where the target is at most twice the
source. Reruns agree.

A source has as many shards as its documents need. Its seats go down a tree of hash
prefixes, ``FAN`` children a node, so that no task apportions more than ``FAN`` parts.
Words are counted first and staged without their texts. One row a source reaches the
driver; sums of shards stay on the cluster, and Spark broadcasts them only below its own
threshold.

Null and empty texts have size 0 and are not taken. A null source is a source of its
own, the last. Repeated rows are documents like any other. Input columns called like
those added are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
from fractions import Fraction
from math import gcd

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.llm.components import staged

WEIGHTS = (5, 2, 1)
BUDGET = Fraction(3, 2)
MOST_TIMES = 2
SEED = 17
SHARD_DOCS = 2048
#: Children of a node in the tree of a source's shards, as bits.
FAN_BITS = 10
FAN = 1 << FAN_BITS
#: Words of a block at most; the least target has a thousand blocks where it can.
BLOCK_WORDS = 64
ADDED = ("size", "source_size", "target", "taken")


def targets(sizes: list[int], weights: list[int], total: Fraction, times: int = MOST_TIMES) -> list[Fraction]:
    """Shares of the total by weight, at most ``times`` the size; excess is shared again."""
    given: list[Fraction | None] = [None] * len(sizes)
    left = Fraction(total)
    while True:
        open_ = [k for k, x in enumerate(given) if x is None]
        weight = sum(weights[k] for k in open_)
        above = [k for k in open_ if left * weights[k] > times * sizes[k] * weight]
        if not above:
            return [left * weights[k] / weight if x is None else x for k, x in enumerate(given)]
        for k in above:
            given[k] = Fraction(times * sizes[k])
        left -= sum(given[k] for k in above)


def seats(wanted: list[int | Fraction], total: int) -> list[int]:
    """``total`` seats by highest quotients wanted / (2 k + 1); ties to the first.

    Starts from what rounding by the common divisor gives, which is at most a seat or
    so a party off, and adds or takes back seats by their quotients.
    """
    everything = sum(wanted)
    if not everything:
        return [0] * len(wanted)
    have = [int(Fraction(w) * total / everything + Fraction(1, 2)) for w in wanted]
    spare = total - sum(have)
    gain = [(-Fraction(w) / (2 * n + 1), k) for k, (w, n) in enumerate(zip(wanted, have)) if w]
    heapq.heapify(gain)
    while spare > 0:
        _, k = heapq.heappop(gain)
        have[k] += 1
        spare -= 1
        heapq.heappush(gain, (-Fraction(wanted[k]) / (2 * have[k] + 1), k))
    lose = [(Fraction(w) / (2 * n - 1), -k) for k, (w, n) in enumerate(zip(wanted, have)) if n]
    heapq.heapify(lose)
    while spare < 0:
        _, k = heapq.heappop(lose)
        have[-k] -= 1
        spare += 1
        if have[-k]:
            heapq.heappush(lose, (Fraction(wanted[-k]) / (2 * have[-k] - 1), k))
    return have


def _size(text: str) -> F.Column:
    # runs of anything but the six white-space characters
    return F.when(F.col(text).isNull(), 0).otherwise(
        F.length(F.regexp_replace(F.col(text), "[^\\x20\\x09-\\x0D]+", "w"))
        - F.length(F.regexp_replace(F.col(text), "[^\\x20\\x09-\\x0D]+", ""))
    ).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The documents (without their text) with size, source_size, target and taken."""
    docs = docs.drop(*ADDED)
    whole = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"), "text")
    sized = staged(whole.select("doc", F.col("doc.source").alias("source"), _size("text").alias("size"), _place(seed)), "sizes")
    return _mixed(sized, sized, weights, seed).select("doc.*", *ADDED)


def materialize(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself: a row for each time a document is taken; columns as they were.

    A part of a document has the words of its chosen blocks in the order of the text,
    joined by one space; where all are chosen it is the text as it was.
    """
    whole = docs.select(F.struct("*").alias("doc"), "text")
    sized = whole.select("doc", "text", F.col("doc.source").alias("source"), _size("text").alias("size"), _place(seed))
    counted = staged(sized.select("source", "size", "place"), "sizes")
    mixed = _mixed(sized.drop("text"), counted, weights, seed).where("taken > 0")
    words = F.regexp_extract_all("doc.text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    piece = lambda own, p: F.slice(own, (p["start"] + 1).cast("int"), p["words"].cast("int"))
    # bound by a lambda of its own, so that a text is cut into words once and not for each part
    pieces = F.transform(F.array(words), lambda own: F.flatten(F.transform("parts", lambda p: piece(own, p))))[0]
    copies = F.concat(
        F.array_repeat("doc.text", F.col("passes").cast("int")),
        F.when(F.col("some") == 0, F.array().cast("array<string>"))
        .when(F.col("some") == F.col("size"), F.array("doc.text"))
        .otherwise(F.array(F.array_join(pieces, " "))),
    )
    columns = [F.col(f"doc.{c}").alias(c) for c in docs.columns if c != "text"]
    return mixed.select(*columns, F.explode(copies).alias("text")).select(*docs.columns)


def _place(seed: int) -> F.Column:
    return F.xxhash64(F.lit(seed), F.col("doc.doc_id"), F.col("text")).alias("place")


def _mixed(docs: DataFrame, counted: DataFrame, weights: tuple[int, ...], seed: int) -> DataFrame:
    """The columns added, and what ``taken`` consists of: ``passes`` over all words of the
    document, then ``parts`` (start and number of words, ``some`` in all).

    docs: source, size, place and more; counted: the same three columns, cheap to read.
    """
    sources = _sources(counted, weights)
    shards = staged(_shards(_in_shards(counted, sources), seed), "shards")
    placed = _in_shards(docs, sources).join(shards, ["number", "shard"])
    order = Window.partitionBy("number", "shard").orderBy("place", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = placed.withColumn("low", before).withColumn("high", F.col("low") + F.col("size"))
    own = F.sequence(F.floor(F.col("low") / F.col("block")), F.floor((F.col("high") - 1) / F.col("block")))
    chosen = F.filter(own, lambda j: (j * F.col("step") + F.col("offset")) % F.col("blocks") < F.col("extra"))
    start = lambda j: F.greatest(j * F.col("block"), F.col("low"))
    part = lambda j: F.struct(
        (start(j) - F.col("low")).alias("start"),
        (F.least((j + 1) * F.col("block"), F.col("high")) - start(j)).alias("words"),
    )
    none = F.array().cast("array<struct<start: bigint, words: bigint>>")
    taking = (F.col("size") > 0) & (F.col("extra") > 0)
    with_parts = at.withColumn("parts", F.when(taking, F.transform(chosen, part)).otherwise(none))
    some = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return with_parts.withColumn("some", some).select(
        "doc", "size", "source_size", "target", "passes", "parts", "some",
        (F.col("passes") * F.col("size") + F.col("some")).alias("taken"),
    )


def _sources(counted: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """A row a source: its number, size, target, seats, and the bits of its shards' numbers."""
    sums = counted.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).collect()
    sums.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.words for r in sums]
    cycle = [weights[k % len(weights)] for k in range(len(sums))]
    wanted = targets(sizes, cycle, BUDGET * sum(sizes)) if any(sizes) else [Fraction(0)] * len(sums)
    least = min((w for w in wanted if w), default=Fraction(1))
    block = max(1, min(BLOCK_WORDS, int(least / 1000)))
    quotas = seats(wanted, int(sum(wanted) / block + Fraction(1, 2)))
    rows = [
        (r.source, k, r.words, float(want), quota, (max(0, r.docs - 1) // SHARD_DOCS).bit_length(), block)
        for k, (r, want, quota) in enumerate(zip(sums, wanted, quotas))
    ]
    schema = "source string, number int, source_size long, target double, quota long, bits int, block long"
    return counted.sparkSession.createDataFrame(rows, schema)


def _in_shards(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with their source's row and their shard's number: the place's first bits."""
    named = sources.withColumnRenamed("source", "of_source")
    shard = F.when(F.col("bits") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftrightunsigned(place, 64 - bits)"))
    return docs.join(named, docs["source"].eqNullSafe(named["of_source"])).withColumn("shard", shard)


def _shards(docs: DataFrame, seed: int) -> DataFrame:
    """How each shard takes its quota of its source's seats: number, shard, blocks, passes, extra, step, offset."""
    leaves = docs.groupBy("number", "shard").agg(
        F.sum("size").alias("words"), *[F.first(c).alias(c) for c in ("quota", "bits", "block")]
    )
    leaves = staged(leaves, "shard-sums")
    levels = max(1, -(-(leaves.agg(F.max("bits")).first()[0] or 0) // FAN_BITS))
    given = leaves.select("number", F.lit(0).cast("long").alias("parent"), "quota").distinct()
    for below in reversed(range(levels)):
        node = F.shiftright("shard", below * FAN_BITS)
        nodes = leaves.groupBy("number", node.alias("node"), "block").agg(F.sum("words").alias("words"))
        nodes = nodes.withColumn("parent", F.shiftright("node", FAN_BITS)).join(
            given.select("number", "parent", "quota"), ["number", "parent"]
        )
        given = nodes.groupBy("number", "parent").applyInPandas(
            _apportioned, "number int, parent long, words long, block long, quota long"
        )
    return given.select("number", F.col("parent").alias("shard"), "words", "block", "quota").mapInPandas(
        lambda frames: (_selection(frame, seed) for frame in frames),
        "number int, shard long, blocks long, passes long, extra long, step long, offset long",
    )


def _apportioned(nodes: pd.DataFrame) -> pd.DataFrame:
    """The quota of a node's at most ``FAN`` children, which are the next level's parents."""
    nodes = nodes.sort_values("node")
    own = seats([int(n) for n in nodes.words], int(nodes.quota.iloc[0]))
    return pd.DataFrame(
        {"number": nodes.number, "parent": nodes.node, "words": nodes.words, "block": nodes.block, "quota": own}
    )


def _selection(shards: pd.DataFrame, seed: int) -> pd.DataFrame:
    rows = []
    for number, shard, words, block, quota in shards.itertuples(index=False):
        blocks = max(1, -(-int(words) // int(block)))
        passes, extra = divmod(min(int(quota), MOST_TIMES * blocks), blocks)
        digest = hashlib.blake2b(f"{seed}:{number}:{shard}".encode(), digest_size=16).digest()
        step, offset = (int.from_bytes(half, "little") % blocks for half in (digest[:8], digest[8:]))
        step += 1
        while gcd(step, blocks) > 1:
            step += 1
        rows.append((number, shard, blocks, passes, extra, step, offset))
    return pd.DataFrame(rows, columns=["number", "shard", "blocks", "passes", "extra", "step", "offset"])
