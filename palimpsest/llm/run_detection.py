"""Periodic runs of words, found in a grammar instead of in the text.

A run is a stretch of consecutive words with smallest period q, at least
``max(LEAST_WORDS, LEAST_PERIODS * q)`` long, that no neighbouring word extends.

1. The words of some documents (a slice) get numbers, and Re-Pair makes a grammar of
   them: in rounds, pairs of neighbours become one nonterminal, those first that are
   more frequent than any pair they overlap. Copies in a slice share their rules. Rounds
   end when one replaces little; what is left of a document is joined by a balanced tree.
2. Every nonterminal is a text cut in two. The runs that cross the cut are computed once
   for each nonterminal, wherever and however often it occurs: each has two periods or
   more on one side, so its period is a distance at which the words beside the cut return
   (up to ``SHORT`` words: each distance is tried; beyond, equal runs of ``SHORT`` words
   are looked up). How far the period reaches is a binary search over hashes of prefixes,
   and then checked word by word.
3. Nonterminals hand their runs to all places of the derivation, top down. A run of a
   document lies whole in the lowest node that holds it, and crosses its cut. What other
   nodes found of it are parts, and go when intervals of one period are merged.

Words are told apart by 64-bit hashes. A null text has no words. A document is always in
one slice, whole, and memory follows the slice (``SLICE_BYTES`` of text, or one longer
document). Repeated rows are documents of their own. Rows without an id are not looped.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.words import Words, column, hash_runs, mix, slices, words_of

LEAST_WORDS, LEAST_PERIODS = 6, 4
SHORT = 8
SLICE_BYTES = 1 << 20
#: Re-Pair ends with a round that shortens the slice by less than one part in this many.
LITTLE = 256
#: Candidates that are looked at together.
TOGETHER = 1 << 20
_BASE = 0x9E6C63D0876A9A47


@dataclass
class Grammar:
    """Rules in the order of their rounds, and what is left of the text."""

    left: np.ndarray  # of each rule its two symbols; symbols below ``words`` are words
    right: np.ndarray
    size: np.ndarray  # of each symbol, in words
    where: np.ndarray  # of each rule one place in the text
    rounds: list[int]  # the first rule of each round; one more at the end
    words: int
    rest: np.ndarray  # symbols
    rest_at: np.ndarray  # their places in the text


def repair(items: np.ndarray, words: int, first: np.ndarray) -> Grammar:
    """Re-Pair over items numbered below ``words``; no pair crosses a document's start.

    Pairs are ranked by how often they occur. In a round every place is replaced whose
    pair ranks above both that overlap it, of equal ones (``a a a``) every other one.
    """
    rest, at = items.astype(np.int64), np.arange(len(items))
    ends = np.zeros(len(items) + 1, bool)
    ends[first] = True
    left, right, where, rounds = [], [], [], [0]
    sizes = [np.ones(words, np.int64)]
    symbols, size_of = words, sizes[0]
    while len(rest) > 1:
        inside = ~ends[at[1:]]
        keys = rest[:-1] * symbols + rest[1:]
        keys[~inside] = -1
        kind, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        counts[kind < 0] = 0
        rank = np.empty(len(kind), np.int64)
        rank[np.lexsort((kind, -counts))] = np.arange(len(kind), 0, -1)
        rank[counts < 2] = 0
        own = np.concatenate([[0], rank[inverse], [0]])
        best = (own[1:-1] > 0) & (own[1:-1] >= own[:-2]) & (own[1:-1] >= own[2:])
        start = best & ~np.concatenate([[False], best[:-1]])  # of neighbouring places, so equal ones
        spots = np.flatnonzero(best)
        if not len(spots):
            break
        spots = spots[(spots - np.maximum.accumulate(np.where(start, np.arange(len(best)), 0))[spots]) % 2 == 0]
        used = np.bincount(inverse[spots], minlength=len(kind))
        spots = spots[used[inverse[spots]] > 1]
        if len(spots) * LITTLE < len(rest):
            break
        which, spot, rule = np.unique(inverse[spots], return_index=True, return_inverse=True)
        place = spots[spot]
        left.append(rest[place])
        right.append(rest[place + 1])
        where.append(at[place])
        sizes.append(size_of[rest[place]] + size_of[rest[place + 1]])
        size_of = np.concatenate([size_of, sizes[-1]])
        rest[spots] = symbols + rule
        symbols += len(which)
        rounds.append(rounds[-1] + len(which))
        keep = np.ones(len(rest), bool)
        keep[spots + 1] = False
        rest, at = rest[keep], at[keep]
    none = [np.empty(0, np.int64)]
    return Grammar(*(np.concatenate(x or none) for x in (left, right)), size_of, np.concatenate(where or none),
                   rounds, words, rest, at)


class Text:
    """Hashes of all prefixes, to compare stretches of the text."""

    def __init__(self, items: np.ndarray):
        self.items, self.codes = items, mix(items.astype(np.uint64), 77)
        power = np.full(len(items) + 1, _BASE, np.uint64)
        power[0] = 1
        self.power = np.cumprod(power, dtype=np.uint64)
        self.sums = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(self.codes * self.power[:-1], out=self.sums[1:])

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from a and from b, which is not before a, are equal."""
        one = (self.sums[a + size] - self.sums[a]) * self.power[b - a]
        return one == self.sums[b + size] - self.sums[b]

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from a and from b are equal."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(a, b, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before a and before b are equal."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(a - middle, b - middle, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def _smallest_factors(most: int) -> np.ndarray:
    factor = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if factor[p] == p:
            own = factor[p * p :: p]
            own[own == np.arange(p * p, most + 1, p)] = p
    return factor


class Crossing:
    """Runs that cross the cuts of nodes: node, start, end and period of each."""

    def __init__(self, items: np.ndarray):
        self.text = Text(items)
        self.grams = hash_runs(self.text.codes, SHORT)
        self.order = np.argsort(self.grams, kind="stable")
        ranked = self.grams[self.order]
        self.spot = np.empty(len(ranked), np.int64)
        self.spot[self.order] = np.arange(len(ranked))
        edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.empty(0, int)
        group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(ranked))))
        self.begin, self.end = edge[group], np.append(edge[1:], len(ranked))[group]  # by rank

    def find(self, start: np.ndarray, cut: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        found = []
        for q in range(1, SHORT):
            # every node's own distance, to the right and to the left of its cut
            node = np.flatnonzero(end - cut >= 2 * q)
            node = node[self.text.items[cut[node]] == self.text.items[cut[node] + q]]
            found.append(self._checked(start, cut, end, node, cut[node], np.full(len(node), q)))
            node = np.flatnonzero(cut - start >= 2 * q)
            node = node[self.text.items[cut[node] - 1] == self.text.items[cut[node] - 1 - q]]
            found.append(self._checked(start, cut, end, node, cut[node] - 2 * q, np.full(len(node), q)))
        for right in (True, False):
            room = (end - cut if right else cut - start) // 2
            node = np.flatnonzero(room >= SHORT)
            place = cut[node] if right else cut[node] - SHORT
            rank = self.spot[place]
            lone = self.end[rank] - self.begin[rank] == 1
            node, place, rank = node[~lone], place[~lone], rank[~lone]
            # occurrences at a distance of at most ``room``: those next to the own rank
            if right:
                low, high = rank + 1, self._last(rank, place + room[node])
            else:
                low, high = self._first(rank, place - room[node]), rank
            count = np.maximum(high - low, 0)
            parts = np.cumsum(count)
            at = 0
            while at < len(node):
                done = parts[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(parts, done + TOGETHER, "right")))
                own = np.repeat(np.arange(at, to), count[at:to])
                step = np.arange(len(own)) - np.repeat(parts[at:to] - count[at:to] - done, count[at:to])
                other = self.order[low[own] + step]
                q = np.abs(other - place[own])
                fits = q >= SHORT
                own, q = own[fits], q[fits]
                base = cut[node[own]] if right else cut[node[own]] - 2 * q
                found.append(self._checked(start, cut, end, node[own], base, q))
                at = to
        node, low, high, q = (np.concatenate(x) for x in zip(*found))
        if not len(node):
            return node, low, high, q
        order = np.lexsort((q, high, low, node))
        node, low, high, q = node[order], low[order], high[order], q[order]
        fresh = np.ones(len(node), bool)
        fresh[1:] = (np.diff(node) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0) | (np.diff(q) != 0)
        return node[fresh], low[fresh], high[fresh], q[fresh]

    def _last(self, rank: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The rank behind the last one of the own group whose place is within the limit."""
        low, high = rank + 1, self.end[rank]
        while (low < high).any():
            middle = (low + high) // 2
            within = self.order[np.minimum(middle, len(self.order) - 1)] <= limit
            within &= low < high
            low, high = np.where(within, middle + 1, low), np.where(within | (low >= high), high, middle)
        return low

    def _first(self, rank: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The first rank of the own group whose place is not before the limit."""
        low, high = self.begin[rank], rank
        while (low < high).any():
            middle = (low + high) // 2
            before = (self.order[middle] < limit) & (low < high)
            low, high = np.where(before, middle + 1, low), np.where(before | (low >= high), high, middle)
        return low

    def _checked(self, start, cut, end, node, base, q) -> tuple[np.ndarray, ...]:
        """Of candidates, two equal periods from ``base``, the runs that cross the cut."""
        text = self.text
        good = text.same(base, base + q, q)
        node, base, q = node[good], base[good], q[good]
        ahead = text.forward(base, base + q, end[node] - base - q)
        behind = text.backward(base, base + q, base - start[node])
        low, high = base - behind, base + q + ahead
        size = high - low
        good = (size >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)) & (low < cut[node]) & (high > cut[node])
        node, low, high, q = node[good], low[good], high[good], q[good]
        if not len(node):
            return node, low, high, q
        # the smallest period of a stretch of four periods divides them
        factor = _smallest_factors(int(q.max()))
        smallest, rest = np.ones(len(q), bool), q.copy()
        while (rest > 1).any():
            f = factor[rest]
            less = np.where(rest > 1, q // f, q)
            smallest &= ~((rest > 1) & text.same(low, low + less, high - low - less))
            rest = rest // np.maximum(f, 1)
        node, low, high, q = node[smallest], low[smallest], high[smallest], q[smallest]
        right = np.array([_is_run(text.items, a, b, p, start[k], end[k]) for k, a, b, p in zip(node, low, high, q)], bool)
        if not right.all():
            raise ArithmeticError("hashes of different stretches are equal")
        return node, low, high, q


def _is_run(items: np.ndarray, low: int, high: int, q: int, start: int, end: int) -> bool:
    """Word by word: the period holds, and neither neighbour inside the node keeps it."""
    if not np.array_equal(items[low : high - q], items[low + q : high]):
        return False
    before = low > start and items[low - 1] == items[low - 1 + q]
    return not (before or (high < end and items[high] == items[high - q]))


def _tree(grammar: Grammar, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, cut and end of the nodes that join what is left of each document."""
    edges = np.searchsorted(grammar.rest_at, first)
    stop = np.append(grammar.rest_at, first[-1])
    starts, cuts, ends = [], [], []
    most = int(np.diff(edges).max(initial=0))
    width = 1
    while width < most:
        counts = np.maximum(0, -(-(np.diff(edges) - width) // (2 * width)))  # nodes with a right half
        doc = np.repeat(np.arange(len(counts)), counts)
        ordinal = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        low = edges[doc] + ordinal * 2 * width
        starts.append(stop[low])
        cuts.append(stop[low + width])
        last = np.minimum(low + 2 * width, edges[doc + 1])
        ends.append(np.where(last == edges[doc + 1], first[doc + 1], stop[last]))
        width *= 2
    none = [np.empty(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (starts, cuts, ends))


def _placed(grammar: Grammar, node: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray):
    """The runs of rules at all places of the derivation: start, end, period."""
    count = len(grammar.left)
    own = np.bincount(node, minlength=count)
    holds = np.concatenate([np.zeros(grammar.words, bool), own > 0])
    for a, b in zip(grammar.rounds[:-1], grammar.rounds[1:]):
        holds[grammar.words + a : grammar.words + b] |= holds[grammar.left[a:b]] | holds[grammar.right[a:b]]
    offset, size = low - grammar.where[node], high - low
    begin = np.cumsum(own) - own
    kept = holds[grammar.rest]
    symbol, at = grammar.rest[kept], grammar.rest_at[kept]
    out = []
    for a in reversed(grammar.rounds[:-1]):
        now = symbol >= grammar.words + a
        rule, place = symbol[now] - grammar.words, at[now]
        each = np.repeat(np.arange(len(rule)), own[rule])
        run = begin[rule[each]] + np.arange(len(each)) - np.repeat(np.cumsum(own[rule]) - own[rule], own[rule])
        out.append((place[each] + offset[run], place[each] + offset[run] + size[run], q[run]))
        below = np.concatenate([grammar.left[rule], grammar.right[rule]])
        spots = np.concatenate([place, place + grammar.size[grammar.left[rule]]])
        kept = holds[below]
        symbol, at = np.concatenate([symbol[~now], below[kept]]), np.concatenate([at[~now], spots[kept]])
    none = [(np.empty(0, np.int64),) * 3]
    return tuple(np.concatenate(x) for x in zip(*(out or none)))


def runs_of(items: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of documents that begin at ``first``, in order.

    items: a number for each word; ``first`` has one more entry, the end.
    """
    if not len(items):
        return (np.empty(0, np.int64),) * 3
    kinds, items = np.unique(items, return_inverse=True)
    grammar = repair(items, len(kinds), first)
    begins, cuts, ends = _tree(grammar, first)
    rules = len(grammar.left)
    start = np.concatenate([grammar.where, begins])
    cut = np.concatenate([grammar.where + grammar.size[grammar.left], cuts])
    end = np.concatenate([grammar.where + grammar.size[grammar.words :], ends])
    node, low, high, q = Crossing(items).find(start, cut, end)
    of_rule = node < rules
    placed = _placed(grammar, *(x[of_rule] for x in (node, low, high, q)))
    low, high, q = (np.concatenate([x, y[~of_rule]]) for x, y in zip(placed, (low, high, q)))
    if not len(low):
        return low, high, q
    doc = np.searchsorted(first, low, "right")
    # parts of a run lie in it: of one document and period, ends then do not pass the furthest so far
    order = np.lexsort((-high, low, q, doc))
    doc, low, high, q = doc[order], low[order], high[order], q[order]
    change = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(q) != 0)])
    group = np.cumsum(change)
    furthest = np.maximum.accumulate(high + group * (int(first[-1]) + 1))
    fresh = change | np.concatenate([[True], furthest[1:] > furthest[:-1]])
    doc, low, high, q = doc[fresh], low[fresh], high[fresh], q[fresh]
    order = np.lexsort((q, low, doc))
    return low[order], high[order], q[order]


def looped(words: Words, checksums: list[int | None]) -> np.ndarray:
    """Which original word stands at each place: some documents repeat a part of theirs."""
    at = np.arange(len(words.starts))
    for k, h in enumerate(checksums):
        low, n = int(words.first[k]), int(words.first[k + 1] - words.first[k])
        if h is None or h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[low + a : low + n] = low + a + np.arange(n - a) % p
    return at


RUN = ("start", "length", "period")
SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def _detected(batches: Iterator[pa.RecordBatch], loop: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ids = column(batch, "text"), column(batch, "doc_id")
        for begin, stop in slices(texts, SLICE_BYTES):
            words = words_of(texts[begin:stop])
            own = ids[begin:stop].to_pylist()
            sums = [zlib.crc32(str(x).encode()) if loop and x is not None else None for x in own]
            at = looped(words, sums)
            low, high, q = runs_of(words.hashes()[at], words.first)
            gone = np.zeros(len(at) + 1, np.int64)
            np.add.at(gone, low + q, 1)
            np.add.at(gone, high, -1)
            kept = np.cumsum(gone)[:-1] == 0
            edges = np.searchsorted(low, words.first)
            base = np.repeat(words.first[:-1], np.diff(edges))
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (low - base, high - low, q)], names=list(RUN))
            data, left = words.data.tobytes(), []
            for k in range(stop - begin):
                a, b = int(words.first[k]), int(words.first[k + 1])
                part = np.flatnonzero(kept[a:b]) + a
                spots = at[part]
                pieces = zip(words.starts[spots].tolist(), words.ends[spots].tolist())
                left.append(b" ".join([data[s:e] for s, e in pieces]))
            yield pa.RecordBatch.from_arrays(
                [ids[begin:stop], pa.array(np.diff(words.first)),
                 pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs), pa.array(left, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def detect(docs: DataFrame, loop: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` by start and period, and the text without repeats.

    ``collapsed`` lacks each word that a run holds after its first period. With ``loop``
    one document in ten, by the checksum of its id, repeats a part of itself first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda it: _detected(it, loop), SCHEMA)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; of equals the first, then the one of the shorter period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for k, (runs, text) in enumerate(zip(column(batch, "runs").to_pylist(), column(batch, "collapsed"))):
            found = [tuple(r[c] for c in RUN) for r in runs]
            best = strongest(found) or (None, None, None)
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
            milli = 1000 * best[1] // best[2] if found else None
            digests = [hashlib.sha256(x).hexdigest() for x in (lines, memoryview(text.as_buffer()))]
            rows.append((len(found), *best, milli, *digests))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        columns = [pa.array(x, kind) for x, kind in zip(zip(*rows) if rows else [[]] * 7, kinds)]
        names = [x.split()[0] for x in DIGEST.split(", ")]
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *columns], names=names)


def digests(docs: DataFrame, loop: bool = False) -> DataFrame:
    """What ``detect`` found, one row a document: counts, the strongest run, digests."""
    return detect(docs, loop).mapInArrow(_digested, DIGEST)
