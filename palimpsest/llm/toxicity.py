"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its byte n-grams (and of itself, without the
signs around it), so an unseen misspelling shares most of them. The vectors of ``SEGMENT``
words are averaged and go through a linear softmax of two classes; a document scores as its
highest segment, so a few toxic words count alike in short and in long texts.

Embeddings and softmax are trained together, on the driver, on a bounded sample:
about ``ROWS_PER_CLASS`` toxic rows, and twice as many clean ones, that have at most ``SAMPLE_WORDS``
words, chosen by hash. A class of which these are fewer is filled up with the shortest of
its other labelled documents, whole, while all its words stay within ``SAMPLE_WORDS`` for
each row wanted; of a class that would have none, the shortest is cut to that.

Labels are of documents, and nobody says which segment is the toxic one. Training shares a
toxic document out among its segments, first evenly, then more and more to those that score
highest. Steps of an n-gram are divided by the root of how many documents hold it: then
the cues of a language with few labelled documents are learned as well as those of a
frequent one, and what one document alone holds does not explain its label away. Vectors
start from how surely an n-gram is more frequent in documents of one class.

Null texts and texts without words score what the softmax gives an empty bag. Without
labels of both classes every score is 0. Input columns called like those added are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.language_id import held_out
from palimpsest.llm.words import Words, column, grams, kinds, lowered, slices, words_of

ROWS_PER_CLASS = 600
SAMPLE_WORDS = 600
SEGMENT = 2
SIZES = (3, 4, 5)
BUCKETS = 1 << 18
DIMENSIONS = 8
STEPS = 80
#: Steps of the n-grams' vectors, of the softmax, of the bias; memory of earlier steps; decay.
STEP_LENGTHS, MOMENTUM, DECAY = (2.0, 0.002, 0.002), 0.9, 1e-3
#: How far the share of a segment follows its score, at the end.
ATTENTION = 4.0
#: Documents beside which an n-gram's own count: the rarest do not take the longest steps.
PSEUDO_DOCUMENTS = 3
#: Standard deviations by which counts of the classes differ before a vector starts off zero, and the start's scale.
SURELY, START = 1.96, 3.0
TOXIC = 0.7


class Scorer:
    """The toxic logit of each n-gram's vector, and of an empty bag."""

    def __init__(self, grams_: np.ndarray, bias: float):
        self.grams, self.bias = grams_, bias

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        owner, feature = grams(data, starts, ends, SIZES, BUCKETS)
        return np.bincount(owner, self.grams[feature], len(starts)) / np.bincount(owner, minlength=len(starts))


def _cut(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of documents: the first word of each, its document, its words' number."""
    lengths = np.diff(first)
    counts = -(-lengths // SEGMENT)
    doc = np.repeat(np.arange(len(lengths)), counts)
    ordinal = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    head = first[:-1][doc] + ordinal * SEGMENT
    return head, doc, np.minimum(SEGMENT, first[1:][doc] - head)


def _words(texts: pa.Array) -> Words:
    """Words in small letters, without the ASCII signs around them (signs alone stay)."""
    words = words_of(texts)
    if not len(words.starts):
        return words
    at, size = np.arange(len(words.data)), len(words.data)
    good = ~_SIGNS[words.data]
    last = np.maximum.accumulate(np.where(good, at, -1))
    following = np.minimum.accumulate(np.where(good, at, size)[::-1])[::-1]
    starts, ends = following[words.starts], last[words.ends - 1] + 1
    some = (starts < words.ends) & (ends > starts)
    return Words(words.data, np.where(some, starts, words.starts), np.where(some, ends, words.ends), words.first)


_SIGNS = np.zeros(256, bool)
_SIGNS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _documents_of(first: np.ndarray, inverse: np.ndarray, owner: np.ndarray, feature: np.ndarray, toxic: np.ndarray):
    """How many toxic and how many clean documents hold each n-gram."""
    kinds_ = int(inverse.max()) + 1
    order = np.argsort(owner, kind="stable")
    feature, counts = feature[order], np.bincount(owner, minlength=kinds_)
    begin = np.cumsum(counts) - counts
    found = np.zeros((2, BUCKETS))
    for k in range(len(toxic)):
        own = np.unique(inverse[first[k] : first[k + 1]])
        n = counts[own]
        spots = np.repeat(begin[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        found[toxic[k], np.unique(feature[spots])] += 1
    return found[1], found[0]


def _start(toxic_documents: np.ndarray, clean_documents: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """By how much more than chance an n-gram is more frequent in one class."""
    ratio, variance = 0.0, 0.0
    for sign, held, of in ((1, toxic_documents, toxic), (-1, clean_documents, clean)):
        ratio = ratio + sign * (np.log(held + 0.5) - np.log(of - held + 0.5))
        variance = variance + 1 / (held + 0.5) + 1 / (of - held + 0.5)
    surely = ratio / np.sqrt(variance)
    return np.sign(surely) * np.maximum(0, np.abs(surely) - SURELY)


def fit(texts: list[str], toxic: list[int], seed: int = 0) -> Scorer:
    rng = np.random.default_rng(seed)
    words = _words(lowered(pa.array(texts, pa.large_string())))
    toxic = np.array(toxic)
    if not len(words.starts):
        return Scorer(np.zeros(BUCKETS), 0.0)
    spot, inverse = kinds(words.hashes())
    owner, feature = grams(words.data, words.starts[spot], words.ends[spot], SIZES, BUCKETS)
    share = 1 / np.bincount(owner, minlength=len(spot))
    head, doc, size = _cut(words.first)
    positive = toxic[doc] == 1
    edges = np.flatnonzero(np.diff(doc, prepend=-1))
    counts = np.diff(np.append(edges, len(doc)))
    held = _documents_of(words.first, inverse, owner, feature, toxic)
    classes = int((toxic == 1).sum()), int((toxic == 0).sum())
    pace = (1 / np.sqrt(held[0] + held[1] + PSEUDO_DOCUMENTS))[:, None]
    out = rng.normal(size=DIMENSIONS)
    out /= np.linalg.norm(out)
    vectors = START * _start(*held, *classes)[:, None] * out
    slow, bias = np.zeros_like(vectors), -2.0
    for turn in range(STEPS):
        bags = (np.bincount(owner, (vectors @ out)[feature], len(spot)) * share)[inverse]
        logit = np.add.reduceat(bags, head) / size + bias
        below = logit - np.repeat(np.maximum.reduceat(logit, edges), counts)
        attention = ATTENTION * min(1, 2 * turn / STEPS)
        part = np.exp(np.maximum(attention * below, -50))
        part /= np.repeat(np.add.reduceat(part, edges), counts)
        # half the weight of a clean document is on its highest segment, the likeliest mistake
        weight = np.where(positive, part * classes[1] / max(1, classes[0]), 0.5 * ((below == 0) + part))
        wrong = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - positive) * weight
        to_word = np.bincount(inverse, np.repeat(wrong / size, size), len(spot)) * share
        slope = np.bincount(feature, to_word[owner], BUCKETS)
        slow = MOMENTUM * slow + (slope[:, None] * pace) * out
        pull = vectors.T @ slope / max(1, len(texts))
        vectors = (1 - DECAY) * vectors - STEP_LENGTHS[0] * slow
        out = out - STEP_LENGTHS[1] * pull / max(1e-12, np.abs(pull).max())
        bias -= STEP_LENGTHS[2] * wrong.sum()
    return Scorer(vectors @ out, float(bias))


def train(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """A scorer from the labelled documents that are not held out."""
    marked = labels.where(F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic")
    )
    marked = marked.where(~held_out("labelled"))
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    # twice as many clean rows; and not all rows are short enough
    wanted = {0: 3 * ROWS_PER_CLASS, 1: 1.5 * ROWS_PER_CLASS}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, wanted[k] / n))])
    place = F.pmod(F.xxhash64("labelled"), F.lit(1 << 30)) / float(1 << 30)
    chosen = marked.where(place < share[F.col("toxic")])
    short = F.size(F.split("text", "[\\x20\\x09-\\x0D]+")) <= SAMPLE_WORDS
    rows = (
        docs.join(chosen, docs["doc_id"] == chosen["labelled"])
        .where(F.col("text").isNotNull() & short)
        .select("labelled", "text", "toxic").collect()
    )
    rows = sorted(_filled_up(docs, marked, counts, [tuple(r) for r in rows]))
    if len({toxic for _, _, toxic in rows}) < 2:
        return None
    return fit([text for _, text, _ in rows], [toxic for _, _, toxic in rows])


def _filled_up(docs: DataFrame, marked: DataFrame, counts: dict[int, int], rows: list[tuple]) -> list[tuple]:
    """The rows, and the shortest other labelled documents of classes that have too few."""
    rows = list(rows)
    texts = docs.where(F.col("text").isNotNull())
    size = F.size(F.split("text", "[\\x20\\x09-\\x0D]+"))
    for kind, target in ((0, 2 * ROWS_PER_CLASS), (1, ROWS_PER_CLASS)):
        own = [(r[0], r[1]) for r in rows if r[2] == kind]
        if len(own) >= min(target, counts[kind]):
            continue
        budget = most = target * SAMPLE_WORDS
        budget -= sum(len(text.split()) for _, text in own)
        ids = marked.where(F.col("toxic") == kind).select("labelled").distinct()
        taken = {x for x, _ in own}
        sizes = texts.join(ids, texts["doc_id"] == ids["labelled"]).select("labelled", size.alias("size"))
        found = []
        for x, words in sizes.orderBy("size", "labelled").limit(target + len(own)).collect():
            if x in taken:
                continue
            if len(own) + len(found) >= target or (budget < words and (own or found)):
                break
            found.append(x)
            budget -= words
        if not found:
            continue
        chosen = texts.where(F.col("doc_id").isin(found)).select("doc_id", "text", size.alias("size"))
        # a text beyond all words wanted comes alone: a run of it, at a place chosen by hash
        start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.col("size") - most + 1, F.lit(1))).cast("int") + 1
        run = F.array_join(F.slice(F.split("text", "[\\x20\\x09-\\x0D]+"), start, F.lit(most)), " ")
        text = F.when(F.col("size") > most, run).otherwise(F.col("text"))
        rows += [(r.doc_id, r.text, kind) for r in chosen.select("doc_id", text.alias("text")).collect()]
    return rows


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    scorer: Scorer | None = model.value
    for batch in batches:
        texts = lowered(column(batch, "doc").field("text"))
        for low, high in slices(texts):
            logit = np.full(high - low, scorer.bias if scorer else -np.inf)
            words = _words(texts[low:high])
            if scorer and len(words.starts):
                spot, inverse = kinds(words.hashes())
                each = scorer.of_words(words.data, words.starts[spot], words.ends[spot])[inverse]
                head, doc, size = _cut(words.first)
                edges = np.flatnonzero(np.diff(doc, prepend=-1))
                segments = np.add.reduceat(each, head) / size + scorer.bias
                logit[doc[edges]] = np.maximum.reduceat(segments, edges)
            kept = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [column(kept, "doc"), pa.array(1 / (1 + np.exp(-np.clip(logit, -700, 700))))],
                names=["doc", "score"],
            )


def score(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """The documents with ``score`` and ``predicted``."""
    whole = docs.drop("score", "predicted").select(F.struct("*").alias("doc"))
    model = docs.sparkSession.sparkContext.broadcast(scorer)
    schema = T.StructType(
        [T.StructField("doc", whole.schema["doc"].dataType), T.StructField("score", T.DoubleType())]
    )
    rows = whole.mapInArrow(lambda it: _scored(it, model), schema)
    return rows.select("doc.*", "score", F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))
