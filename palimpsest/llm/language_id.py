"""Language of each word by a linear-chain conditional random field, also in mixed text.

Emissions are sums of learned weights of a word's affixes, byte n-grams and, as its
lexicon entry, the word itself; transitions between languages are learned too.
Forward-backward gives each word's probability of each language; a document's
language has the largest sum over its words, its score is that sum's share.

The model is trained in numpy on the driver, on a bounded sample: up to
``ROWS_PER_LANGUAGE`` different labelled rows of each of the ``LANGUAGES`` most frequent
languages, chosen by hash, ``SEGMENTS`` runs of
``SEGMENT`` words of each at places chosen by hash. Every other training sequence
joins runs of two languages, which is where changes of language are learned from.

``fits`` tells texts of the learned languages, mixed or not, from others and from
gibberish: whether a text's words speak for some language about as clearly as training
words do. The fewer words, the lower the bound, so short texts are seldom refused.

Null texts and texts without letters are ``und`` with score 0 and do not fit, as is everything if
no row is labelled. Labels are never read for a prediction. Input columns called like
those added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.words import column, grams, has_letters, kinds, lowered, mix, slices, words_of

#: Rows of each language, and the languages, that training uses: the most frequent ones.
ROWS_PER_LANGUAGE, LANGUAGES = 500, 200
SEGMENTS = 3
SEGMENT = 24
SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
STEPS = 40
UNKNOWN = "und"
#: Share of what words of the learned languages stand out, below which a text is of none.
FITTING = 0.6
BLOCK = 64
SLICE_BYTES = 1 << 18


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that no training may see: a third, by the checksum of their ids."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % 3 == 1, F.lit(False))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, labels = lowered(column(batch, "text")), column(batch, "lang").to_pylist()
        langs, found = [], []
        for low, high in slices(texts):
            words = words_of(texts[low:high])
            for k in range(high - low):
                first, last = int(words.first[k]), int(words.first[k + 1])
                if first == last:
                    continue
                seeds = mix(np.arange(SEGMENTS, dtype=np.uint64) + np.uint64(last - first), 41)
                spots = seeds % np.uint64(max(1, last - first - SEGMENT + 1))
                for spot in np.unique(spots).astype(int):
                    stop = min(last, first + spot + SEGMENT)
                    langs.append(labels[low + k])
                    found.append(bytes(words.data[words.starts[first + spot] : words.ends[stop - 1]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(found, pa.binary()).cast(pa.string())], names=["lang", "text"]
        )


class Tagger:
    """Weights, transitions and the posteriors they give; how far words of the languages stand out.

    ``least`` is the mean, ``spread`` the deviation, of ``standing_out`` over the training
    words of the language where the one is smallest and the other largest.
    """

    def __init__(
        self, languages: list[str], weights: np.ndarray, transitions: np.ndarray, least: float = 0.0, spread: float = 0.0
    ):
        self.languages, self.weights, self.transitions = languages, weights, transitions
        self.least, self.spread = least, spread

    @staticmethod
    def standing_out(emissions: np.ndarray) -> np.ndarray:
        """How much more a word speaks for one language than for the average one."""
        return emissions.max(axis=1) - emissions.mean(axis=1)

    def fits(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Whether texts, of so many words that stand out so far in sum, have a learned language's words."""
        words = np.maximum(words, 1)
        return total / words >= FITTING * self.least - 3 * self.spread / np.sqrt(words)

    def emissions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        owner, feature = grams(data, starts, ends, SIZES, BUCKETS)
        sums = [np.bincount(owner, w[feature], len(starts)) for w in self.weights.T]
        return np.stack(sums, axis=1) / np.sqrt(np.bincount(owner, minlength=len(starts)))[:, None]

    def posteriors(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Forward-backward over all documents at once, exact.

        Documents are cut into blocks of BLOCK words. The product of a block's
        transfer matrices carries the messages from block to block.
        """
        langs = len(self.languages)
        step = np.exp(self.transitions - self.transitions.max())
        scaled = np.exp(np.maximum(emissions - emissions.max(axis=1, keepdims=True), -50))
        lengths = np.diff(first)
        blocks = -(-lengths // BLOCK)
        doc = np.repeat(np.arange(len(lengths)), blocks)
        head = np.cumsum(blocks) - blocks
        ordinal = np.arange(len(doc)) - head[doc]
        at = (first[:-1][doc] + ordinal * BLOCK)[:, None] + np.arange(BLOCK)
        inside = at < first[1:][doc][:, None]
        x = scaled[np.minimum(at, len(scaled) - 1)]
        product = np.broadcast_to(np.eye(langs), (len(doc), langs, langs)).copy()
        for t in range(BLOCK):
            after = (product @ step) * x[:, t, None, :]
            after /= after.max(axis=(1, 2), keepdims=True)
            product = np.where(inside[:, t, None, None], after, product)
        before = np.full((len(doc), langs), 1 / langs)
        behind = np.ones((len(doc), langs))
        order = np.argsort(-blocks, kind="stable")
        counts = blocks[order]
        most = int(counts[0]) if len(counts) else 0
        for k in range(most - 1):
            b = head[order[: np.searchsorted(-counts, -k - 1)]] + k
            out = np.einsum("bi,bij->bj", before[b], product[b])
            before[b + 1] = out / out.sum(axis=1, keepdims=True)
        for k in range(most - 1, 0, -1):
            b = head[order[: np.searchsorted(-counts, -k)]] + k
            out = np.einsum("bij,bj->bi", product[b], behind[b])
            behind[b - 1] = out / out.sum(axis=1, keepdims=True)
        forward = np.empty_like(x)
        for t in range(BLOCK):
            after = (before @ step) * x[:, t]
            before = np.where(inside[:, t, None], after / after.sum(axis=1, keepdims=True), before)
            forward[:, t] = before
        for t in range(BLOCK - 1, -1, -1):
            forward[:, t] *= behind
            after = (x[:, t] * behind) @ step.T
            behind = np.where(inside[:, t, None], after / after.sum(axis=1, keepdims=True), behind)
        out = forward[inside]
        return out / out.sum(axis=1, keepdims=True)


def _sequences(segments: list[tuple[str, str]], index: dict[str, int], rng) -> tuple[list, np.ndarray]:
    words, labels = [], []
    for lang, text in segments:
        own = text.encode().split()
        while len(own) < SEGMENT:
            own += own[: SEGMENT - len(own)]
        words.append(own)
        labels.append([index[lang]] * SEGMENT)
    order = rng.permutation(len(words))
    alone, their = list(words), list(labels)  # as they were: a joined one is never joined on
    for one, other in zip(order[: len(order) // 2], rng.permutation(len(words))):
        cut = int(rng.integers(1, SEGMENT))
        words[one] = alone[one][:cut] + alone[other][cut:]
        labels[one] = their[one][:cut] + their[other][cut:]
    return words, np.array(labels)


def fit(segments: list[tuple[str, str]], seed: int = 0) -> Tagger:
    """Maximise the likelihood of the sequences' labels with Adam."""
    rng = np.random.default_rng(seed)
    segments = sorted(segments)
    languages = sorted({lang for lang, _ in segments})
    index = {lang: k for k, lang in enumerate(languages)}
    langs = len(languages)
    words, labels = _sequences(segments, index, rng)
    flat = [w for own in words for w in own]
    types, inverse = np.unique(np.array(flat, object), return_inverse=True)
    data = np.frombuffer(b"".join(types), np.uint8)
    ends = np.cumsum([len(w) for w in types])
    starts = ends - [len(w) for w in types]
    owner, feature = grams(data, starts, ends, SIZES, BUCKETS)
    scale = 1 / np.sqrt(np.bincount(owner, minlength=len(types)))
    inverse = inverse.reshape(labels.shape)
    truth = np.eye(langs)[labels]
    pairs = np.zeros((langs, langs))
    np.add.at(pairs, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
    values = [np.zeros((BUCKETS, langs)), np.zeros((langs, langs))]
    slow = [np.zeros_like(v) for v in values]
    squares = [np.zeros_like(v) for v in values]
    for turn in range(1, STEPS + 1):
        weights, transitions = values
        by_type = np.stack([np.bincount(owner, w[feature], len(types)) for w in weights.T], 1) * scale[:, None]
        scores = by_type[inverse]
        x = np.exp(scores - scores.max(axis=2, keepdims=True))
        step = np.exp(transitions)
        forward, behind = np.empty_like(x), np.empty_like(x)
        message = np.full((len(x), langs), 1 / langs)
        for t in range(SEGMENT):
            message = (message @ step) * x[:, t]
            message /= message.sum(axis=1, keepdims=True)
            forward[:, t] = message
        message = np.ones((len(x), langs))
        expected = np.zeros((langs, langs))
        for t in range(SEGMENT - 1, -1, -1):
            behind[:, t] = message
            right = x[:, t] * message
            if t:
                both = forward[:, t - 1, :, None] * step * right[:, None, :]
                expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            message = right @ step.T
            message /= message.sum(axis=1, keepdims=True)
        posterior = forward * behind
        posterior /= posterior.sum(axis=2, keepdims=True)
        wrong = (posterior - truth).reshape(-1, langs)
        by_type = np.stack([np.bincount(inverse.ravel(), w, len(types)) for w in wrong.T], 1) * scale[:, None]
        slopes = [
            np.stack([np.bincount(feature, w[owner], BUCKETS) for w in by_type.T], 1) / len(flat) + 1e-6 * weights,
            (expected - pairs) / len(flat) + 1e-4 * transitions,
        ]
        for v, m, s, slope in zip(values, slow, squares, slopes):
            m += 0.1 * (slope - m)
            s += 0.01 * (slope**2 - s)
            v -= 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.99**turn)) + 1e-9)
    tagger = Tagger(languages, *values)
    out = tagger.standing_out(tagger.emissions(data, starts, ends))[inverse].ravel()
    each = [out[labels.ravel() == k] for k in range(langs)]
    each = [x for x in each if len(x)]
    tagger.least, tagger.spread = float(min(x.mean() for x in each)), float(max(x.std() for x in each))
    return tagger


def train(docs: DataFrame) -> Tagger | None:
    """A tagger from the documents that are not held out; None if none is labelled."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        "doc_id", "text", "lang"
    )
    places = F.xxhash64("doc_id", "text")
    labelled = labelled.select("lang", "text", places.alias("place"))
    frequent = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    languages = [r.lang for r in frequent.collect()]
    if not languages:
        return None
    # the least hash of each of some slots: copies of a row are one, and none but these go to the driver
    slot = F.pmod("place", F.lit(4 * ROWS_PER_LANGUAGE))
    least = labelled.where(F.col("lang").isin(languages)).groupBy("lang", slot).agg(F.min("place").alias("place"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    picked = least.select("lang", "place", rank.alias("rank")).where(F.col("rank") <= ROWS_PER_LANGUAGE)
    keys = docs.sparkSession.createDataFrame([(r.lang, r.place) for r in picked.collect()], "lang string, place long")
    own = labelled.join(F.broadcast(keys), ["lang", "place"])  # at most LANGUAGES * ROWS_PER_LANGUAGE keys
    chosen = own.groupBy("lang", "place").agg(F.first("text").alias("text"))
    segments = chosen.mapInArrow(_segments, "lang string, text string").collect()
    return fit([(r.lang, r.text) for r in segments]) if segments else None


def _predicted(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    tagger: Tagger | None = model.value
    for batch in batches:
        texts = lowered(column(batch, "doc").field("text"))
        letters = column(batch, "letters").to_numpy(zero_copy_only=False)
        for low, high in slices(texts, SLICE_BYTES):
            langs = np.full(high - low, UNKNOWN, object)
            scores, fits = np.zeros(high - low), np.zeros(high - low, bool)
            words = words_of(texts[low:high])
            if tagger and len(words.starts):
                spot, inverse = kinds(words.hashes())
                own = tagger.emissions(words.data, words.starts[spot], words.ends[spot])
                posterior = tagger.posteriors(own[inverse], words.first)
                votes = has_letters(words)
                doc = np.repeat(np.arange(high - low), np.diff(words.first))[votes]
                sums = np.stack([np.bincount(doc, p, high - low) for p in posterior[votes].T], axis=1)
                totals = sums.sum(axis=1)
                good = letters[low:high].astype(bool) & (totals > 0)
                best = sums.argmax(axis=1)
                langs[good] = np.array(tagger.languages, object)[best[good]]
                scores[good] = np.clip(sums.max(axis=1)[good] / totals[good], 0, 1)
                out = np.bincount(doc, tagger.standing_out(own)[inverse][votes], high - low)
                fits = good & tagger.fits(out, np.bincount(doc, minlength=high - low))
            kept = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [column(kept, "doc"), pa.array(langs.tolist(), pa.string()), pa.array(scores), pa.array(fits)],
                names=["doc", "lang_pred", "score", "fits"],
            )


def predict(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``fits``."""
    docs = docs.drop("lang_pred", "score", "fits")
    whole = docs.select(F.struct("*").alias("doc"))
    model = docs.sparkSession.sparkContext.broadcast(tagger)
    schema = T.StructType(
        [
            T.StructField("doc", whole.schema["doc"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("fits", T.BooleanType()),
        ]
    )
    letters = F.coalesce(F.col("doc.text").rlike("\\p{L}"), F.lit(False)).alias("letters")
    rows = whole.select("doc", letters).mapInArrow(lambda it: _predicted(it, model), schema)
    return rows.select("doc.*", "lang_pred", "score", "fits")
