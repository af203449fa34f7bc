"""Each operator against brute force, with nulls, empty and long texts, ties and repeats."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from palimpsest.llm import (
    byte_bpe, embedding_neardup, language_id, minhash_dedup, mixing, sharding, substring_dedup, token_output,
    topk_search, toxicity,
)
from palimpsest.llm.queries import ORACLE, QUERIES
from palimpsest.workspace import ship_library

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
RNG = np.random.default_rng(7)
VOCABULARY = np.array([f"w{k}" for k in range(400)])


def prose(words):
    return " ".join(RNG.choice(VOCABULARY, words))


PASSAGE, LONG = prose(60), prose(30_000)
TEXTS = [
    None, "", " \t\n", "one", "one", "a b c", PASSAGE, PASSAGE, "head " + PASSAGE + " tail", prose(80) + "\n" + PASSAGE,
    LONG, "la " * 200, "don't  stop\r\n\r\nit's 12½ naïve 漢字 😀 <|endoftext|>", prose(300),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `size` string, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    ship_library(spark)
    rows = [(k, t, "en" if k % 2 else None, None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "x", "y")
            for k, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, PASSAGE + " x", "en", "s1", 1, None, None), (99, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_substring_dedup(docs, none):
    got = substring_dedup.remove_repeats(docs)
    assert set(docs.columns) <= set(got.columns)
    rows = [WORD.findall(r.text or "") for r in docs.collect()]
    counts = collections.Counter(tuple(w[k : k + 35]) for w in rows for k in range(len(w) - 34))
    expected = collections.Counter()
    for words in rows:
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - 34):
            gone[k : k + 35] |= counts[tuple(words[k : k + 35])] > 1
        expected[len(words), int(gone.sum()), " ".join(np.array(words, object)[~gone])] += 1
    assert collections.Counter((r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == expected
    assert substring_dedup.remove_repeats(none).count() == 0


def test_texts_of_one_32_bit_hash_and_no_id(spark):
    ship_library(spark)
    texts = [" ".join(f"{side}{k}" for k in range(40)) for side in "ab"]
    numbers = spark.range(250_000)
    one, other = (numbers.select(F.concat("id", F.lit(" " + x)).alias(f"t{k}")) for k, x in enumerate(texts))
    same = one.join(other, F.hash("t0") == F.hash("t1")).select("t0", "t1").first()
    rows = [(None, same.t0), (None, same.t1), (1, "x " + texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r.text: r.n_removed for r in substring_dedup.remove_repeats(frame).collect()}
    assert cut == {same.t0: 40, same.t1: 0, "x " + texts[0]: 40}
    apart = spark.createDataFrame(rows[:2], "doc_id long, text string")
    assert {r.text for r in minhash_dedup.keep_one(apart).collect()} == {same.t0, same.t1}


def test_near_duplicates(spark, docs, none):
    base = prose(200).split()
    edited = list(base)
    edited[50] = "edited"
    other = prose(200).split()
    far = [w if k % 9 else "x" + w for k, w in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(edited)), (4, " ".join(other)), (5, " ".join(far)),
            (6, None), (7, ""), (8, ""), (2, " ".join(base)), (9, "a b c"), (10, "a b c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 9}
    kept = minhash_dedup.keep_one(frame)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 8, 9]
    every = minhash_dedup.keep_one(docs)
    assert every.columns == docs.columns and every.where("doc_id = 6").count() == 1
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_of_few_words(spark):
    rows = []
    for k in range(0, 600, 2):
        words = [f"p{k}x{n}" for n in range(9 + k // 2 % 3)]  # 5, 6 or 7 shingles
        rows += [(k, " ".join(words)), (k + 1, " ".join(words[1:] if k % 4 else words[:-1]))]
    ship_library(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame).collect()}
    assert found == {k: k - k % 2 for k in range(600)}


def test_sketches_of_short_and_longer_pairs_meet():
    for n in (5, 6, 7, 10, 15, 39, 40, 41, 42, 50, 60):
        for _ in range(200):
            items = RNG.integers(0, 2**63, n, np.uint64)
            fewer = np.delete(items, RNG.choice(n, n // 5, replace=False))
            assert np.isin(minhash_dedup.sketches(items), minhash_dedup.sketches(fewer)).any()


def test_alignment_is_exact_at_the_threshold():
    def longest(a, b):
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        return table[-1, -1]

    for _ in range(300):
        a = RNG.integers(0, 9, RNG.integers(1, 30)).astype(np.uint32)
        b = a[RNG.random(len(a)) < 0.9] if RNG.random() < 0.7 else RNG.integers(0, 9, 20).astype(np.uint32)
        m = longest(a, b)
        assert minhash_dedup.similar(a, b) == (10 * m >= 8 * (len(a) + len(b) - m))


def test_embedding_near_duplicates(spark):
    base = RNG.normal(size=(120, 16))
    near = base[:60] + RNG.normal(size=(60, 16)) * 0.04
    vectors = [(k, v.tolist(), k % 2) for k, v in enumerate(np.vstack([base, near, near[:3], base[:2] * 3]))]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] + [1.0] * 15, 1),
           (904, base[0].tolist(), None), (905, [], 1), (906, [1.0], 1), (907, [2.0], 1), (0, vectors[0][1], 0)]
    rows = vectors + odd
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ship_library(spark)
    got = embedding_neardup.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    units = [None if v is None or l is None or not v or None in v or not np.isfinite(v).all() or not any(v)
             else (np.array(v) / np.linalg.norm(v), l) for _, v, l in rows]
    linked = np.array([[a is not None and b is not None and i != j and a[1] == b[1] and len(a[0]) == len(b[0])
                        and a[0] @ b[0] >= 0.98 for j, b in enumerate(units)] for i, a in enumerate(units)])
    root = embedding_neardup._roots(linked)
    least = {r: min(rows[k][0] for k in np.flatnonzero(root == r)) for r in set(root.tolist())}
    expected = sorted((rows[k][0], int(linked[k].sum()), least[root[k]]) for k in range(len(rows)))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == expected
    assert embedding_neardup.near_duplicates(frame.limit(0)).count() == 0


def test_filters_of_a_large_table_hold_near_vectors():
    words = round((120_000_000 * embedding_neardup.FILTERS / embedding_neardup.FILTER_NODES) ** (1 / embedding_neardup.BLOCKS))
    own = np.random.default_rng(11)
    a, b = own.normal(size=(2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    shared = np.zeros(len(a), bool)
    for seed in range(embedding_neardup.CODES):
        code = embedding_neardup.ProductCode(64, words, seed)
        one, other = (code.decode(x)[1].reshape(len(x), -1) for x in (a, b))
        shared |= (one[:, :, None] == other[:, None, :]).any(axis=(1, 2))
    assert shared.all()


def test_top_k(spark):
    vectors = [(k, RNG.integers(-2, 3, 6).astype(float).tolist()) for k in range(300)]
    vectors += [(300, None), (301, [float("inf")] * 6), (302, [None] * 6), (303, [1.0]), (320, vectors[0][1]), (17, vectors[3][1])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    ship_library(spark)
    got = topk_search.top_k(frame, frame.where("vec_id % 20 = 0"))
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got.collect()}
    good = [(k, np.floor(64 * np.array(v)).astype(int)) for k, v in vectors if v and None not in v and np.isfinite(v).all()]
    for query, q in good:
        if query % 20 == 0:
            scores = sorted((-int(q @ v), k) for k, v in good if k != query and len(v) == len(q))[:20]
            assert [found[query, r + 1] for r in range(len(scores))] == [(k, -s) for s, k in scores]
    assert topk_search.top_k(frame.limit(0), frame.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1, 900, 1e7, 1e12])
def test_top_k_in_many_blocks_and_levels(spark, monkeypatch, scale):
    ship_library(spark)
    for name, value in (("BLOCK_BYTES", 500), ("SHARD_ROWS", 3), ("FAN", 2), ("CELLS", 7)):
        monkeypatch.setattr(topk_search, name, value)
    vectors = [(k, (np.round(RNG.normal(size=5), 1) * scale).tolist()) for k in range(260)]
    vectors += [(1000 + k, vectors[k][1]) for k in range(30)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = topk_search.top_k(frame, frame.where("vec_id % 40 = 0"), k=6).collect()
    good = [(k, [int(np.floor(64 * x)) for x in v]) for k, v in vectors]
    expected = set()
    for query, q in good:
        if query % 40 == 0:
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), k) for k, v in good if k != query)
            expected |= {(query, n, k, -s) for n, (s, k) in enumerate(scores[:6], 1)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)


def test_byte_bpe(docs, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = byte_bpe.encode(docs.select("doc_id", "text", F.col("text").alias("was")))
    for row in byte_bpe.decode(pieces).collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == own.encode_ordinary(row.was or "")
        assert bytes(row.decoded).decode() == (row.was or "") and row.n_tokens * 4 == len(row.ids)
    both = {r.doc_id: r for r in byte_bpe.digests(docs).collect()}
    assert both[10].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert byte_bpe.digests(none).count() == 0


def test_perfect_hash_is_minimal():
    words = byte_bpe.vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    assert sorted(words.slot_entry.tolist()) == list(range(len(words.ids)))


def test_sharding(docs, none):
    table = sharding.fill(("a", "b", "c"), 101)
    assert sorted(np.bincount(table).tolist()) == [33, 34, 34]
    claimed, at = {}, {n: 0 for n in "abc"}
    while len(claimed) < 101:
        for n in "abc":
            offset, step = sharding.preference(n, 101)
            while (slot := (offset + at[n] * step) % 101) in claimed:
                at[n] += 1
            claimed[slot] = n
            if len(claimed) == 101:
                break
    assert [claimed[k] for k in range(101)] == ["abc"[k] for k in table]
    placed = sharding.place(docs, "doc_id")
    assert placed.count() == docs.count() and placed.select("doc_id", "shard").distinct().count() == 16
    assert sharding.place(none, "doc_id").count() == 0
    with pytest.raises(ValueError):
        sharding.fill(("a",), 100)


def test_code_lengths_are_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 0])
    assert token_output.code_lengths(counts).tolist() == [7, 7, 6, 5, 4, 3, 2, 1, 0]
    lengths = token_output.code_lengths(counts, 4)
    assert lengths.max() <= 4 and sum(2.0 ** -int(x) for x in lengths if x) == 1
    ids = RNG.integers(0, 8, 5000)
    bits, steps = token_output.pack(ids, lengths, token_output.canonical(lengths))
    assert (token_output.Decoder(lengths).unpack(bits, steps, len(ids)) == ids).all()


def test_token_files(docs, none):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, []
    rows = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect())
    for known, doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        expected.append((doc_id if known else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((r.start, r) for r in token_output.round_trip(docs).collect())
    assert [(r.doc_id, s, r.n_tokens, r.ids_crc32) for s, r in got] == expected
    assert token_output.round_trip(none).count() == 0


def test_mixing(docs, none):
    assert mixing.targets([100, 10, 10], [5, 2, 1], 180) == [140, 20, 20]
    for wanted, total in (([50, 30, 20], 10), ([1, 1, 1], 2), ([7, 0, 5], 31)):
        have = [0] * len(wanted)
        for _ in range(total):
            best = max(range(len(wanted)), key=lambda k: (wanted[k] / (2 * have[k] + 1), -k))
            have[best] += 1
        assert mixing.seats(wanted, total) == have
    got = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in got) == sorted(len(WORD.findall(r.text or "")) for r in docs.collect())
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert all(r.source_size == sum(x["size"] for x in own) and r.target <= 2 * r.source_size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(64, 0.01 * own[0].target)
        assert all(r.taken <= 2 * r["size"] for r in own)
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(1.5 * sum(r["size"] for r in got))
    assert sorted(mixing.mix(docs).collect(), key=str) == sorted(got, key=str)
    taken = sum(r.taken for r in got)
    texts = mixing.materialize(docs)
    assert texts.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in texts.collect()) == taken
    assert mixing.mix(none).count() == 0 and mixing.materialize(none).count() == 0


def test_language_id(docs, none):
    german, french = (["der", "und", "nicht", "ung", "keit"], ["le", "que", "tion", "eux", "ment"])
    segments = [(lang, " ".join(RNG.choice(own, 24))) for lang, own in (("de", german), ("fr", french)) for _ in range(40)]
    tagger = language_id.fit(segments)
    texts = [None, "", "123 !!", " ".join(german * 50), "que eux " * 10 + "und der nicht " * 9, LONG]
    frame = docs.sparkSession.createDataFrame([(k, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in language_id.predict(frame, tagger).collect()}
    assert [got[k].lang_pred for k in range(5)] == ["und", "und", "und", "de", "de"]
    assert got[3].score > 0.9 > got[4].score > 0.5 and 0 <= got[5].score <= 1
    e, first = RNG.normal(size=(300, 2)), np.array([0, 0, 3, 200, 300])
    posterior = tagger.posteriors(e, first)
    step = np.exp(tagger.transitions)
    for a, b in zip(first[:-1], first[1:]):
        f, g = np.full(2, 0.5), [np.ones(2)]
        forward = []
        for t in range(a, b):
            f = (f @ step) * np.exp(e[t])
            f /= f.sum()
            forward.append(f)
        for t in range(b - 1, a, -1):
            m = step @ (np.exp(e[t]) * g[-1])
            g.append(m / m.sum())
        for t, (x, y) in enumerate(zip(forward, g[::-1]), a):
            assert posterior[t] == pytest.approx(x * y / (x * y).sum(), abs=1e-9)
    assert language_id.train(none) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_toxicity(docs, none):
    toxic = [" ".join([*RNG.choice(VOCABULARY, 20), "nastyword", *RNG.choice(VOCABULARY, 20)]) for _ in range(300)]
    scorer = toxicity.fit(toxic + [prose(41) for _ in range(600)], [1] * 300 + [0] * 600)
    rows = [(0, prose(500)), (1, prose(300) + " nastyword " + prose(300)), (2, prose(9) + " naastyword " + prose(9)), (3, None), (4, "")]
    frame = docs.sparkSession.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.predicted, r.score) for r in toxicity.score(frame, scorer).collect()}
    assert [got[k][0] for k in range(5)] == [0, 1, 1, 0, 0] and all(0 <= s <= 1 for _, s in got.values())
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    assert toxicity.train(docs, labels) is None
    assert toxicity.score(none, scorer).count() == 0


def test_toxicity_learns_from_long_documents(spark, monkeypatch):
    ship_library(spark)
    own = np.random.default_rng(5)
    rows = []
    for k in range(120):
        words = list(own.choice(VOCABULARY, 610 if k % 3 == 0 else 60))
        rows.append((k, " ".join(words + ["nastyword"] * 20 * (k % 3 == 0)), int(k % 3 == 0)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = labelled.drop("toxic"), labelled.drop("text")
    found = toxicity.train(docs, labels)
    tests = spark.createDataFrame([(0, prose(99)), (1, prose(99) + " nastyword" * 4)], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score(tests, found).orderBy("doc_id").collect()] == [0, 1]
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: seen.extend(zip(toxic, texts)))
    monkeypatch.setattr(toxicity, "ROWS_PER_CLASS", 1)
    toxicity.train(docs, labels)  # room for 600 toxic words: the shortest document, cut
    assert [len(text.split()) for toxic, text in seen if toxic] == [600]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    from checks.compare import connect, differences

    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ""


def test_pipeline(spark, docs, none):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "minhash_near_dedup", "substring_dedup", "mixing", "byte_bpe"
    ]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.n_tokens * 4 == len(r.ids) for r in rows)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, none, SF).columns == none.columns
        assert stage(spark, none, SF).count() == 0


def test_language_stage_keeps_mixed_text(spark):
    ship_library(spark)
    own = np.random.default_rng(3)
    parts = {lang: [f"{x}{y}" for x in letters for y in letters] for lang, letters in (("a", "bcdfg"), ("b", "klmnp"), ("c", "rstvz"))}
    rows = [(f"{lang}{k}", " ".join(own.choice(words, 60)), lang) for lang, words in parts.items() for k in range(60)]
    mixed = " ".join(" ".join(own.choice(words, n)) for words, n in zip(parts.values(), (80, 60, 60)))
    frame = spark.createDataFrame([*rows, ("mixed", mixed, None), ("none", "12 -- 7", None)], "doc_id string, text string, lang string")
    left = {r.doc_id for r in corpus_pipeline.identify_language(spark, frame, SF).collect()}
    assert left == {x for x, _, _ in rows} | {"mixed"}
