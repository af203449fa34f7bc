"""The learned operators and the pipeline's stages, on data made for them."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import language_id, minhash_dedup, mixing, sharding, toxicity
from palimpsest.llm.queries import QUERIES
from palimpsest.workspace import ship_library

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
#: A word's language is its first letter.
PARTS = {
    lang: [f"{lang}{x}{y}" for x in letters for y in letters]
    for lang, letters in (("b", "aeiou"), ("k", "lmnpr"), ("s", "tvwxz"))
}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_joined_sequences_keep_each_words_own_language():
    rng = np.random.default_rng(2)
    segments = [(lang, " ".join(rng.choice(own, rng.integers(1, 30)))) for lang, own in PARTS.items() for _ in range(200)]
    cut = [(lang, " ".join(text.split()[: language_id.SEGMENT])) for lang, text in segments]
    before = list(cut)
    words, labels = language_id._sequences(cut, {lang: k for k, lang in enumerate(PARTS)}, rng)
    names = list(PARTS)
    assert all(len(own) == language_id.SEGMENT for own in words) and cut == before
    assert all(names[k] == w.decode()[0] for own, row in zip(words, labels) for w, k in zip(own, row))
    assert 0.3 < np.mean([len(set(row)) > 1 for row in labels.tolist()]) < 0.7


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, text string, lang string")


def test_training_rows_are_bounded(spark, monkeypatch):
    ship_library(spark)
    own = np.random.default_rng(3)
    rows = [(f"x{k}", " ".join(own.choice(PARTS["b"], 30)), f"lang{k % 50:02d}") for k in range(400)]
    rows += [("same", " ".join(PARTS["k"]), "k")] * 500 + [(f"s{k}", " ".join(own.choice(PARTS["s"], 30)), "s") for k in range(90)]
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda segments: seen.extend(segments))
    monkeypatch.setattr(language_id, "ROWS_PER_LANGUAGE", 4)
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    language_id.train(labelled(spark, rows))
    counts = {lang: sum(own == lang for own, _ in seen) for lang, _ in seen}
    assert set(counts) == {"k", "s", "lang00"} or len(counts) == 3 and {"k", "s"} < set(counts)
    assert counts["k"] <= language_id.SEGMENTS and max(counts.values()) <= 4 * language_id.SEGMENTS


def test_language_query_on_whole_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    known = {d.lang for d in docs.values()} - {None}
    right = []
    for r in rows:
        text = docs[r.doc_id].text or ""
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1
        assert r.lang_pred in known if any(c.isalpha() for c in text) else r.lang_pred == "und"
        if r.held_out and docs[r.doc_id].lang:
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert np.mean(right) > 0.98


def stage_rows(spark):
    own = np.random.default_rng(4)
    rows = [(f"{lang}{k}", " ".join(own.choice(words, 60)), lang) for lang, words in PARTS.items() for k in range(60)]
    mixed = [" ".join(" ".join(own.choice(words, 40)) for words in PARTS.values()) for _ in range(20)]
    letters = list("bcdfghjklmnpqrstvwxyz")
    gibberish = [" ".join("".join(own.choice(letters, own.integers(4, 9))) for _ in range(60)) for _ in range(20)]
    other = ["".join(chr(0x4E00 + int(x)) + " " * int(x % 3 == 0) for x in own.integers(0, 5000, 200)) for _ in range(20)]
    rows += [(f"mixed{k}", text, None) for k, text in enumerate(mixed)]
    rows += [(f"short{k}", PARTS["k"][k], None) for k in range(9)]
    rows += [(f"odd{k}", text, None) for k, text in enumerate(gibberish + other)]
    return rows + [("null", None, None), ("empty", "", None), ("signs", "12 -- 7", None), ("b0", rows[0][1], "b")]


def test_language_stage_rejects_what_no_language_fits(spark):
    ship_library(spark)
    left = corpus_pipeline.identify_language(spark, labelled(spark, stage_rows(spark)), SF).collect()
    kept = [r.doc_id for r in left]
    assert sorted(x for x in kept if not x.startswith("odd")) == sorted(
        x for x, _, _ in stage_rows(spark) if not x.startswith(("odd", "null", "empty", "signs"))
    )
    assert not [x for x in kept if x.startswith("odd")]
    assert {r.lang for r in left if r.doc_id.startswith("short")} == {"k"}
    assert all(r.lang == r.doc_id[0] for r in left if r.doc_id[0] in PARTS and not r.doc_id.startswith("short"))


def test_clean_documents_stay_in_the_language_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = corpus_pipeline.identify_language(spark, docs, SF)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert left.select("doc_id", "text", "source", "n_chars").exceptAll(docs.select("doc_id", "text", "source", "n_chars")).isEmpty()


# ------------------------------------------------------------------ toxicity


VOCABULARY = np.array([f"{a}{b}{c}" for a in ("ta", "re", "on", "il") for b in ("mu", "sel", "po", "dri", "na") for c in ("ve", "ko", "st", "ing", "")])


def made(rng, cues, toxic, clean):
    """Toxic documents with some of their own class's cues, and clean ones."""
    rows = []
    for own, count in zip(cues, toxic):
        for _ in range(count):
            words = list(rng.choice(VOCABULARY, rng.integers(60, 200)))
            for spot in rng.integers(0, len(words), 4):
                words[spot] = rng.choice(own)
            rows.append((" ".join(words), 1))
    return rows + [(" ".join(rng.choice(VOCABULARY, rng.integers(60, 200))), 0) for _ in range(clean)]


CUES = (["idiotel", "scumrat", "worthlos", "disgustop"], [f"bomente{x}" for x in ("ra", "go", "ta", "es")])


def scores(scorer, texts, spark):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return np.array([r.score for r in toxicity.score(frame, scorer).orderBy("doc_id").collect()])


def test_rare_cues_are_learned_too(spark):
    ship_library(spark)
    rng = np.random.default_rng(6)
    train = made(rng, CUES, (200, 20), 800)
    scorer = toxicity.fit(*map(list, zip(*train)))
    for own in CUES:
        found = scores(scorer, [t for t, _ in made(rng, [own], [60], 0)], spark) >= toxicity.TOXIC
        assert found.mean() >= 0.85
    assert (scores(scorer, [t for t, _ in made(rng, CUES, (0, 0), 300)], spark) >= toxicity.TOXIC).mean() <= 0.03
    unseen = [" ".join([*VOCABULARY[:30], word, *VOCABULARY[30:60]]) for word in ("bomenteraa", "Bomentego!!!", "idiotell", "IDIOTEL##")]
    assert (scores(scorer, unseen, spark) > scores(scorer, [" ".join(VOCABULARY[:60])], spark)).all()


def test_other_samples_give_the_same_recall(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = sorted(
        tuple(r)
        for r in docs.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
        .where("toxic is not null and text is not null").select("doc_id", "text", "toxic", "lang").collect()
    )
    tests = [r for r in rows if held_out(r[0])]
    train = [r for r in rows if not held_out(r[0]) and len(r[1].split()) <= 600]
    toxic, lang = np.array([r[2] for r in tests]), np.array([r[3] for r in tests])
    recalls = []
    for seed in range(3):
        rng = np.random.default_rng(seed)
        own = [r for r in train if rng.random() < 0.9]
        found = scores(toxicity.fit([r[1] for r in own], [r[2] for r in own]), [r[1] for r in tests], spark) >= toxicity.TOXIC
        assert found[toxic == 0].mean() <= 0.03
        for name in ("de", "en", "es", "fr"):
            assert found[(toxic == 1) & (lang == name)].mean() >= 0.85
        recalls.append(found[toxic == 1].mean())
    assert max(recalls) - min(recalls) <= 0.05


def test_toxicity_query_scores_each_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scorer = toxicity.train(docs.select("doc_id", "text"), labels)
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert rows.keys() == texts.keys()
    ids = sorted(texts)[::7]
    vector = scorer.grams
    for i in ids:
        words = [w.strip("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())) or w for w in texts[i].lower().split()]
        each = []
        for w in words:
            data = np.frombuffer(w.encode(), np.uint8)
            _, feature = toxicity.grams(data, np.array([0]), np.array([len(data)]), toxicity.SIZES, toxicity.BUCKETS)
            each.append(vector[feature].mean())
        best = max((np.mean(each[k : k + toxicity.SEGMENT]) for k in range(0, len(each), toxicity.SEGMENT)), default=0.0)
        score = 1 / (1 + np.exp(-(best + scorer.bias)))
        assert rows[i].score == pytest.approx(score, abs=1e-9)
        assert rows[i].predicted == int(rows[i].score >= 0.7) and rows[i].held_out == held_out(i)


# ---------------------------------------------------------- the other stages


def test_every_row_is_placed_by_its_hash(spark):
    rows = QUERIES["op6_sharding"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    table = sharding.fill()
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(sharding.SLOTS)).alias("slot")
    want = {r.doc_id: (r.slot, sharding.SHARDS[table[r.slot]]) for r in docs.select("doc_id", slot).collect()}
    assert {r.doc_id: (r.slot, r.shard) for r in rows} == want and len(rows) == docs.count()


def test_near_duplicates_equal_all_pairs(spark):
    ship_library(spark)
    rng = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(40):
        base = list(rng.choice(vocabulary, rng.integers(6, 90)))
        texts.append(base)
        for _ in range(rng.integers(0, 5)):
            own = list(base)
            for _ in range(rng.integers(0, 4)):
                own[rng.integers(0, len(own))] = rng.choice(vocabulary)
            texts.append(own[rng.integers(0, 2) :])
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame).collect()}
    items = [minhash_dedup.shingles(np.array([zlib.crc32(w.encode()) for w in t], np.uint64)) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if texts[a] == texts[b] or (len(items[a]) and len(items[b]) and minhash_dedup.similar(items[a], items[b])):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    assert found == dict(enumerate(group)) and len(set(group)) < len(texts)


def test_mix_comes_near_its_targets(spark):
    rows = QUERIES["op10_mixing"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes = {i: len((d.text or "").split()) for i, d in docs.items()}
    assert {r.doc_id: r.size for r in rows} == {i: n for i, n in sizes.items()} and all(0 <= r.taken <= 2 * r.size for r in rows)
    sources = sorted({d.source for d in docs.values()}, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    total = {s: sum(n for i, n in sizes.items() if docs[i].source == s) for s in sources}
    target, open_, left = {}, set(sources), 1.5 * sum(total.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * total[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_ -= over
    for s in sources:
        own = [r for r in rows if docs[r.doc_id].source == s]
        assert own[0].target == pytest.approx(target[s]) and own[0].source_size == total[s]
        assert abs(sum(r.taken for r in own) - target[s]) <= max(30, 0.01 * target[s])
    again = {r.doc_id: r.taken for r in mixing.mix(spark.read.parquet(f"{SF}/documents.parquet").repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_stages_handle_odd_rows(spark):
    ship_library(spark)
    base = [(k, f"tamuve resel{k} onpo ildri " * 30, "en", "s", 100) for k in range(30)]
    rows = [*base, *base[:2], (None, base[3][1], None, None, None), (50, None, None, None, None), (51, "", "en", "s", 0),
            (52, "la " * 20_000, None, "t", 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        found = out.collect()
        if name != "byte_bpe":
            assert out.columns == docs.columns
        if name == "minhash_near_dedup":
            assert sum(r.doc_id in (0, 1) for r in found) == 2
        if name == "byte_bpe":
            assert len(found) == len(rows) and {r.n_tokens for r in found if r.doc_id in (50, 51)} == {0}


def test_many_shards_get_their_seats_down_a_tree(spark, monkeypatch):
    ship_library(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    sums = {r.source: r for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()}
    monkeypatch.setattr(mixing, "SHARD_DOCS", 2)
    monkeypatch.setattr(mixing, "FAN_BITS", 2)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    for source, row in sums.items():
        taken = sum(r.taken for r in rows if r.source == source)
        assert abs(taken - row.t) <= max(30, 0.02 * row.t)
    words = mixing.materialize(docs).select("doc_id", F.explode(F.split(F.trim("text"), "[ \t-\r]+")).alias("w")).where("w <> ''")
    counted = {r.doc_id: r["count"] for r in words.groupBy("doc_id").count().collect()}
    assert counted == {r.doc_id: r.taken for r in rows if r.taken}


@pytest.mark.parametrize("blocks", [1, 2, 9, 64, 1000])
def test_chosen_blocks_are_as_many_as_the_quota(blocks):
    for quota in {0, 1, blocks // 2, blocks, blocks + 1, 2 * blocks, 3 * blocks}:
        row = mixing._selection(pd.DataFrame([(3, 5, blocks * 64 - 1, 64, quota)], columns=list("abcde")), 17).iloc[0]
        chosen = sum((j * row.step + row.offset) % blocks < row.extra for j in range(blocks))
        assert row.blocks == blocks and row.passes * blocks + chosen == min(quota, 2 * blocks)
