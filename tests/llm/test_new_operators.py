"""Personal data, periodic runs and whitening against brute force."""

import hashlib
import math
import re
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as driver
from palimpsest.llm import personal_data, run_detection, whitening

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    # columns that clash with what the operators return
    return frame.withColumns({c: F.lit("x") for c in ("spans", "runs", "score", "n_words", "start")})


# ------------------------------------------------------------- personal data


def plain_base(text):
    """The rules, word for word."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [2 * d if k % 2 else d for k, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(k, s, e) for s, k, e in sorted(found)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0149 .-+@a_(é", max_size=60))
def test_base_spans_are_those_of_the_rules(text):
    assert personal_data.base_spans(text) == plain_base(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "4111-1111-1111-1111", "+1 (212) 555-0199", "10.0.0.1", "a.b@c.org",
                                 "a@b", "999.1.1.1", "0000000000000000", "12", "x"]), max_size=9),
       st.sampled_from([" ", ", ", "\n", "-"]))
def test_base_spans_of_crowded_data(parts, between):
    text = between.join(parts)
    assert personal_data.base_spans(text) == plain_base(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000):
        base = personal_data.base_spans(text)
        personal_data.candidates(text, base)


@pytest.fixture(scope="module")
def supervised(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = [(10**6 + k, f"we met call +1 (212) 555-01{k % 90 + 10} then 4{k:03d}") for k in range(60)]
    extra += [(2 * 10**6 + k, f"token = f{k * 7919:09d}ab{k * 104729:012d}c version {k}.2.3") for k in range(200)]
    return personal_data.train(docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")))


def test_query_has_the_base_spans_and_adds_crowded_ones(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = driver.queries()["op11_personal_data"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id] or "")
        written = [f"{personal_data.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in base) for n in range(4)]
        assert set(written) <= set(r.spans.split(","))


def test_spans_lost_by_the_rules_are_added(supervised):
    text = "reach +1 (605) 555-9305 4078918989542222 or 4665471787434696 86.227.24.100 an"
    assert personal_data.base_spans(text) == [(1, text.index("86."), len(text) - 3)]
    found = [(k, text[s:e]) for k, s, e, _ in personal_data.spans_of(text, supervised)]
    assert found == [(3, "+1 (605) 555-9305"), (2, "4078918989542222"), (2, "4665471787434696"), (1, "86.227.24.100")]


@pytest.mark.parametrize("text", [
    "", "plain words only", "token = f699e44f19092102589454a79f5d9b63", "version 1.2.3", "in 2019, 12 of 345 pages",
    "4000000000000000 is no card", "a @ b", "page 1234567",
])
def test_clean_text_stays_clean(supervised, text):
    assert personal_data.spans_of(text, supervised) == []


def test_reliabilities_are_found():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    cast = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    cast[rng.random(cast.shape) < 0.2] = personal_data.ABSTAINS
    patterns, which, counts = np.unique(cast, axis=0, return_inverse=True, return_counts=True)
    likely, chances, share = personal_data.posteriors(patterns, counts)
    assert abs(share - 0.3) < 0.02
    assert np.abs(chances[:, 1, 1] / chances[:, 1, :2].sum(axis=1) - right).max() < 0.03
    assert ((likely[which.ravel()] > 0.5) == truth).mean() > 0.95


def test_personal_data_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a@b.org"), (3, "x" * 500_000 + " a@b.org"), (3, "x" * 500_000 + " a@b.org"),
            (4, "é a@b.org")]
    docs = documents(spark, rows)
    found = personal_data.digests(personal_data.find(docs, personal_data.train(docs))).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in found) == [
        (0, "email:0:7"), (1, ""), (2, ""), (3, "email:500001:500008"), (3, "email:500001:500008"), (4, "email:2:9")]
    empty = documents(spark, [])
    assert personal_data.find(empty, personal_data.train(empty)).count() == 0


# ------------------------------------------------------------- periodic runs


def plain_runs(words):
    """Every period, every stretch."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            if words[start] != words[start + q]:
                start += 1
                continue
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            size = stop + q - start
            smaller = any(
                all(words[k] == words[k + p] for k in range(start, stop + q - p)) for p in range(1, q)
            ) if size >= max(6, 4 * q) else True
            if not smaller:
                found.append((start, size, q))
            start = stop
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = [
        hashlib.sha256(x.encode()).hexdigest()
        for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(w for k, w in enumerate(words) if k not in gone))
    ]
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def runs_of(texts):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    low, high, q = run_detection.runs_of(np.array([x for t in texts for x in t], np.int64), first)
    doc = np.searchsorted(first, low, "right") - 1
    return [[(int(a - first[k]), int(b - a), int(p)) for a, b, p, d in zip(low, high, q, doc) if d == k] for k in range(len(texts))]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


piece = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=11), st.integers(1, 9))
text_of_pieces = st.lists(piece, max_size=5).map(lambda parts: [x for own, times in parts for x in own * times])
plain_text = st.lists(st.integers(0, 2), max_size=120)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(text_of_pieces, plain_text), min_size=1, max_size=4))
def test_runs_are_those_of_brute_force(texts):
    texts = texts + texts[:1]  # a copy shares its rules
    assert runs_of(texts) == [plain_runs(t) for t in texts]


def test_runs_of_hard_words():
    thue_morse = [bin(k).count("1") & 1 for k in range(3000)]
    nested = ([1] * 5 + [2]) * 6 + [3]
    for text in (thue_morse, fibonacci(400), nested * 5, [1] * 300, [1, 2] * 150 + [1], list(range(300)) * 4):
        assert runs_of([text]) == [plain_runs(text) if len(text) < 2000 else []]


def test_small_steps_change_nothing(monkeypatch):
    text = ([1, 2, 3, 4, 5, 6, 7, 8, 9, 9] * 9 + [5]) * 3
    whole = runs_of([text])
    for name, value in (("TOGETHER", 3), ("LITTLE", 10**9)):
        monkeypatch.setattr(run_detection, name, value)
        assert runs_of([text]) == whole == [plain_runs(text)]


def test_rules_spell_the_text():
    rng = np.random.default_rng(3)
    items = np.concatenate([rng.integers(0, 4, 500), np.tile(rng.integers(0, 4, 20), 30)])
    grammar = run_detection.repair(items, 4, np.array([0, 700, len(items)]))
    words = [[k] for k in range(4)]
    for left, right in zip(grammar.left, grammar.right):
        words.append(words[left] + words[right])
    assert [w for s in grammar.rest for w in words[s]] == items.tolist()
    assert [len(w) for w in words] == grammar.size.tolist()
    assert len(grammar.rest) < len(items) / 3


def test_run_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 20000")
    extra = documents(spark, [(10**7 + k, "to be or not " * (k % 30) + "that is " * 7) for k in range(60)])
    rows = docs.select("doc_id", "text").union(extra.select("doc_id", "text")).collect()
    found = run_detection.digests(spark.createDataFrame(rows, "doc_id long, text string"), loop=True).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == {d: plain_digest(d, t) for d, t in rows}
    whole = driver.queries()["op12_run_detection"](spark, SF)
    assert whole.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_run_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a a a a a a"), (3, " a\ta\na a a  a b"), (3, " a\ta\na a a  a b"), (4, "ab " * 20_000)]
    found = run_detection.digests(documents(spark, rows), loop=True).collect()
    assert sorted((r.doc_id or 0, *tuple(r)[1:]) for r in found) == sorted(
        (d or 0, *plain_digest(d, t)) if d != 4 else (4, *tuple(r for r in found if r.doc_id == 4)[0][1:]) for d, t in rows
    )
    long = next(r for r in found if r.doc_id == 4)
    assert (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (1, 0, 20_000, 1, 20_000_000)
    assert long.collapsed_sha256 == hashlib.sha256(b"ab").hexdigest()
    assert run_detection.digests(documents(spark, [])).count() == 0


# ----------------------------------------------------------------- whitening


def plain_whitening(rows, count=4):
    usable = [(i, np.array(v, float)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in usable), default=0)
    x = np.array([np.pad(np.floor(256 * v), (0, width - len(v))) for _, v in usable]).astype(np.int64).reshape(len(usable), width)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / max(n, 1)
    values, axes = np.linalg.eigh(centred.T @ centred / max(n, 1))
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    deviations = [int(sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums))) for v in x]
    return [i for i, _ in usable], n, deviations, values, axes, x - sums / max(n, 1), np.trace(centred.T @ centred / max(n, 1))


def compare(spark, rows, expected_components):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit("x"))
    found = whitening.components(frame).collect()
    ids, n, deviations, values, axes, centred, trace = plain_whitening(rows)
    assert len(found) == len(ids) * expected_components
    by_row = {(r.vec_id, r.component): r for r in found}
    for at, i in enumerate(ids):
        for k in range(expected_components):
            r = by_row[i, k + 1]
            assert (r.n, r.deviation) == (n, deviations[at])
            assert r.explained == pytest.approx(values[k] / trace, rel=1e-9)
            assert r.identity_error <= 1e-9
    return by_row, ids, axes, values, centred


def test_components_equal_a_dense_decomposition(spark):
    rng = np.random.default_rng(1)
    spread = np.array([5, 4, 3.5, 3, 1, 0.9, 0.5, 0.2, 0.1, 0.05, 0.02, 0.01])
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(rng.normal(size=(700, 12)) * spread + 3)]
    rows += [(1000 + k, rows[0][1]) for k in range(300)]  # copies count once
    by_row, ids, axes, values, centred = compare(spark, rows, 4)
    for k in range(4):
        own = np.array([by_row[i, k + 1].whitened for i in ids])
        want = centred @ axes[:, k] / np.sqrt(values[k])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-9


def test_equal_deviations_are_not_lost(spark):
    sizes = [8, 8, 5, 5, 5, 1, 1, 0.5]
    rows = [(2 * k + s, (np.eye(8)[k] * size * (1 - 2 * s)).tolist()) for k, size in enumerate(sizes) for s in (0, 1)]
    by_row, ids, axes, values, centred = compare(spark, rows, 4)
    own = np.array([[by_row[i, k + 1].whitened for k in range(4)] for i in ids])
    assert np.abs(own.T @ own / len(ids) - np.eye(4)).max() < 1e-9


@pytest.mark.parametrize("rows, components", [
    ([], 0),
    ([(1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [float("inf")])], 0),
    ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], 0),
    ([(1, []), (2, [])], 0),
    ([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [5.0, 2.0])], 1),
    ([(1, [1.0]), (2, [1.0, 4.0]), (3, []), (1, [2.0, 1.0]), (4, None)], 2),
])
def test_whitening_edge_cases(spark, rows, components):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    if len({i for i, _ in rows}) == len(rows):
        compare(spark, rows, components)
    usable = len(plain_whitening(rows)[0])
    assert whitening.components(frame).count() == usable * components


def test_staged_blocks_are_deleted(spark):
    from palimpsest.workspace import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:")) / "palimpsest"
    before = set(folder.glob("whitening-*"))
    frame = spark.createDataFrame([(k, [float(k), 1.0 / (k + 1)]) for k in range(9)], "vec_id long, embedding array<float>")
    assert whitening.fit(whitening.on_grid(frame)).passes > 0
    assert set(folder.glob("whitening-*")) == before


def test_deviations_beyond_64_bits_are_null():
    big = np.array([[2**40, 0], [1, 1]])
    assert whitening._deviations(big, 1000, [2**40 + 1, 1]) == [None, None]
    assert whitening._deviations(np.array([[2**20, 0]]), 2800, [5, 7]) == [(2800 * 2**20 - 5) ** 2 + 49]


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = driver.queries()["op13_whitening"](spark, SF).collect()
    ids, n, deviations, values, axes, centred, trace = plain_whitening(rows)
    expected = dict(zip(ids, zip(deviations, centred)))
    assert len(found) == 4 * len(ids)
    signs = {}
    for r in found:
        deviation, own = expected[r.vec_id]
        k = r.component - 1
        want = own @ axes[:, k] / np.sqrt(values[k])
        sign = signs.setdefault(k, np.sign(want * r.whitened))
        assert (r.n, r.deviation) == (n, deviation)
        assert r.whitened == pytest.approx(sign * want, abs=1e-8)
        assert r.explained == pytest.approx(values[k] / trace, rel=1e-9) and r.identity_error < 1e-9
