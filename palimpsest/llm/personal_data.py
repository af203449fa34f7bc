"""Personal data by weak supervision: labelers vote, their reliability is estimated.

Base spans follow fixed rules (``base_spans``) and always stay. The rules lose what
stands close together: a card behind a phone number is swallowed by its digits, and both
fail. So wider patterns propose further candidates, and for each candidate six labelers
say yes, no or nothing: the base rule and a tight pattern (regular expressions), the
number's check, a gazetteer (issuers, calling codes, top-level domains, reserved nets),
the words before it, and what it is joined to.

Nobody labels spans by hand. For each kind, expectation-maximisation over how often each
pattern of votes occurs in all texts (Dawid and Skene's model) estimates how many
candidates are personal data and how far each labeler can be trusted. Its posteriors
train a logistic span classifier on votes, shape, length and neighbouring words, so it
can judge more than the votes. Of each pattern of votes it learns from up to
``ROWS_PER_PATTERN`` candidates, those with the least hashes. Candidates it gives
``SURE`` or more are added if they pass their number's check and overlap no base span
and none surer.

Null texts are empty. Positions are code points. A candidate that occurs many times over
counts each time; of its copies one is learned from. Without candidates nothing is added.
Only ``doc_id`` and ``text`` are read. All patterns take time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.words import column

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("base rule", "tight pattern", "check", "gazetteer", "words before", "joined")
ROWS_PER_PATTERN = 128
SURE = 0.9
BUCKETS = 1 << 14
ROUNDS, STEPS = 100, 300
YES, NO, ABSTAINS = 1, 0, 2

# The rules of base spans. Digits are taken whole, so no pattern goes back over them.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: What may be personal data, read more widely. Card groups may begin inside others.
_WIDE = {
    "ip": re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}"),
    "card": re.compile(r"(?<![0-9])(?=([0-9]{7,}+|[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}(?![0-9])))"),
    "phone": re.compile(
        r"(?:\+|(?<![0-9A-Za-z(+.-])00)[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?"
        r"[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}(?![0-9])"
        r"|(?<![0-9A-Za-z(+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
    ),
}
_AT = re.compile(r"@|\x20?(?:\(at\)|\[at\])\x20?")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]+)*+")

_TIGHT = {
    "email": re.compile(r"[A-Za-z0-9]+(?:[._%+-][A-Za-z0-9]+)*@(?:[A-Za-z0-9]+(?:-+[A-Za-z0-9]+)*\.)+[A-Za-z]{2,24}"),
    "ip": re.compile(r"(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}"),
    "card": re.compile(r"[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}"),
    "phone": re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}"),
}
# Gazetteers and words, plain lists.
_TOP_LEVEL = frozenset(
    "com org net edu gov mil int info biz name io ai app dev eu us uk ca au de fr es it nl be ch at pt pl se no dk fi "
    "ie cz gr hu ro ru ua tr in cn jp kr br mx ar cl co za".split()
)
#: Calling codes, of those with three digits the first two.
_CALLING = tuple(
    "1 7 20 21 22 23 24 25 26 27 30 31 32 33 34 35 36 37 38 39 40 41 42 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
    "60 61 62 63 64 65 66 81 82 84 85 86 88 90 91 92 93 94 95 96 97 98 99".split()
)
_ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65", "2")
_RESERVED_NETS = frozenset({0, 127, 255, *range(224, 240)})
_BEFORE = {
    "email": frozenset("mail email e-mail contact write address to from cc courriel correo adresse kontakt".split()),
    "ip": frozenset("ip address addr host server client login adresse dirección".split()),
    "card": frozenset("card visa mastercard amex credit debit payment carte karte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax contact téléphone telefon teléfono".split()),
}
_NOT_BEFORE = frozenset(
    "version v ver release section chapter page isbn issn order sku item part serial build revision id token "
    "password key secret sha hash uuid commit".split()
)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v if v < 5 else 2 * v - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` with what stands before it, back to the last match, and its domain."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind's number, start and end of what the rules accept, by start, then kind."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(kind, s, e) for s, kind, e in sorted(found)]


def _wide_emails(text: str) -> list[tuple[int, int]]:
    found, end = [], 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at.end())
        if start < at.start() and host:
            end = host.end()
            found.append((start, end))
    return found


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans and what wider patterns find, each once."""
    found = set(base)
    if "@" in text or "(at)" in text or "[at]" in text:
        found.update((0, s, e) for s, e in _wide_emails(text))
    for k, kind in enumerate(KINDS):
        if kind == "card":
            found.update((k, m.start(1), m.end(1)) for m in _WIDE[kind].finditer(text))
        elif kind in _WIDE:
            found.update((k, *m.span()) for m in _WIDE[kind].finditer(text))
        if kind == "phone":  # what follows a space may be another number
            for _, start, end in [x for x in found if x[0] == k]:
                spaces = [at for at in range(start, end) if text[at] == " "]
                found.update((k, start, at) for at in spaces if len(_digits(text[start:at])) >= 10)
    return sorted(found, key=lambda x: (x[1], x[0], x[2]))


def _check(kind: int, span: str, digits: str) -> int:
    if kind == 0:
        local = span.partition("@")[0]
        return int(".." not in span and local[:1].isalnum() and local[-1:].isalnum())
    if kind == 1:
        parts = span.split(".")
        return int(len(parts) == 4 and all(map(_small, parts)))
    if kind == 2:
        return int(14 <= len(digits) <= 19 and _luhn(digits))
    return int(10 <= len(digits) <= 13)


def _gazetteer(kind: int, span: str, digits: str) -> int:
    if kind == 0:
        return int(span.rpartition(".")[2].lower() in _TOP_LEVEL)
    if kind == 1:
        first = span.partition(".")[0]
        return NO if not _small(first) or int(first) in _RESERVED_NETS else ABSTAINS
    if kind == 2:
        return YES if digits.startswith(_ISSUERS) else NO
    if span[0] == "+":
        return int(digits.startswith(_CALLING))
    return ABSTAINS


def _words_before(kind: int, before: str) -> int:
    own = re.findall(r"[^\W\d_]+", before.lower())[-3:]
    if any(w in _NOT_BEFORE for w in own):
        return NO
    return YES if any(w in _BEFORE[KINDS[kind]] for w in own) else ABSTAINS


def _joined(text: str, start: int, end: int) -> int:
    before, after = text[start - 1 : start], text[end : end + 1]
    if before.isalnum() or after.isalnum() or (before and before in "_=#/\\@+") or (after and after in "_=@/\\"):
        return NO
    return YES


def votes(text: str, kind: int, start: int, end: int, is_base: bool) -> tuple[int, ...]:
    span = text[start:end]
    digits = _digits(span)
    return (
        int(is_base),
        int(_TIGHT[KINDS[kind]].fullmatch(span) is not None),
        _check(kind, span, digits),
        _gazetteer(kind, span, digits),
        _words_before(kind, text[max(0, start - 40) : start]),
        _joined(text, start, end),
    )


def _shape(text: str) -> str:
    text = re.sub(r"[0-9]+", lambda m: f"9{len(m[0])}" if len(m[0]) < 20 else "9+", text[:120])
    return re.sub(r"[^\W\d_]+", "a", text)


def features(text: str, kind: int, start: int, end: int, cast: tuple[int, ...]) -> list[int]:
    """Hashed features of a candidate, with its votes."""
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 30) : start].lower())[-2:]
    after = re.findall(r"[^\W\d_]+", text[end : end + 30].lower())[:2]
    own = [f"kind {kind}", f"{kind} shape {_shape(text[start:end])}", f"{kind} digits {len(_digits(text[start:end]))}"]
    own += [f"{kind} {name} {vote}" for name, vote in zip(LABELERS, cast)]
    own += [f"{kind} before {w}" for w in before] + [f"{kind} after {w}" for w in after]
    return [crc32(x.encode()) % BUCKETS for x in own]


def _pattern(cast: tuple[int, ...]) -> int:
    return sum(v * 3**k for k, v in enumerate(cast))


def _texts(batch: pa.RecordBatch) -> tuple[list[int], list[str]]:
    """Rows that hold a digit or a sign of an address, with their texts."""
    texts = column(batch, "text")
    wanted = pc.fill_null(pc.match_substring_regex(texts, r"[0-9@]|[(\[]at[)\]]"), False)
    rows = np.flatnonzero(wanted.to_numpy(zero_copy_only=False))
    return rows.tolist(), texts.take(pa.array(rows)).to_pylist()


VOTED = "kind int, pattern int, slot int, hash long, features array<int>, copies long"


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each kind and pattern of votes the count, and candidates to learn from."""
    counts: Counter = Counter()
    least: dict[tuple[int, int, int], tuple[int, list[int]]] = {}
    for batch in batches:
        for text in _texts(batch)[1]:
            base = base_spans(text)
            for kind, start, end in candidates(text, base):
                cast = votes(text, kind, start, end, (kind, start, end) in base)
                pattern = _pattern(cast)
                window = f"{kind} {text[max(0, start - 30) : end + 30]}".encode()
                h = int.from_bytes(hashlib.blake2b(window, digest_size=7).digest(), "big")
                key = (kind, pattern, h % ROWS_PER_PATTERN)
                counts[key] += 1
                if key not in least or h < least[key][0]:
                    least[key] = (h, features(text, kind, start, end, cast))
    rows = [(*key, *least[key], n) for key, n in counts.items()]
    kinds = [pa.int32()] * 3 + [pa.int64(), pa.list_(pa.int32()), pa.int64()]
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows) if rows else [[]] * 6, kinds)]
    yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in VOTED.split(", ")])


def posteriors(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Dawid and Skene: how likely each pattern of votes is personal data.

    patterns: a row of votes for each pattern. Also returns each labeler's chances of
    each vote (labeler, truth, vote) and the share of personal data. A few pretended
    votes say that labelers are better than chance, which fixes what is yes and no.
    """
    seen = np.eye(3)[patterns]  # pattern, labeler, vote
    pretended = np.array([[3.0, 0.5, 1.0], [0.5, 3.0, 1.0]])  # truth no, yes; vote no, yes, none
    chances = np.tile(pretended / pretended.sum(axis=1, keepdims=True), (patterns.shape[1], 1, 1))
    share = 0.5
    for _ in range(ROUNDS):
        logs = np.einsum("plv,ltv->pt", seen, np.log(chances)) + np.log([1 - share, share])
        likely = np.exp(logs - logs.max(axis=1, keepdims=True))
        likely /= likely.sum(axis=1, keepdims=True)
        weight = likely * counts[:, None]
        share = (weight[:, 1].sum() + 1) / (weight.sum() + 2)
        chances = np.einsum("pt,plv->ltv", weight, seen) + pretended
        chances /= chances.sum(axis=2, keepdims=True)
    return likely[:, 1], chances, float(share)


def _logistic(rows: list[list[int]], truth: np.ndarray) -> np.ndarray:
    """Weights of hashed features that fit the posteriors, by Adam."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate(rows).astype(np.int64)
    weights, slow, square = (np.zeros(BUCKETS) for _ in range(3))
    for turn in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.bincount(owner, weights[feature], len(rows))))
        slope = np.bincount(feature, (p - truth)[owner], BUCKETS) / len(rows) + 1e-4 * weights
        slow += 0.1 * (slope - slow)
        square += 0.01 * (slope**2 - square)
        weights -= 0.1 * (slow / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-9)
    return weights


def train(docs: DataFrame) -> np.ndarray:
    """Weights of the span classifier, from the votes on all texts."""
    voted = docs.select("text").mapInArrow(_voted, VOTED)
    # at most ROWS_PER_PATTERN rows for each kind and pattern, of which there are 3 ** 6
    best = F.min(F.struct("hash", "features")).alias("best")
    found = sorted(
        voted.groupBy("kind", "pattern", "slot").agg(F.sum("copies").alias("copies"), best).collect(),
        key=lambda r: (r.kind, r.pattern, r.slot),
    )
    rows, truth = [], []
    for kind in range(len(KINDS)):
        own = [r for r in found if r.kind == kind]
        if not own:
            continue
        counts = Counter()
        for r in own:
            counts[r.pattern] += r.copies
        codes = np.array(sorted(counts))
        cast = codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3
        likely, _, _ = posteriors(cast, np.array([counts[c] for c in codes], float))
        of_pattern = dict(zip(codes.tolist(), likely.tolist()))
        rows += [r.best.features for r in own]
        truth += [of_pattern[r.pattern] for r in own]
    return _logistic(rows, np.array(truth)) if rows else np.zeros(BUCKETS)


def spans_of(text: str, weights: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Kind, start, end and score of all spans; base spans score 1."""
    base = base_spans(text)
    rest = [c for c in candidates(text, base) if c not in base]
    out = [(k, s, e, 1.0) for k, s, e in base]
    sure = []
    for kind, start, end in rest:
        cast = votes(text, kind, start, end, False)
        if cast[LABELERS.index("check")] == NO:
            continue
        own = features(text, kind, start, end, cast)
        score = float(1 / (1 + np.exp(-weights[own].sum())))
        if score >= SURE:
            sure.append((-score, start - end, start, kind, end))
    taken = sorted((s, e) for _, s, e, _ in out)
    for score, _, start, kind, end in sorted(sure):
        if all(e <= start or s >= end for s, e in taken):
            out.append((kind, start, end, -score))
            taken.append((start, end))
    return sorted(out, key=lambda x: (x[1], x[0], x[2]))


SPANS = "doc_id long, spans array<struct<kind: string, start: int, end: int, base: boolean, score: double>>"


def _found(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    weights = model.value
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])
    )
    for batch in batches:
        out: list[list[dict]] = [[]] * batch.num_rows
        for row, text in zip(*_texts(batch)):
            out[row] = [
                {"kind": KINDS[k], "start": s, "end": e, "base": score == 1.0, "score": score}
                for k, s, e, score in spans_of(text, weights)
            ]
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(out, kind)], names=["doc_id", "spans"])


def find(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``spans`` of each document, by start, then kind."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda it: _found(it, model), SPANS)


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as ``kind:start:end,...``."""
    base = F.filter("spans", lambda s: s["base"])

    def written(spans):
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in KINDS]
    digest = F.sha2(written(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, written(F.col("spans")).alias("spans"))
