from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspan.llm import pii, tagger
from tests.llm import data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("a1@. -+é9%()"), max_size=60))
def test_patterns_as_they_are_written(text):
    assert list(pii.emails(text)) == [m.span() for m in EMAIL.finditer(text)]
    assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in IP.finditer(text)]


def test_checks():
    text = "x@y.de 1.2.3.4 1.2.3.256 4111 1111 1111 1111 4111 1111 1111 1112 +49 (30) 1234567 +1 2"
    kinds = [(pii.KINDS[k], text[a:b]) for a, k, b in pii.base_spans(text)]
    assert ("email", "x@y.de") in kinds
    assert ("ip", "1.2.3.4") in kinds
    assert not any(s == "1.2.3.256" for _, s in kinds)
    assert ("phone", "+49 (30) 1234567") in kinds
    assert pii.luhn("4111111111111111")
    assert not pii.luhn("4111111111111112")


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "+" * 100_000, "1." * 100_000, "a@" * 50_000, "1 " * 100_000):
        pii.base_spans(text)


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    model = tagger.Tagger(5, dtype=np.float64)
    for name in model.p:
        model.p[name] = model.p[name] + 0.1 * rng.standard_normal(model.p[name].shape)
    symbols = rng.integers(0, 130, (3, 6))
    symbols[1, 3:] = tagger.PAD
    tags = np.where(symbols == tagger.PAD, 0, rng.integers(0, 5, (3, 6)))
    _, grad = model.loss(symbols, tags)
    for name, value in model.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            at = (symbols[0, 2], at[1]) if name == "embedding" else at
            kept, sides = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = kept + step
                sides.append(model.loss(symbols, tags)[0])
            value[at] = kept
            assert abs((sides[0] - sides[1]) / 2e-5 - grad[name][at]) < 1e-7


def test_best_path_is_the_best_of_all():
    model = tagger.Tagger(3, dtype=np.float64)
    rng = np.random.default_rng(2)
    model.p["move"] = rng.standard_normal((3, 3))
    e = rng.standard_normal((2, 5, 3))

    def score(row, path):
        moves = sum(model.p["move"][a, b] for a, b in zip(path, path[1:]))
        return model.p["start"][path[0]] + moves + sum(e[row, t, tag] for t, tag in enumerate(path))

    found = model.best_path(e, np.array([5, 3]))
    for row, n in ((0, 5), (1, 3)):
        best = max(itertools.product(range(3), repeat=n), key=lambda p, row=row: score(row, p))
        assert tuple(found[row][:n]) == best


def corpus(count=400):
    rng = random.Random(5)
    out = []
    for i in range(count):
        digits = f"4{rng.randrange(10**14):014d}"
        kinds = [
            f"{data.prose(rng, 1).strip('., ')}@mail{i % 9}.example.com",
            ".".join(str(rng.randint(1, 255)) for _ in range(4)),
            next(f"{digits}{k}" for k in range(10) if pii.luhn(f"{digits}{k}")),
            f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
        ]
        text = f"{data.prose(rng, 12)} {kinds[i % 4]} {data.prose(rng, 12)} in {rng.randint(1, 99)} of {rng.randint(1, 9999)}"
        out.append((i, text, "en", "s", len(text)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.createDataFrame(corpus(), data.DOCUMENTS), steps=500)


def test_the_model_learns_the_base_spans(model):
    hits = total = others = 0
    for _, text, *_ in corpus(520)[400:]:
        base = set(pii.base_spans(text))
        parts = pii.stretches(text)
        found = set()
        for (low, high), path in zip(parts, pii.paths(model, [text[a:b] for a, b in parts])):
            found |= {(a + low, k, b + low) for a, k, b in pii.spans_of(path)}
        hits, total, others = hits + len(base & found), total + len(base), others + len(found - base)
    assert hits >= 0.9 * total
    assert others <= 0.15 * total


def test_the_model_adds_what_the_patterns_miss(model):
    texts = []
    for i, (_, text, *_) in enumerate(corpus(480)[400:]):
        for a, kind, b in pii.base_spans(text)[-1:]:
            texts.append(text[:a] + pii.rewritten(kind, text[a:b], i) + text[b:])
    found = pii.find_spans(texts, model)
    assert sum(bool(more) for base, more in found if not base) >= 8
    for text, (_, more) in zip(texts, found):
        for a, kind, b in more:
            assert pii.plausible(kind, text[a:b])


def named(count, seed=7):
    """Texts with one address, and the address, without a digit; numbers stand far off."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        name, host, first = ("".join(rng.choice(data.WORDS) for _ in range(2)) for _ in range(3))
        address = f"{first}.{name}@{host}.example.{rng.choice(['com', 'org', 'net'])}"
        out.append((f"{data.prose(rng, 15)} {address} {data.prose(rng, 15)}", address))
    return out


def test_addresses_without_a_digit_are_found(spark):
    rows = corpus() + [(1000 + i, t, "en", "s", len(t)) for i, (t, _) in enumerate(named(200))]
    own = pii.train(spark.createDataFrame(rows, data.DOCUMENTS))
    texts, want = [], []
    for i, (text, address) in enumerate(named(120, seed=8)):
        new = pii.rewritten(0, address, i % 3)  # " at ", "[at]", "(at)"
        texts.append(text.replace(address, new))
        at = texts[-1].index(new)
        want.append((at, 0, at + len(new)))
        assert not pii.TRIGGER.search(texts[-1])
        assert any(a <= at and at + len(new) <= b for a, b in pii.stretches(texts[-1]))
        assert pii.plausible(0, new)
    found = [more for _, more in pii.find_spans(texts, own)]
    for form in range(3):
        hits = sum(w in f for w, f in list(zip(want, found))[form::3])
        assert hits >= 28, (form, hits)
    assert sum(len(f) for f in found) <= 1.1 * len(texts)


def test_prose_is_no_address():
    text = "We look at home. Then we meet at noon; data.at the end (at last) he sat at the table."
    assert pii.stretches(text) == []
    assert not pii.plausible(0, "look at home. Then")
    assert pii.plausible(0, "john.smith [at] example [dot] com")
    for part in ("at-", "at a", "x at b.c ", "at a.", "at dot-", "at "):
        pii.stretches(part * 50_000)


def test_rare_spans_are_in_the_sample(spark):
    numbers = spark.range(9000).selectExpr("id AS doc_id", "concat('in ', id, ' of ', id) AS text")
    hashed = numbers.orderBy(pii.F.desc(pii.F.xxhash64("doc_id")))
    last = {r.doc_id for r in hashed.limit(2).collect()}
    mail = pii.F.when(pii.F.col("doc_id").isin(last), pii.F.lit("to a@b.example.com")).otherwise(pii.F.col("text"))
    assert pii.train(numbers, steps=1) is None
    assert pii.train(numbers.withColumn("text", mail), steps=1) is not None


def test_a_span_among_many_numbers_gives_a_window():
    many = " ".join(str(i) for i in range(5000))
    text = f"{many[:9000]} to a@b.example.com {many[9000:]}"
    for key in range(60):
        windows = pii.examples(text, key)
        assert len(windows) <= pii.WINDOWS_PER_DOCUMENT
        assert any(np.frombuffer(tags, np.int8).any() for _, tags in windows)


def test_windows_cover_every_place():
    for length in (1, 63, 64, 65, 100, 128, 300):
        starts = pii.window_starts(10, 10 + length)
        seen = {p for s in starts for p in range(s, min(s + pii.WIDTH, 10 + length))}
        assert seen == set(range(10, 10 + length))


def test_long_stretches_are_decoded_as_one(model):
    text = " ".join(t for _, t, *_ in corpus(480)[400:])
    base = pii.base_spans(text)
    [path] = pii.paths(model, [text])
    assert len(path) == len(text) > 100 * pii.WIDTH
    assert len(set(pii.spans_of(path)) & set(base)) >= 0.85 * len(base)


def test_rows_of_the_contract(spark, model):
    df = data.messy(spark, count=20)
    rows = pii.pick(df, doc_id="doc_id", text="text")
    found = pii._mapped(rows, model, "text", pii.DIGEST, pii._digest_rows).drop("text").collect()
    texts = {r.doc_id: r.text for r in df.collect() if r.doc_id not in (None, 3)}
    assert len(found) == df.count()
    for r in found:
        if r.doc_id in texts:
            base = pii.base_spans(texts[r.doc_id] or "")
            assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
            assert set(filter(None, pii.joined(base).split(","))) <= set(r.spans.split(","))


def test_redaction_clashing_columns_and_empty(spark, model):
    assert pii.redacted("call +1 (456) 555-2186 now", [(5, 3, 22)]) == "call [PHONE] now"
    assert pii.redacted("abcdef", [(1, 0, 4), (2, 1, 5)]) == "a[EMAIL]f"
    df = data.clashing(spark, ["pii_spans", "a.b", "c0", "spans"])
    found = pii.redact(df, model)
    assert found.columns == [c for c in df.columns if c != "pii_spans"] + ["pii_spans"]
    for r in found.collect():
        assert not pii.base_spans(r.text or "")
    assert pii.train(data.empty(spark)) is None
    assert pii._mapped(pii.pick(data.empty(spark), doc_id="doc_id", text="text"), None, "text", pii.DIGEST, pii._digest_rows).collect() == []
    none = spark.createDataFrame([(1, "in 12 of 13", None, None, None)], data.DOCUMENTS)
    assert pii.train(none) is None
