from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np

from tallyspan.llm import cws
from tests.llm import data


def similarity(a: str, b: str) -> float:
    """Generalised Jaccard similarity of the weighted terms."""

    def terms(text):
        words = text.lower().split()
        return Counter(zip(words, words[1:])) if len(words) > 1 else Counter(words)

    x, y = terms(a), terms(b)
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / max(1, sum(max(x[k], y[k]) for k in keys))


def test_quantiles_are_those_of_the_distribution():
    g = cws.gamma_quantiles(10)
    share = 1 - (1 + g) * np.exp(-g)
    assert np.allclose(share, (np.arange(1024) + 0.5) / 1024, atol=1e-9)


def test_collisions_estimate_the_similarity():
    rng = __import__("random").Random(4)
    texts = [data.prose(rng, 300) for _ in range(150)]
    edited = [cws.edit(a, b) for a, b in zip(texts, texts[1:])]
    a, b = cws.fingerprints(texts[:-1], edited)
    error = cws.likeness(a, b) - [similarity(x, y) for x, y in zip(texts, edited)]
    assert abs(error.mean()) < 0.015
    assert error.std() < 0.08


def test_weights_count():
    a, b = cws.fingerprints(["a b " * 50 + "c d"], ["a b " * 25 + "c d"])
    assert 0.3 < cws.likeness(a, b)[0] < 0.7


def test_a_batch_does_not_change_a_fingerprint():
    texts = ["x y z", "", "x y z", "one", " \n", "a b c d e"]
    together = cws.fingerprints(texts)[0]
    for text, row in zip(texts, together):
        assert (cws.fingerprints([text])[0][0] == row).all()
    assert (together[1] == together[4]).all()


def brute(rows):
    import xxhash

    def order(r):
        text = r.text or ""
        hashed = xxhash.xxh64_intdigest(text.encode(), seed=42)
        return r.doc_id is None, r.doc_id or 0, hashed - (hashed >> 63 << 64), text

    rows = sorted(rows, key=order)
    out = Counter()
    for r, follows in zip(rows, [*rows[1:], *rows[:1]]):
        text = r.text or ""
        edit = cws.edit(text, follows.text or "")
        out[r.doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest()] += 1
    return out


def test_neighbours_and_edits(spark):
    df = data.messy(spark)
    found = cws.op7(df).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == brute(df.collect())
    prints = defaultdict(set)
    text_of = {r.doc_id: r.text for r in df.collect() if r.doc_id not in (None, 3)}
    for r in found:
        if r.doc_id in text_of:
            prints[text_of[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1
        assert 0 <= r.near_next <= 1
        assert len(r.fingerprint) == 4 * cws.SAMPLES
    assert all(len(p) == 1 for p in prints.values())


def test_one_row_follows_itself(spark):
    df = spark.createDataFrame([(7, "one two three four", None, None, None)], data.DOCUMENTS)
    [row] = cws.op7(df).collect()
    assert row.near_next == 1


def test_clashing_columns_and_empty_table(spark):
    df = data.clashing(spark, ["fingerprint", "range", "a.b"])
    assert cws.op7(df).count() == df.count()
    assert cws.fingerprint(df).columns == [c for c in df.columns if c != "fingerprint"] + ["fingerprint"]
    assert cws.fingerprint(df).count() == df.count()
    assert cws.op7(data.empty(spark)).collect() == []


def naive(text):
    """The fingerprint from the definition: one term and one sample at a time."""
    words = text.lower().split()
    terms = Counter(zip(words, words[1:])) if len(words) > 1 else Counter((w,) for w in words)
    whole = (1 << 64) - 1
    out = []
    for seed in map(int, cws.SEEDS):
        best = (float("inf"), (1 << 32) - 1)
        for term, weight in terms.items():
            x = int(cws.shingles([" ".join(term)], cws.TERM_WORDS)[0][0])
            h = (x ^ seed) * 0x9E3779B97F4A7C15 & whole
            h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & whole
            h ^= h >> 32
            r = float(cws.GAMMA[h & 0xFFFF])
            b = ((h >> 16 & 0xFFFF) + 0.5) / 65_536
            ln_c = float(cws.LN_GAMMA[h >> 32 & 0xFFFF])
            t = int(np.floor(np.log(weight) / r + b))
            best = min(best, (ln_c - r * (t + 1 - b), (x + t * 0x9E3779B1) & 0xFFFFFFFF))
        name = (best[1] ^ best[1] >> 15) * 0x2C1B3C6D
        out.append(name >> 16 & 0xFFFF)
    return out


def test_fingerprints_and_likenesses_equal_the_definition(spark):
    rng = __import__("random").Random(6)
    texts = [data.prose(rng, n) for n in (3, 40, 25)] + ["so it goes so it goes so it goes so it", "one", "", "x y x y x y z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    found = {r.doc_id: r for r in cws.op7(df).collect()}
    for i, text in enumerate(texts):
        edited = cws.edit(text, texts[(i + 1) % len(texts)])
        own, other, following = naive(text), naive(edited), naive(texts[(i + 1) % len(texts)])
        assert found[i].fingerprint == "".join(f"{x:04x}" for x in own)
        assert found[i].edited_fingerprint == "".join(f"{x:04x}" for x in other)
        assert found[i].near_edited == np.mean([a == b for a, b in zip(own, other)])
        assert found[i].near_next == np.mean([a == b for a, b in zip(own, following)])
