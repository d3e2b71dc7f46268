from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyspan.llm import linededup
from tests.llm import data

LAST = linededup.LAST


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept_sha256) of each row."""
    holders = defaultdict(set)
    keys = {}

    def key(line):
        stripped = line.strip(" \t\n\x0b\x0c\r")
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)
        return keys.setdefault(line, lower if len(stripped) >= 10 else None)

    for r in rows:
        for line in (r.text or "").split("\n"):
            if key(line) is not None:
                holders[key(line)].add(LAST if r.doc_id is None else r.doc_id)
    out = Counter()
    for r in rows:
        lines = (r.text or "").split("\n")
        own = LAST if r.doc_id is None else r.doc_id
        kept = [x for x in lines if key(x) is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == own]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[r.doc_id, len(lines), len(lines) - len(kept), digest] += 1
    return out


def answers(df):
    return Counter(map(tuple, linededup.op8(df).collect()))


def test_messy_documents(spark):
    df = data.messy(spark)
    want = brute(df.collect())
    assert answers(df) == want
    assert sum(n * k[2] for k, n in want.items()) > 50


def test_full_filters_change_nothing(spark, monkeypatch):
    """With every place taken all lines are confirmed exactly."""
    monkeypatch.setattr(linededup, "repeated_filter", lambda _, bits: np.full(bits // 8, 255, np.uint8))
    df = data.messy(spark, seed=2, count=20)
    assert answers(df) == brute(df.collect())


def test_merged_filters_hold_what_is_in_both():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    bits = 1 << 16

    def filled(part):
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        for row in linededup.places(part, bits):
            twice[row] |= once[row]
            once[row] = True
        return np.packbits(once), np.packbits(twice)

    a, b = filled(keys[:400]), filled(keys[300:])
    linededup.merge(*a, *b)
    twice = np.unpackbits(a[1])[linededup.places(keys, bits)].all(axis=1)
    assert twice[300:400].all()
    assert twice[:300].mean() < 0.05


@pytest.mark.parametrize("line,key", [(" \tABC é DEFGHI\r", "abc é defghi"), ("short", None), ("ÉÉÉÉÉÉÉÉÉÉ", "ÉÉÉÉÉÉÉÉÉÉ")])
def test_keys(line, key):
    assert linededup.key_of(line) == (key.encode() if key else None)


def test_texts_clashing_columns_and_empty(spark):
    df = data.clashing(spark, ["n_lines", "_text", "a.b", "c1", "_row"])
    found = linededup.dedup_lines(df)
    assert found.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    texts = Counter(hashlib.sha256((r.text or "").encode()).hexdigest() for r in found.collect())
    want = Counter()
    for (_, _, _, digest), n in brute(df.collect()).items():
        want[digest] += n
    assert texts == want
    assert linededup.op8(data.empty(spark)).collect() == []
