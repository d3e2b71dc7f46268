from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyspan.llm import repetition as rep
from tests.llm import data

BLANK = r"[\x20\x09-\x0D]+"


def longest_by_force(symbols, least):
    out = []
    for i in range(len(symbols)):
        best = 0
        for j in range(len(symbols)):
            k = 0
            while i != j and i + k < len(symbols) and j + k < len(symbols) and symbols[i + k] == symbols[j + k]:
                k += 1
            best = max(best, k)
        out.append(best if best >= least else 0)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_equals_brute_force(seed):
    rng = random.Random(seed)
    size = [1, 2, 5, 30, 90, 90][seed % 6]
    body = [rng.randrange(1 + seed % 3) for _ in range(size)]
    symbols = np.array([*body, 99], np.int64)
    for least in (1, 2, 3, 5, 8):
        assert rep.longest_repeats(symbols, least).tolist() == longest_by_force(symbols.tolist(), least)


def words_of(text):
    return [w for w in re.split(BLANK, text or "") if w]


def base(text):
    """The base columns, from their definition."""
    words, text = words_of(text), text or ""
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = [False] * len(words)
    for i in range(len(words) - 4):
        if runs[tuple(words[i : i + 5])] > 1:
            inside[i : i + 5] = [True] * 5
    lines = [line for line in text.split("\n") if words_of(line)]
    repeated = sum(inside)
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeated,
        len(words) < 10 or 100 * repeated > 20 * len(words),
    )


def limits(text):
    """(covered, longest) code points by brute force over words, and over long words alone."""
    words = words_of(text)
    repeat = longest_by_force(words, 5)
    inside, longest = [False] * len(words), 0
    for i, n in enumerate(repeat):
        inside[i : i + n] = [True] * n
        longest = max(longest, len(" ".join(words[i : i + n])))
    total = sum(len(w) for w, hit in zip(words, inside) if hit)
    symbols = []
    for w, hit in zip(words, inside):
        if len(w) > rep.LONG_WORD and not hit:
            symbols += [*w, object()]
    again = longest_by_force(symbols, rep.LEAST_CHARS)
    hit = [False] * len(symbols)
    for i, n in enumerate(again):
        hit[i : i + n] = [True] * n
        longest = max(longest, n)
    return total + sum(hit), longest


def small_texts():
    rng = random.Random(5)
    out = ["", " \n ", "a", "one two three four five", "one two three four five one two three four five"]
    for _ in range(40):
        words = [rng.choice(["so", "it", "goes", "é", "𝒳y", "\n"]) for _ in range(rng.randint(0, 120))]
        out.append(rng.choice([" ", "\t", "  "]).join(words))
    passage = data.prose(rng, 60)
    out.append(data.prose(rng, 200) + " " + passage + " " + data.prose(rng, 150) + "\n" + passage)
    out.append("x" * 150)
    out.append(data.prose(rng, 20) + " " + "ab" * 90 + " " + "cab" * 70 + " q" + "ab" * 40)
    out.append("".join(rng.choice("0123456789") for _ in range(200)) + " " + data.prose(rng, 30))
    return out


def test_measures_equal_brute_force():
    texts = small_texts()
    found = rep.measure(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        want = base(text)
        assert (found.n_words[i], found.word_chars[i], found.n_repeat_words[i]) == (want[0], want[1], want[4]), text
        assert (found.covered_chars[i], found.longest_chars[i]) == limits(text), text
        at = found.span_owner == i
        words = sum(found.span_words[at])
        assert words == want[4]
        assert all(f + n <= want[0] for f, n in zip(found.span_first[at], found.span_words[at]))


def test_operator_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(small_texts())] + [(None, None), (3, "one line\n\n one line\none line\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter(tuple(r)[:8] + tuple(r)[8:] for r in rep.op11(df).collect())
    want = Counter()
    for key, text in rows:
        b, (total, longest) = base(text), limits(text)
        kept = not b[5] and total <= rep.MOST_COVERED * b[1] and longest <= rep.LONGEST
        want[(key, *b[:6], kept, total, longest)] += 1
    assert got == want


def test_whole_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = rep.op11(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_long_repeat_fails_though_little_is_covered(spark):
    rng = random.Random(7)
    passage = data.prose(rng, 400)
    text = data.prose(rng, 3000) + " " + passage + " " + data.prose(rng, 3000) + " " + passage
    assert len(passage) > rep.LONGEST
    df = spark.createDataFrame([(1, text), (2, data.prose(rng, 6000))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in rep.op11(df).collect()}
    assert not got[1].base_failed and not got[1].kept and got[1].longest_chars >= len(" ".join(passage.split()))
    assert got[2].kept
    assert [r.doc_id for r in rep.keep_varied(df).collect()] == [2]


def test_no_blanks_at_all(spark):
    rng = random.Random(8)
    clean = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400))
    lines = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(80)) for _ in range(12)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join([clean[:200]] * 3 + lines[:12]))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in rep.op11(df).collect()}
    assert got[1].kept and got[1].covered_chars == 0
    assert not got[2].kept and got[2].covered_chars == 600 and got[2].longest_chars == 200


def test_messy_clashing_and_empty(spark):
    df = data.messy(spark)
    want = Counter((r.doc_id, *base(r.text)) for r in df.collect())
    assert Counter((r[0], *r[1:7]) for r in rep.op11(df).collect()) == want
    wide = data.clashing(spark, ["repetition", "n_words", "a.b", "spans"])
    found = rep.with_repetition(wide)
    assert found.columns == [c for c in wide.columns if c != "repetition"] + ["repetition"]
    assert Counter((r["doc_id"], r["repetition"]["n_words"]) for r in found.collect()) == Counter(
        (r["doc_id"], len(words_of(r["text"]))) for r in wide.collect()
    )
    assert rep.keep_varied(wide).columns == wide.columns
    assert rep.op11(data.empty(spark)).collect() == []
