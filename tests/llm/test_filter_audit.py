from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from tallyspan.llm import filter_audit as audit
from tallyspan.llm.radix import RadixTrie
from tests.llm import data

LABELS = "doc_id bigint, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failing(rows):
    """(part, id, set of failed filters) of rows (id, text, lang), from the definitions."""
    least = {}
    for key, text, _ in rows:
        if key is not None:
            text = text or ""
            least[text] = min(key, least.get(text, key))
    out = []
    for key, text, lang in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if key is not None and key > least[text]:
            fails.add("E")
        out.append((lang or "", key, fails))
    return out


def brute(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    judged = failing(rows)
    shapley = Counter()
    found = defaultdict(Counter)
    for part in {p for p, _, _ in judged}:
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                found[part, "".join(order), step].update(dict.fromkeys(COLUMNS[3:9], 0))
    for part, key, fails in judged:
        for order in permutations("ABCDE"):
            gone = False
            for step, letter in enumerate(order, 1):
                c = found[part, "".join(order), step]
                if letter in fails and gone:
                    c["redundant"] += 1
                elif letter in fails:
                    c["removed"] += 1
                    c["good_lost"] += key in good
                    c["toxic_lost"] += key in toxic
                    shapley[part, letter] += 1
                elif not gone:
                    c["kept"] += 1
                c["unique_fails"] += fails == {letter}
                gone = gone or letter in fails
    return {(p, o, s, *[c[n] for n in COLUMNS[3:9]], shapley[p, o[s - 1]]) for (p, o, s), c in found.items()}


def check(spark, rows, labels, partitions=3):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(partitions)
    found = audit.op12(df, spark.createDataFrame(labels, LABELS))
    assert found.columns == COLUMNS
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, labels)


def corpus(seed=1):
    rng = random.Random(seed)
    texts = [data.prose(rng, rng.choice([20, 190, 260, 400])) for _ in range(25)]
    texts += [t + rng.choice(["", "#", "%x", " ABCDEFGHIJKLMNOP" * 3]) for t in texts[:10]]
    texts += [" ".join(["same"] * 300), "Capitals " * 250, "", None, texts[0][:40], texts[0][:41]]
    texts += [texts[1][:1500] + f" tail {i}" for i in range(6)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", "", None])) for i in range(260)]
    rows += [(None, texts[0], "en"), (None, None, None), rows[3], rows[3], (rows[3][0], rows[3][1], "xx")]
    rows += [(1000 + i, texts[2], "en") for i in range(150)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 300, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9, None, None), (9, None, 1), (5000, 1, 1)]
    return rows, labels


def test_equals_brute_force(spark):
    check(spark, *corpus())


def test_small_ranges_long_prefixes_and_salts(spark, monkeypatch):
    """Everything is heavy, most texts are hot, and tasks forget what they have seen."""
    monkeypatch.setattr(audit, "RANGE_BYTES", 2000)
    monkeypatch.setattr(audit, "HOT_COPIES", 2)
    monkeypatch.setattr(audit, "KNOWN_TEXTS", 0)
    check(spark, *corpus(2), partitions=9)


def test_hot_text_is_sent_about_once_a_task(spark):
    rows = spark.range(0, 40_000, 1, 8).selectExpr(
        "id AS row", "id AS doc_id", "'en' AS part", "0 AS mask", "if(id % 3 = 0, 'one text', concat('text ', id)) AS text"
    )
    sent = audit._reduced(rows).where("text IS NOT NULL AND CAST(text AS STRING) = 'one text'").count()
    assert sent <= 8 * 3


@pytest.mark.parametrize("seed", range(5))
def test_trie_equals_a_dictionary(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 1, 2, 5, 9, 300]))) for _ in range(300)]
    texts += [t[: rng.randrange(len(t) + 1)] for t in texts]
    trie, want = RadixTrie(), defaultdict(list)
    keys = [rng.choice([None, rng.randrange(1000)]) for _ in texts]
    for i, (text, key) in enumerate(zip(texts, keys)):
        trie.insert(text, key, i)
        want[text].append(i)
    got = {tuple(end.rows): end.least for end in trie.terminals()}
    assert got == {tuple(r): min((keys[i] for i in r if keys[i] is not None), default=None) for r in want.values()}


def test_nested_texts_need_no_recursion(spark):
    trie = RadixTrie()
    for n in range(5000):
        trie.insert(b"a" * n, n, n)
    assert sum(1 for _ in trie.terminals()) == 5000


def test_messy_clashing_and_empty(spark):
    df = data.messy(spark)
    rows = [(r.doc_id, r.text, r.lang) for r in df.collect()]
    labels = spark.createDataFrame([(1, 1, 0), (205, 0, 1)], LABELS)
    assert {tuple(r) for r in audit.op12(df, labels).collect()} == brute(rows, [(1, 1, 0), (205, 0, 1)])
    wide = data.clashing(spark, ["part", "mask", "row", "a.b"])
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in wide.collect()]
    assert {tuple(r) for r in audit.op12(wide, labels.limit(0)).collect()} == brute(rows, [])
    assert audit.op12(data.empty(spark), labels).collect() == []
