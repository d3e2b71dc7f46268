from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyspan.llm import neardup
from tallyspan.llm.common import shingles, weighted
from tallyspan.llm.components import components
from tests.llm import data


def runs(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(texts, threshold=0.8):
    """Class number of each text: equal texts, and components of similar ones."""
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [runs(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if texts[i] == texts[j] or common and common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def check(df, found):
    rows = df.collect()
    classes = defaultdict(list)
    for r, c in zip(rows, brute([r.text or "" for r in rows])):
        classes[c].append(r)
    want = Counter()
    for members in classes.values():
        ids = [r.doc_id for r in members if r.doc_id is not None]
        for r in members:
            want[r.doc_id, min(ids, default=None), len({r.text or "" for r in members})] += 1
    assert Counter(map(tuple, found)) == want
    return classes


def test_messy_documents(spark):
    df = data.messy(spark)
    classes = check(df, neardup.op9(df).collect())
    assert max(map(len, classes.values())) >= 10


def chain(spark, copies=60):
    """Copies of one text with few to many changed words: some are similar to the source
    only, some to nothing; and a chain in which only neighbours are similar."""
    rng = random.Random(8)
    base = data.prose(rng, 150).split()
    rows = [" ".join(base)]
    for i in range(copies):
        words = base.copy()
        for at in rng.sample(range(150), 1 + i % 8):
            words[at] = f"w{rng.random()}"
        rows.append(" ".join(words))
    link = data.prose(rng, 200).split()
    for step in range(8):
        link[step * 20 : step * 20 + 3] = [f"n{step}{k}" for k in range(3)]
        rows.append(" ".join(link))
    return spark.createDataFrame([(i * 3, t, "en", "s", 1) for i, t in enumerate(rows)], data.DOCUMENTS)


def test_no_link_is_lost(spark):
    df = chain(spark)
    classes = check(df, neardup.op9(df).collect())
    assert 20 < max(map(len, classes.values())) < 61


def repeated(rng, runs_in_all, share, times, changed):
    """Two texts whose sets of runs are equal but for ``changed`` words of the second; a
    share of its runs repeats: a cycle of words, gone round more than once."""
    cycle = [f"c{rng.random()}" for _ in range(int(runs_in_all * share))]
    rest = [f"r{rng.random()}" for _ in range(runs_in_all - len(cycle))]
    other = rest.copy()
    for at in range(changed):
        other[-1 - at] = f"x{rng.random()}"
    return " ".join(cycle + cycle[:4] + rest), " ".join(cycle * times + cycle[:4] + other)


def test_links_do_not_depend_on_counts(spark):
    rng = random.Random(4)
    texts = []
    for share, times, changed in ((0.2, 50, 0), (0.5, 20, 0), (0.3, 5, 20)):
        for _ in range(8):
            texts += repeated(rng, 400, share, times, changed)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], data.DOCUMENTS)
    assert min(len(a & b) / len(a | b) for a, b in zip(map(runs, texts[::2]), map(runs, texts[1::2]))) > 0.9
    classes = check(df, neardup.op9(df).collect())
    assert len(classes) == 24
    assert len(neardup.first_of_classes(df).collect()) == 24


def test_components_follow_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)} | {(n, 90) for n in (90, 95, 100)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_components_agree_in_proportion():
    rng = random.Random(2)
    texts, truth = [], []
    for i in range(60):
        words = data.prose(rng, 200).split()
        other = words.copy()
        for at in rng.sample(range(200), 1 + i % 12):
            other[at] = f"x{rng.random()}"
        texts += [" ".join(words), " ".join(other)]
        a, b = runs(texts[-2]), runs(texts[-1])
        truth.append(len(a & b) / len(a | b))
    value, owner, count = weighted(*shingles(texts, 5))
    signature = neardup.signatures(value, owner, np.ones(len(count)), len(texts))
    same = (signature[::2] == signature[1::2]).mean(axis=1)
    assert abs((same - truth).mean()) < 0.01
    assert np.abs(same - truth).max() < 0.15


def test_weights_count():
    """Against the definition of the probability Jaccard similarity."""
    value = np.array([11, 22, 11, 22], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = second = 0
    for seed in range(60):
        mixed = value ^ np.uint64(seed * 7_919_000_000_007)
        got = neardup.signatures(mixed, np.array([0, 0, 1, 1]), np.array([3.0, 1.0, 1.0, 1.0]), 2)
        first += (got[0] == got[1]).sum()
        second += got.shape[1]
    x, y = (3, 1), (1, 1)
    expected = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(2)) for i in range(2))
    assert abs(first / second - expected) < 0.02


def test_one_of_each_class_stays(spark):
    df = data.messy(spark)
    rows = df.collect()
    kept = neardup.first_of_classes(df).collect()
    groups = defaultdict(list)
    for r, c in zip(rows, brute([r.text or "" for r in rows])):
        groups[c].append(r)
    assert len(kept) == len(groups)
    order = lambda r: (r.doc_id is None, r.doc_id or 0)
    want = {min(map(order, members)) for members in groups.values()}
    assert {order(r) for r in kept} == want


def test_clashing_columns_and_empty(spark):
    df = data.clashing(spark, ["node", "label", "a.b", "c1", "k0x"])
    check(df, neardup.op9(df).collect())
    assert neardup.first_of_classes(df).columns == df.columns
    assert neardup.op9(data.empty(spark)).collect() == []
    assert neardup.first_of_classes(data.empty(spark)).collect() == []


def template_copies(rng, copies, words=300, changed=9):
    """Copies of one text in which each has ``changed`` words of its own: below 0.8 to one another."""
    base = data.prose(rng, words).split()
    out = []
    for i in range(copies):
        text = base.copy()
        for at in rng.sample(range(5, words - 5), changed):
            text[at] = f"own{i}x{at}"
        out.append(" ".join(text))
    return out


def pairs_across(spark, texts):
    """(pairs that are verified after the centres, texts) for given texts."""
    counts = []
    across = neardup._across

    def counted(*args):
        found = across(*args)
        counts.append(found.count())
        return found

    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], data.DOCUMENTS)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(neardup, "_across", counted)
        found = neardup.similar_classes(df).collect()
    return counts[0], found


def test_pairs_of_a_template_do_not_grow_with_its_square(spark):
    rng = random.Random(6)
    small = template_copies(rng, 150)
    large = template_copies(rng, 300)
    sets = [runs(t) for t in large[:40]]
    assert max(len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]) < 0.8
    few, _ = pairs_across(spark, small)
    many, found = pairs_across(spark, large)
    assert many <= max(2 * few, 600)
    assert len({r.class_id for r in found}) == len(large)


def test_template_copies_with_close_ones_among_them(spark):
    """Texts with few changes of their own are still compared with the others."""
    rng = random.Random(7)
    texts = template_copies(rng, 60) + template_copies(random.Random(8), 20)
    words = texts[3].split()
    words[150] = "another"
    texts += [" ".join(words), " ".join([*texts[10].split()[:-3], "and", "so", "on"])]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], data.DOCUMENTS)
    check(df, neardup.op9(df).collect())


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_other_thresholds(spark, threshold):
    rng = random.Random(9)
    texts = []
    for i in range(30):
        words = data.prose(rng, 200).split()
        other = words.copy()
        for at in rng.sample(range(200), 1 + i % 15):
            other[at] = f"x{rng.random()}"
        texts += [" ".join(words), " ".join(other)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], data.DOCUMENTS)
    classes = {r.doc_id: r.class_id for r in neardup.similar_classes(df, threshold=threshold).collect()}
    linked = 0
    for i in range(0, len(texts), 2):
        a, b = runs(texts[i]), runs(texts[i + 1])
        want = len(a & b) >= threshold * len(a | b)
        assert (classes[i] == classes[i + 1]) == want
        linked += want
    assert 0 < linked < 30 or threshold == 0.5


def test_plans():
    plan = neardup.Plan.of(0.8)
    assert (plan.bands, plan.rows, plan.least_agreement) == (40, 6, 351)
    for threshold in (0.3, 0.5, 0.7, 0.9, 0.95):
        plan = neardup.Plan.of(threshold)
        assert (1 - threshold**plan.rows) ** plan.bands <= 1e-5 and plan.bands * plan.rows <= neardup.BANDED
    for threshold in (0, 0.01, 1, 1.5):
        with pytest.raises(ValueError):
            neardup.Plan.of(threshold)


def same_partition(texts, found):
    classes = {r.doc_id: r.class_id for r in found}
    want = brute(texts)
    assert len({(classes[i], want[i]) for i in range(len(texts))}) == len(set(want)) == len(set(classes.values()))


def test_template_copies_just_below_the_threshold_are_not_verified(spark):
    """Few own runs in each text, so only two texts' runs together show that there is no link."""
    texts = template_copies(random.Random(10), 300, words=1000, changed=14)
    sets = [runs(t) for t in texts[:40]]
    shares = [len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]]
    assert min(shares) > 0.75 and sum(s >= 0.8 for s in shares) < 0.01 * len(shares)
    few, _ = pairs_across(spark, texts[:150])
    many, found = pairs_across(spark, texts)
    assert many <= max(2 * few, 600)
    same_partition(texts, found)


def test_close_copies_of_a_template_are_still_linked(spark):
    """Long texts, whose parts hold more runs than are counted one by one, and short ones."""
    rng = random.Random(11)
    texts = []
    for words, changed in ((8000, 80), (300, 3), (300, 4)):
        texts += template_copies(rng, 24, words, changed)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], data.DOCUMENTS)
    known, calls = neardup.components, []

    def none_at_first(links):
        calls.append(1)
        return known(links.limit(0) if len(calls) == 1 else links)

    with pytest.MonkeyPatch.context() as patch:  # so that all of them are met across components
        patch.setattr(neardup, "components", none_at_first)
        same_partition(texts, neardup.op9(df).collect())
