"""The stages one after the other, each against a brute-force version of what it decides."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tallyspan.llm import pii
from tallyspan.session import store_and_reload
from tests.llm import data, test_linededup, test_neardup, test_packing


def stage(spark, name, docs):
    return store_and_reload(dict(corpus_pipeline.STAGES)[name](spark, docs, ""), name)


def test_stages(spark):
    extra = data.messy(spark).selectExpr("*", "doc_id AS score", "source AS n_lines", "1 AS node")
    docs = store_and_reload(extra, "docs")

    known = stage(spark, "language", docs)
    assert known.columns == docs.columns
    texts = Counter(r.text for r in docs.collect() if r.text and any(map(str.isalpha, r.text)))
    assert Counter(r.text for r in known.collect()) == texts
    assert not known.where("lang IS NULL").count()

    single = stage(spark, "lines", known)
    assert single.columns == docs.columns
    digests = Counter(test_linededup.hashlib.sha256(r.text.encode()).hexdigest() for r in single.collect())
    want = Counter()
    for (_, _, _, digest), n in test_linededup.brute(known.collect()).items():
        want[digest] += n
    assert digests == want
    assert all(r.n_chars == len(r.text) for r in single.collect())

    kept = stage(spark, "near_duplicates", single)
    rows = single.collect()
    classes = test_neardup.brute([r.text for r in rows])
    least = {}
    for r, c in zip(rows, classes):
        least[c] = min(least.get(c, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == Counter(least.values())

    clean = stage(spark, "personal_data", kept)
    assert not any(pii.base_spans(r.text) for r in clean.collect())
    untouched = Counter(r.text for r in kept.collect() if not pii.TRIGGER.search(r.text))
    assert not untouched - Counter(r.text for r in clean.collect())
    assert clean.count() == kept.count()

    test_packing.check(clean, stage(spark, "packing", clean), 2048)


def test_empty_table(spark):
    docs = store_and_reload(data.empty(spark), "docs")
    for name, _ in corpus_pipeline.STAGES:
        docs = stage(spark, name, docs)
    assert docs.count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_without_labels_texts_stay(spark):
    docs = data.messy(spark, count=5).withColumn("lang", data_null())
    assert stage(spark, "language", docs).count() == sum(
        bool(r.text) and any(map(str.isalpha, r.text)) for r in docs.collect()
    )


def data_null():
    from pyspark.sql import functions as F

    return F.lit(None).cast("string")
