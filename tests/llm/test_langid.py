from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import langid
from tests.llm import data


@pytest.mark.parametrize("languages", [0, 1, 2, 4, 7, 8, 20])
def test_codewords_are_apart(languages):
    code = langid.codewords(languages)
    assert code.shape[0] == languages
    apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(apart, default=1) >= 1
    if languages == 4:
        assert code.shape[1] == 7
        assert set(apart) == {4}  # any single wrong bit can be put right


def test_decoding_corrects_a_wrong_bit():
    code = langid.codewords(4)
    model = langid.Model(list("abcd"), code, np.zeros((langid.DIMENSIONS, 7)), np.zeros(7))
    for i, word in enumerate(code):
        for bit in range(7):
            model.bias = 4.0 * word
            model.bias[bit] *= -1
            names, score, ambiguous = model.predict(["some text"])
            assert names == ["abcd"[i]]
            assert not ambiguous[0]
    model.bias = np.zeros(7)
    assert model.predict(["some text"])[2][0]


def test_counts_cover_the_whole_text():
    assert langid.counts("").sum() == 0
    assert langid.counts("ab").sum() == 3
    assert (langid.counts("x" * 5000 + " tail") != langid.counts("x" * 5000)).any()


def labelled(spark, count=160):
    rows = data.rows(3, count)
    return spark.createDataFrame([r for r in rows if r[2] is None or r[0] is None or r[0] < 200 or r[1] is None or len(r[1]) < 50], data.DOCUMENTS)


def test_held_out_rows_are_told_apart(spark):
    df = labelled(spark).where("doc_id IS NOT NULL AND doc_id <> 3")
    found = {(r.doc_id, r.lang_pred, r.score, r.held_out) for r in langid.op3(df).collect()}
    truth = {r.doc_id: r for r in df.collect()}
    right = total = 0
    for doc_id, lang, score, held in found:
        assert held == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= score <= 1
        text = truth[doc_id].text
        if text is None or not any(map(str.isalpha, text)):
            assert (lang, score) == ("und", 0)
        elif held and doc_id < 200:
            right, total = right + (lang == truth[doc_id].lang), total + 1
    assert total > 10
    assert right == total


def test_labels_of_held_out_rows_are_not_seen(spark):
    df = labelled(spark)
    hidden = df.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert langid.op3(df).exceptAll(langid.op3(hidden)).isEmpty()


def test_no_label_one_label_and_empty(spark):
    df = labelled(spark, 10)
    none = langid.op3(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = langid.op3(df.withColumn("lang", F.lit("en"))).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}
    assert {r.score for r in one} == {1.0, 0.0}
    assert langid.op3(data.empty(spark)).collect() == []


def test_clashing_columns(spark):
    df = data.clashing(spark, ["score", "_key", "a.b", "c1"])
    model = langid.train(df)
    assert langid.predict(df, model).columns == [c for c in df.columns if c != "score"] + ["lang_pred", "score", "ambiguous"]
    assert langid.predict(df, model).count() == df.count()
