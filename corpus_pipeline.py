"""From raw documents to packed training sequences, in five stages.

A stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the docs of the next one.  All but the last return the columns of documents.  A
stage judges what its predecessor kept, nothing else:

1. language: texts without a letter, and texts whose language is ambiguous, go; a missing
   ``lang`` is filled in.  The model learns from the labelled rows of docs.
2. lines: repeated lines go, but for the first document that holds them.
3. near_duplicates: one document of each class of near-duplicates stays, that with the smallest id.
4. personal_data: every span of personal data becomes its kind in brackets.
5. packing: pieces of token sequences in windows of 2048.

``n_chars`` follows the text.  Null ids, null and empty texts, repeated rows and empty tables
are handled as the operators say.  SQL cannot express the stages, so ``ORACLE_SQL`` is None; the
tests hold every stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import langid, linededup, neardup, packing, pii
from tallyspan.llm.common import documents, plain, position, share_package
from tallyspan.session import store_and_reload

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ORACLE_SQL = None


class Plain:
    """Documents under plain column names, so that no extra column clashes with what an
    operator adds."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        share_package(spark)
        self.names, self.docs = docs.columns, plain(docs)
        self.key, self.text, self.lang = (f"c{position(docs, n)}" for n in ("doc_id", "text", "lang"))
        self.n_chars = [f"c{i}" for i, n in enumerate(docs.columns) if n == "n_chars"]

    def restored(self, changed: DataFrame) -> DataFrame:
        """The columns of the documents; ``n_chars`` is the length of the text that is left."""
        lengths = {c: F.length(self.text).cast("bigint") for c in self.n_chars}
        return changed.withColumns(lengths).select(*self.docs.columns).toDF(*self.names)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    at = Plain(spark, docs)
    model = langid.train(at.docs, key=at.key, text=at.text, label=at.lang)
    written = at.docs.where(F.col(at.text).rlike(r"\p{L}"))
    known = langid.predict(written, model, text=at.text).where(~F.col("ambiguous"))
    if model.languages:
        known = known.withColumn(at.lang, F.coalesce(at.lang, "lang_pred"))
    return at.restored(known)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    at = Plain(spark, docs)
    return at.restored(linededup.dedup_lines(at.docs, key=at.key, text=at.text))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    return neardup.first_of_classes(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    at = Plain(spark, docs)
    model = pii.train(at.docs, key=at.key, text=at.text)
    return at.restored(pii.redact(at.docs, model, text=at.text))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_package(spark)
    # Less is remembered than by default: executors have been through four stages by now.
    return packing.pack(docs, TOKENIZER, cache=100_000, slice_bytes=4 << 20)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store_and_reload(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
