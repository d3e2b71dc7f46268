"""Registered queries of this folder: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyspan.llm import (
    ann,
    bpe,
    cws,
    filter_audit,
    langid,
    linededup,
    neardup,
    packing,
    pii,
    repetition,
    secret_scan,
    sharding,
    variants,
)
from tallyspan.llm.common import documents, share_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {"op8_line_dedup": linededup.ORACLE, "op12_filter_audit": filter_audit.ORACLE}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return run


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), TOKENIZER)


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op4(documents(spark, sf_dir), TOKENIZER)


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op3(documents(spark, sf_dir))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.op7(documents(spark, sf_dir))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.op8(documents(spark, sf_dir))


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op9(documents(spark, sf_dir))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op10(documents(spark, sf_dir))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.op6(documents(spark, sf_dir))


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.op2(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op5(documents(spark, sf_dir))


@query
def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.op11(documents(spark, sf_dir))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.op12(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.op13(documents(spark, sf_dir))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
