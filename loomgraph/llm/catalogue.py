"""Queries of the training-data operators over their whole tables, and their SQL twins where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import ann, langid, line_dedup, media, mixing, ngram_join, pieces, quality, toxicity, warc
from loomgraph.llm.common import read


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(read(spark, sf_dir, "documents"), model_path())


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components_of(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(read(spark, sf_dir, "documents"))


def queries() -> dict:
    ops = (op1_line_dedup, op2_quality, op3_mix, op4_warc, op5_pieces, op6_ngram_join, op7_toxicity, op8_langid, op9_ann, op10_media)
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op3_mix": mixing.ORACLE, "op4_warc": warc.ORACLE, "op6_ngram_join": ngram_join.ORACLE}
