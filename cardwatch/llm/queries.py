"""The registered queries of the corpus operators: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (annforest, arcwarc, langid, linkgraph, oracle, packing, phrases, pieces, quality, simhash,
               suffixdedup, tokencounts, tokenstore, whitening)
from .common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.SIGNALS, "base_failed", "kept")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return annforest.search(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.round_trip(table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arcwarc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeat_digest(table(spark, sf_dir, "documents"))


def op9_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, sf_dir, "documents"), limit=1024)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_language_id, op2_quality_rules, op3_packing, op4_prefix_forest, op5_token_store,
        op6_pieces, op7_arc_to_warc, op8_suffix_dedup, op9_link_graph, op10_simhash,
        op11_whitening, op12_token_counts, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
