"""Corpus pipeline: quality rules, language identification, near-duplicates, repeated
passages, packing. Every stage reads all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import langid, packing, quality, simhash, suffixdedup
from cardwatch.llm.common import materialize, table

#: A text whose best language has a lower probability is rejected; lower where labelled texts
#: themselves score lower (few rows to learn from).
MIN_LANGUAGE_SCORE = 0.4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with an identified language. The network is fitted on these rows; where none of
    them can teach it (a label, a letter, not held out), all are kept. A text whose windows
    are split among three or more languages can stay below the score and go."""
    model = langid.fit(docs)
    if not model["labels"]:
        return docs
    return langid.keep_languages(
        docs, model, min_score=langid.calibrated(docs, model, MIN_LANGUAGE_SCORE))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first_of_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffixdedup.remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("language_id", language_id),
          ("simhash_near_dedup", simhash_near_dedup), ("suffix_array_dedup", suffix_array_dedup),
          ("packing", pack)]

#: SQL has neither the network nor the tokenizer; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
