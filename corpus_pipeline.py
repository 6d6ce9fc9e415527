"""From raw documents to packed training sequences: one operator per stage, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplan.llm import common, exact_dedup, language, ngram_join, packing, toxicity

LEAST_LANGUAGE_SCORE = 0.4
TOXIC_SCORE = 0.5
NEAR = ngram_join.Join(words=5, num=80, den=100, growth=1.2)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose language is a guess, go."""
    scored = language.with_language(docs, "__lang", "__lang_score")
    kept = scored.filter((F.col("__lang") != language.UNKNOWN) & (F.col("__lang_score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go."""
    scored = toxicity.with_score(docs, common.labels(spark, sf_dir), "__toxic")
    return scored.filter(F.col("__toxic") < TOXIC_SCORE).select(*docs.columns)


def one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return exact_dedup.keep_one(docs)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word shingles the smallest id stays."""
    return ngram_join.one_per_group(docs, NEAR)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences of what is left."""
    return packing.pack(docs)


STAGES = [("language", known_language), ("toxicity", not_toxic), ("exact_dedup", one_copy), ("near_dedup", one_of_near),
          ("packing", packed)]

#: Trained scores and token ids are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
