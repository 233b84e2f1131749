"""A training corpus in five stages; each takes what the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of ``documents``; the last returns the
packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegrain.llm import common, decontamination, language_id, near_duplicates, packing, queries, secret_scan


def _resized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns asked for, with the number of characters of the text as it is now."""
    sized = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs
    return sized.select(*columns)


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    learnt = docs.select("doc_id", "text", "lang").filter(~F.coalesce(queries.in_fold(2, 4), F.lit(False)))
    return language_id.keep_identified(docs, language_id.learn(learnt)).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: those of 80 % similarity or more."""
    return near_duplicates.keep_one(docs, percent=80).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that benchmark passages make up; passages in others are cut out."""
    return _resized(decontamination.clean(docs, common.table(spark, sf_dir, "benchmark")), docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return _resized(secret_scan.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document, placed in sequences of 2048."""
    return packing.pack(docs, queries.vocabulary("word_bpe_49k.json"))


STAGES = [("language_id", identify), ("near_duplicates", deduplicate), ("decontamination", decontaminate), ("secret_scan", redact), ("packing", pack)]

#: No SQL gives these rows: languages are told by a learned model, and pieces are placed by a vocabulary file.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared scratch folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
