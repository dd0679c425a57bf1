"""The corpus pipeline: from raw documents to a mixed training set, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, all columns of ``documents``; the last
adds the drawing's columns. ``run`` writes every stage to the shared folder and reads it again, so a
lost executor costs a stage at most. What a stage wrote on its way is removed behind it, all but the result at the end.

Null and empty texts pass: they are not toxic, stand alone among duplicates, contain no passage or
secret, and cost the mix nothing. Rows without a doc_id go through every stage but stand alone among
duplicates. Rows with one doc_id and equal text share their fate and do not multiply. Columns beyond
those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citystream.llm import decontaminate, mixing, neardup, secrets, toxicity
from citystream.session import cut, removed_after, scratch

ORACLE_SQL = None  # trained and hash-seeded stages have no SQL form; tests/llm compares with brute force


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    kept = cut(neardup.near_duplicates(docs).where("kept").select("doc_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.without_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every drawn copy of every document, with its epoch and its place in the order (part)."""
    return mixing.draw(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark, "mixed")
    with removed_after(spark):
        for name, stage in STAGES:
            path = done if name == STAGES[-1][0] else scratch(spark, name)
            with removed_after(spark):
                docs = cut(stage(spark, docs, sf_dir), path)
    return docs
