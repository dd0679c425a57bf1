"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(folds: int, fold: int) -> Column:
    """True for rows whose crc32 of the id's text leaves ``fold``; false where the id is null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int) -> DataFrame:
    """Texts with a 0/1 ``label``, without the held-out fold, at most ``per_class`` of either label.

    Which rows are taken depends on a hash of doc_id alone. A document with several label rows has
    the largest; null labels do not count.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .where(~held_out(folds, fold) & F.col("label").isin(0, 1))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    taken = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        taken = part if taken is None else taken.unionByName(part)
    # at most 2 x per_class rows of two numbers
    return docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
