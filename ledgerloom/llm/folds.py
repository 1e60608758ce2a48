"""Folds and bounded training samples shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(parts: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id written as text, modulo parts."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def by_hash(ids: DataFrame, rows: int) -> DataFrame:
    """At most rows of the doc_ids, the same ones every time."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """(doc_id, label, text): for each picked (doc_id, label), whose number the caller has bounded, one text of the doc_id: the first by hash, then by text."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")
    return whole.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(first).select("doc_id", "label", "first.text")
