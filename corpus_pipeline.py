"""Documents to packed training sequences: toxicity, quality, near-duplicates, packing.

Defined cases, for the stages as for the whole: null text is empty; very long texts are scored, compared
and packed whole; repeated rows are near-duplicates of each other, so one stays; rows
without doc_id or with a doc_id that others have too are documents of their own by their texts;
where no model can be fitted (no labels, or none of one kind left) a filter keeps all rows; an empty table gives
no rows; other columns, whatever their names, pass through to the last stage, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import packing, quality, simhash, toxicity
from ledgerloom.plans.shared import read_table, staged

#: No SQL expresses the classifiers; tests hold each stage against a brute-force version.
ORACLE_SQL = None
TOXIC, GOOD = 0.5, 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.keep_clean(docs, toxicity.train(docs, labels), TOXIC)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay where no model could be fitted (no document labelled good is left)."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = staged(quality.described(docs), "described")
    model = quality.train(rows, labels)
    return quality.keep_good(rows, model, GOOD) if model.edges is not None else docs


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality", keep_good), ("simhash", drop_near_duplicates), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
