"""Carrying first_seen over a stream of statement batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans.model import conform
from ledgerloom.plans.shared import exists
from ledgerloom.sources.snapshots import carry_first_seen


def carry_stream(stmt: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch is a snapshot: it carries first_seen (J-02) from the version before it and becomes the next version.

    A batch that is run again after a failure reads the same version and replaces its own. Where the version before it is
    missing, all first_seen would be lost, so that is an error.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        before = f"{store}/version={number - 1}"
        if number and not exists(spark, before):
            raise FileNotFoundError(f"{before} is missing, and with it the first_seen of its statements")
        previous = spark.read.parquet(before) if number else None
        conform(carry_first_seen(rows, previous, F.col("last_seen"))).write.mode("overwrite").parquet(f"{store}/version={number}")

    return stmt.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
