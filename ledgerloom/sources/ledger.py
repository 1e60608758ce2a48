"""Which runs and artifacts are the latest (W-03, W-04, J-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_runs(runs: DataFrame) -> DataFrame:
    """W-03: the newest succeeded run of each dataset, by start, then id."""
    best = runs.where("status = 'succeeded'").groupBy("dataset_name").agg(F.max(F.struct("started_at", "id")).alias("m"))
    return best.select("dataset_name", F.col("m.id").alias("id"), F.col("m.started_at").alias("started_at"))


def latest_per_type(artifacts: DataFrame, owner: str = "dataset_run_id") -> DataFrame:
    """W-04: the artifact with the highest id of each run (or release) and type."""
    w = Window.partitionBy(owner, "artifact_type").orderBy(F.col("id").desc())
    return artifacts.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def latest_artifacts(runs: DataFrame, artifacts: DataFrame, type: str = "statements_pack") -> DataFrame:
    """J-13: of each dataset the newest artifact of the type among its succeeded runs: by the run's start and id, then the artifact's id."""
    good = runs.where("status = 'succeeded'").select(F.col("id").alias("dataset_run_id"), "dataset_name", "started_at")
    rows = artifacts.where(F.col("artifact_type") == type).join(good, "dataset_run_id")
    best = rows.groupBy("dataset_name").agg(F.max(F.struct("started_at", "dataset_run_id", "id", "storage_key")).alias("m"))
    return best.select("dataset_name", F.col("m.dataset_run_id").alias("dataset_run_id"), F.col("m.id").alias("artifact_id"), F.col("m.storage_key").alias("storage_key"))
