"""Statement snapshots: reading, writing, loading, exporting, publishing."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.model import STMT, conform
from ledgerloom.plans.shared import exists
from ledgerloom.sources import commits
from ledgerloom.sources.ledger import latest_artifacts

log = logging.getLogger(__name__)

#: Statements in a file of a release at most: some 100 MB.
FILE_ROWS = 1_000_000


def write_snapshot(stmt: DataFrame, root: str, dataset: str, run_id: str) -> str:
    """S-02: an immutable snapshot of one run; it is the dataset's latest once its run is recorded as succeeded."""
    path = f"{root}/dataset-runs/dataset={dataset}/run_id={run_id}"
    conform(stmt).drop("dataset").write.mode("errorifexists").parquet(path)
    return path


def read_runs(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """The snapshots of all runs of the datasets (all, if None), failed and older ones too, with run_id; a dataset without one is left out with a warning."""
    base = f"{root}/dataset-runs"
    if not exists(spark, base):
        log.warning("no snapshots in %s", root)
        return conform(spark.createDataFrame([], STMT)).select(F.lit(None).cast("string").alias("run_id"), *STMT.fieldNames())
    rows = spark.read.schema("run_id string, dataset string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STMT if f.name != "dataset")).option("basePath", base).parquet(base)
    if datasets is not None:
        for d in datasets:
            if not exists(spark, f"{base}/dataset={d}"):
                log.warning("no snapshot of %s", d)
        rows = rows.where(F.col("dataset").isin(*datasets))
    return rows.select("run_id", *STMT.fieldNames())


def read_statements(spark: SparkSession, root: str, datasets: Sequence[str] | None = None, run_id: str | None = None, runs: DataFrame | None = None, artifacts: DataFrame | None = None) -> DataFrame:
    """S-01: the latest snapshot of each dataset (all, if None), with run_id; run_id asks for that run of one dataset instead.

    The ledger decides which is the latest: runs (id, dataset_name, status, started_at) and artifacts (id, dataset_run_id, artifact_type,
    storage_key), as in J-13; a dataset without a succeeded run that has statements is left out. Without a ledger a dataset with
    several runs is an error.
    """
    if run_id is not None and (datasets is None or len(datasets) != 1):
        raise ValueError("run_id needs exactly one dataset")
    rows = read_runs(spark, root, datasets)
    if run_id is not None:
        return rows.where(F.col("run_id") == run_id)
    if runs is None or artifacts is None:
        several = rows.groupBy("dataset").agg(F.count_distinct("run_id").alias("n")).where("n > 1").first()
        if several:
            raise ValueError(f"{several.dataset} has {several.n} runs, and no ledger says which is the latest")
        return rows
    latest = latest_artifacts(runs, artifacts).select(F.col("dataset_name").alias("dataset"), F.col("dataset_run_id").cast("string").alias("run_id"))
    # One row a dataset; both columns are partitions of the store, so the others aren't read.
    return rows.join(F.broadcast(latest), ["dataset", "run_id"], "left_semi").select("run_id", *STMT.fieldNames())


def combine(*stmts: DataFrame) -> DataFrame:
    """U-01: bag union."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stmts)


def carry_first_seen(new: DataFrame, previous: DataFrame | None, run_time: Column) -> DataFrame:
    """J-02: first_seen of the statement in the previous snapshot, else the run's time; last_seen is the run's time."""
    if previous is None:
        return new.withColumn("first_seen", run_time).withColumn("last_seen", run_time)
    old = previous.groupBy("id").agg(F.min("first_seen").alias("__first"))
    return new.drop("first_seen").join(old, "id", "left").withColumn("first_seen", F.coalesce("__first", run_time)).withColumn("last_seen", run_time).drop("__first")


def load_statements(stmt: DataFrame, target: str, datasets: Sequence[str], run_id: str | None = None, known: Sequence[str] | None = None) -> list[str]:
    """S-10: replace the statements of the datasets in the target, leaving others untouched; gives the datasets that were loaded.

    A dataset without statements has none in the target then. An unknown dataset is logged and left out; a run_id needs one dataset, and
    stmt must hold rows of that run. The rows lie in a folder of their own that nobody reads before the target's log names it, so
    readers see a load whole or not at all, and one that dies midway has changed nothing.
    """
    if run_id is not None:
        if len(datasets) != 1:
            raise ValueError("run_id needs exactly one dataset")
        stmt = stmt.where((F.col("run_id") == run_id) & (F.col("dataset") == datasets[0]))
        if stmt.isEmpty():
            raise ValueError(f"run {run_id} doesn't belong to {datasets[0]}")
    wanted = [d for d in datasets if known is None or d in known]
    for d in set(datasets) - set(wanted):
        log.error("unknown dataset %s", d)
    if wanted:
        rows, version = conform(stmt.where(F.col("dataset").isin(*wanted))), uuid.uuid4().hex
        spark, path = rows.sparkSession, f"{target}/versions/{version}"
        rows.write.partitionBy("dataset").parquet(path)
        there = {r.dataset for r in spark.read.schema(STMT).parquet(path).select("dataset").distinct().collect()}  # at most as many as asked for
        # The load counts from here on, whole.
        commits.commit(spark, target, lambda now: {"datasets": {d: v for d, v in (now or {}).get("datasets", {}).items() if d not in wanted} | {d: version for d in sorted(there)}})
    return wanted


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """The statements of the newest whole load of each dataset; none before the first."""
    versions: dict[str, list[str]] = {}
    for d, v in ((commits.newest(spark, target) or {}).get("datasets", {})).items():
        versions.setdefault(v, []).append(d)
    parts = [spark.read.schema(STMT).parquet(f"{target}/versions/{v}").where(F.col("dataset").isin(*ds)).select(*STMT.fieldNames()) for v, ds in sorted(versions.items())]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], STMT)


def export_entities(entities: DataFrame, path: str, dataset: str | None = None) -> None:
    """S-11: a JSON line for each entity that is its own canonical one."""
    own = entities.where(F.col("id") == F.col("canonical_id")) if "canonical_id" in entities.columns else entities
    if dataset is not None:
        own = own.where(F.array_contains("datasets", dataset))
    own.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def live_edges(edges: DataFrame) -> DataFrame:
    return edges.where("deleted_at is null")


def publish_tables(stmt: DataFrame, edges: DataFrame, target: str, version: str) -> dict[str, str]:
    """S-12: a full copy of the statements and the live edges under a version of its own."""
    paths = {"statements": f"{target}/{version}/statements", "edges": f"{target}/{version}/edges"}
    stmt.write.mode("overwrite").parquet(paths["statements"])
    live_edges(edges).write.mode("overwrite").parquet(paths["edges"])
    return paths


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A-09: key, sha256 and size of each file below path. A task holds a file at a time, so writers bound their files (``FILE_ROWS``)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("artifact_key"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


def content_manifest(stmt: DataFrame) -> DataFrame:
    """A-09: rows of each dataset, and the sum of their ids' first 60 bits, which doesn't depend on order and in which a row that stands twice counts twice."""
    return stmt.groupBy("dataset").agg(F.count("*").alias("n_statements"), F.sum(F.conv(F.substring("id", 1, 15), 16, 10).cast("decimal(20,0)")).cast("string").alias("content_hash"))
