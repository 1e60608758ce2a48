"""Run ledger and releases (W-03, W-04, W-06, J-13, L-06, R-01 to R-04)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.entities import canonicalise
from ledgerloom.operators.ner import apply_ner
from ledgerloom.operators.resolver import linker
from ledgerloom.operators.search import search_view
from ledgerloom.plans.shared import exists, remove
from ledgerloom.sources.ledger import latest_artifacts, latest_per_type, latest_runs  # noqa: F401 (part of this module's interface)
from ledgerloom.sources import commits
from ledgerloom.sources.snapshots import FILE_ROWS, content_manifest, manifest, publish_tables, read_statements

FINAL = ("succeeded", "failed")


def run_ledger(events: DataFrame) -> DataFrame:
    """R-01: (run_id, dataset_name, status, started_at, finished_at, error_message, stats) from events (event_id, run_id, dataset_name, status, at, error_message, stats)."""
    last = F.max_by(F.struct("status", "error_message", "stats"), F.struct("at", "event_id")).alias("e")
    rows = events.groupBy("run_id").agg(F.min("dataset_name").alias("dataset_name"), F.min("at").alias("started_at"), F.max(F.when(F.col("status").isin(*FINAL), F.col("at"))).alias("finished_at"), last)
    return rows.select("run_id", "dataset_name", F.col("e.status").alias("status"), "started_at", F.when(F.col("e.status").isin(*FINAL), F.col("finished_at")).alias("finished_at"), F.when(F.col("e.status") == "failed", F.col("e.error_message")).alias("error_message"), F.col("e.stats").alias("stats"))


def supersede(releases: DataFrame) -> DataFrame:
    """W-06: of published releases only the one published last stays so."""
    published = F.when(F.col("status") == "published", F.struct("published_at", "id"))
    # One row for each release ever made; the greatest is a partial aggregate.
    newest = releases.agg(F.max(published).alias("__newest"))
    rows = releases.join(F.broadcast(newest), F.lit(True))
    old = (F.col("status") == "published") & (F.struct("published_at", "id") < F.col("__newest"))
    return rows.withColumn("status", F.when(old, "superseded").otherwise(F.col("status"))).drop("__newest")


def release_status(events: DataFrame) -> DataFrame:
    """R-04: (id, status, published_at) from events (event_id, release_id, status, at)."""
    rows = events.groupBy(F.col("release_id").alias("id")).agg(F.max_by("status", F.struct("at", "event_id")).alias("status"), F.max(F.when(F.col("status") == "published", F.col("at"))).alias("published_at"))
    return supersede(rows.withColumn("published_at", F.when(F.col("status") == "published", F.col("published_at"))))


def recent_releases(releases: DataFrame, limit: int = 20) -> DataFrame:
    """L-06"""
    return releases.orderBy(F.col("id").desc()).limit(limit)


def release_inputs(runs: DataFrame, artifacts: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """The newest statements artifact of each dataset; a dataset without one is an error before anything is written."""
    found = latest_artifacts(runs, artifacts).where(F.col("dataset_name").isin(*datasets))
    there = {r.dataset_name for r in found.select("dataset_name").collect()}  # at most one row a dataset asked for
    if missing := sorted(set(datasets) - there):
        raise ValueError(f"no successful run with statements: {', '.join(missing)}")
    return found


RELEASE_EVENTS = "event_id string, release_id string, status string, at timestamp, error_message string"


def record_release(spark: SparkSession, root: str, release: str, status: str, error: str | None = None, now: Column | None = None) -> None:
    """One more event of a release in the store's ledger."""
    row = spark.createDataFrame([(uuid.uuid4().hex, release, status, error)], "event_id string, release_id string, status string, error_message string")
    row.withColumn("at", F.current_timestamp() if now is None else now).select("event_id", "release_id", "status", "at", "error_message").coalesce(1).write.mode("append").parquet(f"{root}/release-events")


def release_events(spark: SparkSession, root: str) -> DataFrame:
    """What ``release_status`` reads."""
    path = f"{root}/release-events"
    return spark.read.schema(RELEASE_EVENTS).parquet(path) if exists(spark, path) else spark.createDataFrame([], RELEASE_EVENTS)


def build_release(spark: SparkSession, root: str, runs: DataFrame, artifacts: DataFrame, cands: DataFrame, datasets: Sequence[str], release: str) -> tuple[str, DataFrame, DataFrame]:
    """R-02: the statements of the newest runs after replacements, written under the release; gives the path, its inputs and its manifest.

    Inputs, manifest and the files with their SHA-256 and size are written beside the statements, and the release is recorded as building, then built.
    A build that fails removes what it wrote, is recorded as failed with its error, and can be run again.
    """
    path, about = f"{root}/releases/{release}", f"{root}/release-records/{release}"
    if exists(spark, path):
        raise ValueError(f"release {release} has been built")
    record_release(spark, root, release, "building")
    try:
        release_inputs(runs, artifacts, datasets).write.mode("overwrite").parquet(f"{about}/inputs")
        stmt = read_statements(spark, root, datasets, runs=runs, artifacts=artifacts).drop("run_id")
        apply_ner(stmt, cands).write.mode("errorifexists").option("maxRecordsPerFile", FILE_ROWS).partitionBy("dataset").parquet(path)
        manifest(spark, path).write.mode("overwrite").parquet(f"{about}/files")
        content_manifest(spark.read.parquet(path)).write.mode("overwrite").parquet(f"{about}/manifest")
    except Exception as e:
        remove(spark, path)
        remove(spark, about)
        record_release(spark, root, release, "failed", str(e)[:2000])
        raise
    record_release(spark, root, release, "built")
    return path, spark.read.parquet(f"{about}/inputs"), spark.read.parquet(f"{about}/manifest")


PUBLISHABLE = ("built", "published", "superseded")


def publish(spark: SparkSession, root: str, release: str, edges: DataFrame, target: str, working: str) -> dict[str, str]:
    """R-03: the release's statements canonicalised by the live edges, the edges and the search view become what the target holds; gives their paths.

    The ledger says whether the release may be published, and its records must be there. All is written to a version of its own, which
    counts when the target's log names it; then the release is recorded as published. A publish that fails is recorded as failed and leaves the
    target as it was; the release can be built again under another name.
    """
    if target.rstrip("/") == working.rstrip("/"):
        raise ValueError("the target must differ from the working store")
    known = release_status(release_events(spark, root)).where(F.col("id") == release).first()
    if known is None:
        raise ValueError(f"there is no release {release}")
    if known.status not in PUBLISHABLE:
        raise ValueError(f"a release that is {known.status} can't be published")
    path, about = f"{root}/releases/{release}", f"{root}/release-records/{release}"
    if not exists(spark, path) or not exists(spark, f"{about}/manifest"):
        raise ValueError(f"release {release} has no statements")
    if not exists(spark, f"{about}/inputs") or spark.read.parquet(f"{about}/inputs").isEmpty():
        raise ValueError(f"release {release} has no inputs")
    version = uuid.uuid4().hex
    try:
        paths = publish_tables(canonicalise(spark.read.parquet(path), linker(edges)), edges, target, version)
        paths["search"] = f"{target}/{version}/search"
        search_view(spark.read.parquet(paths["statements"])).write.parquet(paths["search"])
        commits.commit(spark, target, lambda now: {"release": release, "paths": paths})
    except Exception as e:
        record_release(spark, root, release, "failed", str(e)[:2000])
        raise
    record_release(spark, root, release, "published")
    return paths


def published(spark: SparkSession, target: str) -> dict | None:
    """What the target holds: the release, and the paths of its tables by kind; None before the first publish."""
    return commits.newest(spark, target)
