"""Where a job cuts its lineage: files in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession

_own: dict[str, str] = {}
#: Where this is set, Spark removes the shuffle files of a query at its end; else they stay until the driver's garbage is collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a temporary one of this application, but only with a local master: executors of a cluster wouldn't see it, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="spark-ledgerloom-")
    return f"file://{_own[app]}"


def job_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/ledgerloom/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{job_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: later jobs neither repeat its work nor depend on the executors that did it.

    path: a folder to write over, which df mustn't read. What is staged lasts until ``clear``. The shuffles that made it go with the write,
    so the disk holds those of one step at a time.
    """
    spark, path = df.sparkSession, path or fresh_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    """The store and its form of the path, through Hadoop's file systems: Spark has no DataFrame call that asks for or removes a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    store, p = _at(spark, path)
    return store.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    store, p = _at(spark, path)
    store.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing where there is none."""
    store, p = _at(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(p)) if store.exists(p) else []


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file; False where it is there already."""
    store, p = _at(spark, path)
    try:
        out = store.create(p, False)
    except Py4JJavaError as e:
        if store.exists(p):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_small(spark: SparkSession, path: str) -> str:
    store, p = _at(spark, path)
    held = store.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    finally:
        held.close()


def once(df: DataFrame, keys: Sequence[str], *columns: Column) -> DataFrame:
    """df with columns that cost much and follow from keys alone: worked out for each distinct value of the keys and joined back.

    Dates, say, are few however many rows have them. What was worked out is staged, so where it is small no row of df is shuffled.
    """
    # A fixed number of partitions: the values are few bytes, and adaptive execution would work them out in one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = df.select(*keys).distinct().repartition(tasks, *keys).select(*keys, *columns)
    few = staged(few.withColumnsRenamed({k: f"__{k}" for k in keys}), "once")
    joined = df.join(few, [df[k].eqNullSafe(few[f"__{k}"]) for k in keys], "left")
    return joined.drop(*[f"__{k}" for k in keys])


#: Bytes of input files for a partition of rows that will be unfolded: Parquet holds a row of short columns in some 20 bytes, its statements take 80 times that.
UNFOLDED_BYTES = 1 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that df reads."""
    size = 0
    for path in df.inputFiles():
        store, p = _at(df.sparkSession, path)
        size += store.getFileStatus(p).getLen()
    return size


def dealt(df: DataFrame, *keys: str | Column) -> DataFrame:
    """df by the hash of keys, in partitions whose number grows with its input files, so that what a task holds doesn't.

    The number is fixed, one for each core at least: adaptive execution goes by the bytes of rows as they travel, and would put together what is many times as large, or much work, afterwards.
    """
    return df.repartition(max(-(-input_bytes(df) // UNFOLDED_BYTES), df.sparkSession.sparkContext.defaultParallelism), *keys)


def clear(spark: SparkSession) -> None:
    """Removes all that this application has staged; to be called when its results have been written elsewhere."""
    remove(spark, job_dir(spark))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
