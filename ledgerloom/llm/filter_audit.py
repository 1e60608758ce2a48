"""How filters interact: what each removes, alone and after others, in every order.

Filters A to E fail a document: A under 50 words; B distinct words under 65 in a hundred; C capitals A-Z over 5 in a hundred
code points; D any of ``#$%&*|``; E a text that a smaller doc_id has too.  The failures of a document are a mask
of five bits, and all that an order removes, keeps or loses follows from how many documents of a part have each mask.

Counting is an incremental stream with retraction.  The files of the table are read as available-now micro-batches.
A to D come from a document's own text.  For E the state of a text is its smallest doc_id so far and where the documents that have it
were counted; a smaller id that arrives later retracts them from their counter (a row of -n) and counts them again
under the mask with E.  Each micro-batch writes its sums of such deltas over its own folder, so one that is run again replaces
its own; a run that died goes on from its checkpoint when it is given the same folder.

Before the shuffle to the state a task combines its rows of one text to one, so a text that a third of all
documents share is a row a batch of rows.  Texts are known by their SHA-256.  A key of the state is a group of some 256 texts,
because a call for each text would cost more than its work; a checkpoint keeps its number of partitions, so that follows the number of
documents.  The state lies in the store that the session names (``spark.sql.streaming.stateStore.providerClass``): Spark's default holds it in executors'
memory, some 150 bytes a text; where that is too much, name RocksDB's, which holds it on disk.

Defined cases: null text is empty; a null source is the part ''; a null doc_id is never larger than another, so E never holds for it, and it
makes no other document fail; rows of the smallest doc_id don't fail E, however many; a doc_id with several labels is good or toxic
if one of them says so; an empty table gives no rows; other columns are ignored.  Rows of one doc_id with different texts, however many,
meet in one task of the join with the labels, as rows of some 60 bytes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.window import Window

from ledgerloom.plans.shared import exists, fresh_path

FILTERS = "ABCDE"
SAME = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
WORD = r"[\x20\x09-\x0D]+"
#: How the documents of a text in one batch of rows stand to its smallest doc_id there: they have it, they have a larger one, or none.
HAVE, LARGER, NONE = 0, 1, 2
COMBINED = "bucket long, same binary, mask int, doc_id long, who array<struct<part:string,good:boolean,toxic:boolean,kind:int,n:long>>"
STATE = "texts array<struct<same:binary,doc_id:long,mask:int,who:array<struct<part:string,good:boolean,toxic:boolean,n:long>>>>"
DELTAS = "part string, good boolean, toxic boolean, mask int, delta long"

def own_mask(text: str, words: str) -> Column:
    """The bits of A to D, from a text and its words (null: none)."""
    n, capitals = F.coalesce(F.size(words), F.lit(0)), F.regexp_count(text, F.lit("[A-Z]"))
    fails = [n < 50, F.coalesce(F.size(F.array_distinct(words)), F.lit(0)) * 100 < n * 65, capitals * 100 > F.length(text) * 5, F.col(text).rlike(r"[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def masked(docs: DataFrame, buckets: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "part", "text", F.trim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")).alias("bare"))
    rows = rows.select("doc_id", "part", "text", F.when(F.col("bare") != "", F.split("bare", WORD)).alias("words"))
    rows = rows.select("doc_id", "part", own_mask("text", "words").alias("mask"), F.unhex(F.sha2("text", 256)).alias("same"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("same"), F.lit(buckets)))


def combine(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of a batch, one for each text: its smallest doc_id there, and how many documents of each kind."""
    who = pa.list_(pa.struct([("part", pa.string()), ("good", pa.bool_()), ("toxic", pa.bool_()), ("kind", pa.int32()), ("n", pa.int64())]))
    for frame in frames:
        texts: dict[bytes, list] = {}
        for bucket, same, mask, doc_id, part, good, toxic in zip(*(c.to_pylist() for c in frame.columns)):
            e = texts.setdefault(same, [bucket, mask, None, Counter()])
            if doc_id is None:
                kind = NONE
            elif e[2] is None or doc_id < e[2]:
                e[2], kind = doc_id, HAVE
                e[3] = _moved(e[3])
            else:
                kind = HAVE if doc_id == e[2] else LARGER
            e[3][part, good, toxic, kind] += 1
        rows = [[dict(zip(("part", "good", "toxic", "kind", "n"), (*k, n))) for k, n in e[3].items()] for e in texts.values()]
        columns = [pa.array([e[i] for e in texts.values()], t) for i, t in ((0, pa.int64()), (1, pa.int32()), (2, pa.int64()))]
        yield pa.RecordBatch.from_arrays([columns[0], pa.array(texts, pa.binary()), columns[1], columns[2], pa.array(rows, who)], ["bucket", "same", "mask", "doc_id", "who"])


def _moved(counts: Counter) -> Counter:
    """The documents that had the smallest doc_id have a larger one now."""
    out: Counter = Counter()
    for (part, good, toxic, kind), n in counts.items():
        out[part, good, toxic, LARGER if kind == HAVE else kind] += n
    return out


def retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Takes a group's rows one by one into the state of its texts; gives what the counters change by."""
    texts = {bytes(t[0]): [t[1], t[2], {tuple(w[:3]): w[3] for w in t[3]}] for t in state.get[0]} if state.exists else {}
    deltas: Counter = Counter()
    for frame in frames:
        for same, mask, doc_id, who in zip(frame["same"], frame["mask"], frame["doc_id"].astype("Int64"), frame["who"]):
            same, mask, doc_id = bytes(same), int(mask), None if doc_id is pd.NA else int(doc_id)
            rows = [((w["part"], bool(w["good"]), bool(w["toxic"])), int(w["kind"]), int(w["n"])) for w in who]
            have = {k: n for k, kind, n in rows if kind == HAVE}
            known = texts.get(same)
            late = False  # what has the batch's smallest id fails E
            if doc_id is not None:
                if known is None:
                    texts[same] = [doc_id, mask, have]
                elif doc_id < known[0]:
                    for k, n in known[2].items():
                        deltas[*k, mask] -= n
                        deltas[*k, mask | SAME] += n
                    known[0], known[2] = doc_id, have
                elif doc_id == known[0]:
                    for k, n in have.items():
                        known[2][k] = known[2].get(k, 0) + n
                else:
                    late = True
            for k, kind, n in rows:
                deltas[*k, mask | (SAME if kind == LARGER or kind == HAVE and late else 0)] += n
    state.update(([(same, t[0], t[1], [(*k, n) for k, n in t[2].items()]) for same, t in texts.items()],))
    rows = [(*k, n) for k, n in deltas.items() if n]
    yield pd.DataFrame(rows, columns=["part", "good", "toxic", "mask", "delta"]).astype({"mask": "int32", "delta": "int64", "good": "bool", "toxic": "bool", "part": "object"})


def count_masks(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, batches: int = 4, texts_a_key: int = 256, docs_a_partition: int = 1_000_000) -> DataFrame:
    """(part, mask, n, good, toxic) over all documents in the Parquet files at path, read in about ``batches`` micro-batches.

    folder: where the checkpoint and the deltas lie; a run that died goes on when it is given the same one.
    """
    folder = folder or fresh_path(spark, "audit")
    table = spark.read.parquet(path)
    n = table.count()
    buckets = max(1, math.ceil(n / texts_a_key))
    files = max(1, math.ceil(len(table.inputFiles()) / batches))
    # A stream wants a folder or a pattern; a pattern stands for a file too.
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # Rows without doc_id match nothing; their text's hash beside the key spreads them.
    spread = F.when(F.col("doc_id").isNull(), F.col("bucket")).otherwise(F.lit(0))
    rows = masked(stream, buckets).withColumn("spread", spread).join(said.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
    rows = rows.select("bucket", "same", "mask", "doc_id", "part", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    deltas = rows.mapInArrow(combine, COMBINED).groupBy("bucket").applyInPandasWithState(retract, DELTAS, STATE, "update", "NoTimeout")

    def batch(frame: DataFrame, number: int) -> None:
        frame.groupBy("part", "mask", "good", "toxic").agg(F.sum("delta").alias("delta")).write.mode("overwrite").parquet(f"{folder}/deltas/batch={number}")

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", max(spark.sparkContext.defaultParallelism, math.ceil(n / docs_a_partition)))
    try:  # a query takes the settings that hold when it starts
        query = deltas.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    schema = "part string, mask int, good boolean, toxic boolean, delta long"
    found = spark.read.schema(schema).parquet(f"{folder}/deltas") if exists(spark, f"{folder}/deltas") else spark.createDataFrame([], schema)
    total = lambda c: F.sum(F.when(c, F.col("delta")).otherwise(F.lit(0)))
    return found.groupBy("part", "mask").agg(F.sum("delta").alias("n"), total(F.col("good")).alias("good"), total(F.col("toxic")).alias("toxic")).where("n <> 0")


def interactions(counters: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step."""
    parts = counters.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 at most
    rows = parts.select("part", "masks", F.explode(F.array(*[F.lit(o) for o in ORDERS])).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    at = F.expr("substring(filter_order, step, 1)")
    value = lambda c: sum((F.when(F.contains(c, F.lit(x)), F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(FILTERS)), F.lit(0))
    rows = rows.select("*", at.alias("letter"), value(at).alias("own"), value(F.expr("substring(filter_order, 1, step - 1)")).alias("earlier"))

    def total(field: str, holds) -> Column:
        return F.aggregate(F.filter("masks", lambda m: holds(m["mask"])), F.lit(0).cast("long"), lambda a, m: a + m[field])

    own, earlier = F.col("own"), F.col("earlier")
    removed = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(earlier) == 0)
    rows = rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "letter",
        total("n", lambda m: m.bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"), total("n", removed).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(earlier) != 0)).alias("redundant"), total("n", lambda m: m == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
    )
    # 120 rows: the step at which the letter stands in each order.
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def audit(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, batches: int = 4) -> DataFrame:
    return interactions(count_masks(spark, path, labels, folder, batches))
