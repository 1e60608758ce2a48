"""Token-id files: one zstandard frame for each document, a shared dictionary, an offset index.

Layout of a token-file folder (all through Spark's writers, so any store works):

* ``dictionary/``: one row (dictionary_hash, data), trained on the serialized ids
  of a bounded sample of documents (``sample_docs`` documents by hash order, the
  first ``sample_ids`` ids of each; these bounds touch the dictionary only);
* ``blocks/``: one file a shard, shards and blocks in ascending doc_id order.  A
  block has the frames of up to ``block_docs`` documents (or about 1 MB of ids)
  laid end to end, the offset of each, doc ids, token counts, the ids before it
  in its shard, the width of an id in bytes, and the dictionary's hash.

A reader that wants one short document reads one block and decompresses one frame.

Defined cases: null text is empty (its ids: the end id); null doc_ids come first;
rows with equal doc_id are ordered by their text's hash, then text; a very long text is one frame, in a
block of its own; an empty table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.folds import by_hash, texts
from ledgerloom.llm.tokens import batches, byte_encoder, tokenizer_path

BLOCKS = "shard int, block int, first_doc long, last_doc long, doc_ids array<long>, token_counts array<long>, first_token long, offsets array<long>, frames binary, width int, dictionary_hash string"
LEVEL = 3


def train_dictionary(samples: Sequence[bytes], size: int) -> bytes:
    """Too few samples to train on: their own bytes are the dictionary."""
    try:
        return zstandard.train_dictionary(size, list(samples)).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, shards: int | None = None,
    block_docs: int = 64, block_ids: int = 1 << 18, dictionary_bytes: int = 1 << 15, sample_docs: int = 500, sample_ids: int = 2048,
) -> str:
    """Encode whole texts and write them in ascending doc_id order; gives the folder."""
    spark, path = docs.sparkSession, tokenizer or tokenizer_path("byte_bpe_50k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def ids_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        encoder = byte_encoder(path)
        ids, offs = encoder.encode(texts)
        return ids, offs, 2 if max(encoder.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def sample(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            ids, offs, width = ids_of(frame.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([np.append(ids[a : min(b, a + sample_ids)], end_id).astype(f"<u{width}").tobytes() for a, b in zip(offs[:-1], offs[1:])], pa.binary())], ["data"])

    # The sample is chosen by ids alone, and at most sample_docs of them are broadcast.
    picked = by_hash(rows.where("doc_id is not null").select("doc_id").distinct(), sample_docs).withColumn("label", F.lit(0))
    picked = texts(rows, picked).select("doc_id", "text")
    data = train_dictionary(sorted(bytes(r.data) for r in picked.mapInArrow(sample, "data binary").collect()), dictionary_bytes)
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(digest, bytearray(data))], "dictionary_hash string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(data)

    def blocks(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _dictionary(shared.value)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=own) if own else zstandard.ZstdCompressor(level=LEVEL)
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, before, held
            counts = [n for _, n, _ in held]
            offsets = np.concatenate([[0], np.cumsum([len(f) for _, _, f in held])])
            known = [d for d, _, _ in held if d is not None]
            row = {
                "shard": shard, "block": block, "first_doc": min(known, default=None), "last_doc": max(known, default=None), "doc_ids": [d for d, _, _ in held], "token_counts": counts, "first_token": before,
                "offsets": offsets.tolist(), "frames": b"".join(f for _, _, f in held), "width": width, "dictionary_hash": digest,
            }
            block, before, held = block + 1, before + sum(counts), []
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for frame in frames:
            doc_ids, texts = frame.column(0).to_pylist(), frame.column(1).to_pylist()
            for a, b in batches(texts):
                ids, offs, width = ids_of(texts[a:b])
                for i in range(b - a):
                    own_ids = np.append(ids[offs[i] : offs[i + 1]], end_id).astype(f"<u{width}")
                    held.append((doc_ids[a + i], len(own_ids), packer.compress(own_ids.tobytes())))
                    if len(held) >= block_docs or sum(n for _, n, _ in held) >= block_ids:
                        yield flush()
        if held:
            yield flush()

    arrow = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("token_counts", pa.list_(pa.int64())), ("first_token", pa.int64()), ("offsets", pa.list_(pa.int64())), ("frames", pa.binary()), ("width", pa.int32()), ("dictionary_hash", pa.string())])
    # Range bounds come from sampled keys, which go to the driver: so a text's hash, not the text.
    # Rows alike in both, in whatever order, are cut by a number.
    placed = rows.withColumn("h", F.xxhash64("text")).withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(shards, "doc_id", "h", "salt").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    placed.mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")
    return folder


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def _dictionary_data(spark: SparkSession, folder: str) -> dict[str, bytes]:
    """One row of at most dictionary_bytes for each writing of the folder."""
    return {r.dictionary_hash: bytes(r.data) for r in spark.read.schema("dictionary_hash string, data binary").parquet(f"{folder}/dictionary").collect()}


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False, only: Sequence[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, and the ids (little-endian unsigned 32-bit) if asked for.

    only: doc ids; Parquet's statistics skip other row groups, and of the blocks that hold
    them only their own frames are decompressed.
    """
    blocks = read_blocks(spark, folder)
    totals = blocks.groupBy("shard").agg(F.sum(F.aggregate("token_counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    # One row a shard: a few bytes for each file of the folder.
    starts = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("shard_start"))
    if only is not None:
        wanted = F.lit(False)
        for d in only:
            wanted = wanted | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
        blocks = blocks.where(wanted)
    dictionaries = spark.sparkContext.broadcast(_dictionary_data(spark, folder))
    chosen = None if only is None else frozenset(only)

    def unpack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        openers: dict[str, zstandard.ZstdDecompressor] = {}
        for frame in frames:
            for r in range(frame.num_rows):
                shard, doc_ids, counts, at, offs, data, width, digest = (frame.column(c)[r].as_py() for c in range(8))
                if digest not in openers:
                    own = _dictionary(dictionaries.value[digest])  # a KeyError says that the dictionary of this block is missing
                    openers[digest] = zstandard.ZstdDecompressor(dict_data=own) if own else zstandard.ZstdDecompressor()
                out: list[tuple] = []
                for d, n, a, b in zip(doc_ids, counts, offs[:-1], offs[1:]):
                    if chosen is None or d in chosen:
                        ids = np.frombuffer(openers[digest].decompress(data[a:b]), f"<u{width}").astype("<u4").tobytes()
                        if len(ids) != 4 * n:
                            raise ValueError(f"document {d} of shard {shard}: {len(ids) // 4} ids, the index has {n}")
                        out.append((shard, d, at, n, zlib.crc32(ids), ids))
                    at += n
                cols = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols[: 5 + with_ids], ["shard", "doc_id", "at", "n_tokens", "ids_crc32", "ids"][: 5 + with_ids])

    rows = blocks.select("shard", "doc_ids", "token_counts", "first_token", "offsets", "frames", "width", "dictionary_hash").mapInArrow(unpack, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
    return rows.join(F.broadcast(starts), "shard").select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


