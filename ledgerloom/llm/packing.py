"""Packing of documents into windows of a fixed length.

A document's ids and its end id are cut into whole windows, which are sequences
of their own, and a tail.  The histogram of all tail lengths (one count for each
length below the window, whatever the corpus) goes to the driver, where
non-negative least squares finds how often each shallow combination of lengths
that fills a window exactly (all pairs, and triples on a grid) should be used.
Counts are rounded down, the tails they take are placed by arithmetic on their
number within their length, and the residual tails are packed greedily: end to
end in windows, cut where a window ends.  So only the last sequence is padded.

Tails of one length are numbered in salted groups of about ``salt_rows``, so a length
that a third of all documents have (empty ones have the end id alone) is many tasks.

Defined cases: null text is empty (one id, the end id); a very long text is many whole
windows and one tail; repeated rows are packed each; equal tails are ordered by id, digest and
start; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.tokens import batches, byte_encoder, tokenizer_path
from ledgerloom.plans.shared import staged

WINDOW = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, tail binary, dealt long"
RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def combinations(window: int, step: int) -> np.ndarray:
    """Rows (a, b, c) of lengths a >= b >= c that add up to window; c is 0 in pairs, a multiple of step in triples."""
    a = np.arange((window + 1) // 2, window)
    rows = [np.stack([a, window - a, 0 * a], 1)]
    for c in range(step, window // 3 + 1, step):
        b = np.arange(c, (window - c) // 2 + 1)
        rows.append(np.stack([window - c - b, b, 0 * b + c], 1))
    return np.concatenate(rows)


def solve(combos: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares of how often each combination is used against counts (by length), by multiplicative updates."""
    n = len(counts)
    real = combos > 0

    def gathered(x: np.ndarray) -> np.ndarray:
        return (np.where(real, x[combos], 0)).sum(1)

    def spread(x: np.ndarray) -> np.ndarray:
        return np.bincount(combos[real], np.broadcast_to(x[:, None], combos.shape)[real], n)

    top = gathered(counts.astype(float))
    x = np.full(len(combos), counts.sum() / (2.5 * len(combos)))
    for _ in range(rounds):
        x *= top / (gathered(spread(x)) + 1e-12)
    return x


def plan(counts: np.ndarray, window: int = WINDOW, step: int = 16) -> tuple[np.ndarray, int]:
    """Rows (length, low, high, first sequence, pieces of this length in a sequence, offset) that place the tails low..high-1 of a length; and the sequences used.

    A row with 0 pieces in a sequence is a residual one: its tails lie end to end from the id ``offset`` counted from the first sequence's start.
    """
    combos = combinations(window, step)
    x = solve(combos, counts)
    left, low, rows, sequences = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64), [], 0
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 0.5:
            break
        lens, mult = np.unique(combos[k][combos[k] > 0], return_counts=True)
        uses = int(min(max(1, np.floor(x[k])), (left[lens] // mult).min()))
        if uses:
            offset = 0
            for n, m in zip(lens.tolist(), mult.tolist()):
                rows.append((n, low[n], low[n] + uses * m, sequences, m, offset))
                low[n] += uses * m
                left[n] -= uses * m
                offset += n * m
            sequences += uses
    at, first = 0, sequences
    for n in np.flatnonzero(left)[::-1].tolist():  # the longest first
        rows.append((n, low[n], low[n] + left[n], first, 0, at))
        at += n * int(left[n])
    return np.array(rows, np.int64).reshape(-1, 6), first + -(-at // window)


def pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """Whole windows (tail null) and the tail of each document, with its ids as unsigned 32-bit integers; dealt numbers the documents of a task."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, dealt = byte_encoder(path), TaskContext.get().partitionId()
        for frame in frames:
            doc_ids, texts = frame.column(0).to_pylist(), frame.column(1).to_pylist()
            for a, b in batches(texts):
                ids, offs = encoder.encode(texts[a:b])
                out: list[tuple] = []
                for i in range(b - a):
                    own = np.append(ids[offs[i] : offs[i + 1]], end_id).astype("<u4")
                    for s in range(0, len(own), window):
                        part = own[s : s + window].tobytes()
                        n = len(part) // 4
                        out.append((doc_ids[a + i], s, n, zlib.crc32(part), len(own), part if n < window else None, dealt))
                    dealt += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 5, pa.binary(), pa.int64()))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "tail", "dealt"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, window: int = WINDOW, salt_rows: int = 1 << 10) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer, end_id, window), "pieces")  # encoded once; the plan needs all lengths
    tails = cut.where("tail is not null")
    counts = np.zeros(window, np.int64)
    for r in tails.groupBy("length").agg(F.count("*").alias("n")).collect():  # one row a length
        counts[r.length] = r.n
    # As many salts as keep about salt_rows tails in each; a tail's number in its task deals it, so even rows that agree in everything are spread.
    salts = F.get(F.lit([max(1, -(-int(n) // salt_rows)) for n in counts]), F.col("length").cast("int"))
    tails = tails.withColumn("salt", (F.col("dealt") % salts).cast("int"))
    by = tails.groupBy("length", "salt").agg(F.count("*").alias("n"))  # a row for each salt_rows tails, and for each length
    base = by.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    rows, used = plan(counts, window)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    placed = spark.sparkContext.broadcast((rows, rows[:, 0] * (1 << 40) + rows[:, 1]))

    def place(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys = placed.value
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for frame in frames:
            start, length, crc, total, number = (frame.column(frame.schema.get_field_index(c)).to_numpy() for c in ("start", "length", "ids_crc32", "doc_tokens", "number"))
            _, low, _, first, each, offset = rows[np.searchsorted(keys, length * (1 << 40) + number, side="right") - 1].T
            k = number - low
            line = offset + k * length  # of the residual
            share = np.maximum(each, 1)
            seq = np.where(each > 0, first + k // share, first + line // window)
            off = np.where(each > 0, offset + (k % share) * length, line % window)
            over = off + length > window
            whole = ~over
            doc_ids = frame.column(0)
            yield pa.RecordBatch.from_arrays([doc_ids.filter(pa.array(whole)), *(pa.array(x[whole]) for x in (start, length, crc, total, seq, off))], names)
            out: list[tuple] = []
            for i in np.flatnonzero(over).tolist():
                part, n = frame.column(frame.schema.get_field_index("tail"))[i].as_py(), int(window - off[i])
                d = doc_ids[i].as_py()
                out.append((d, int(start[i]), n, zlib.crc32(part[: 4 * n]), int(total[i]), int(seq[i]), int(off[i])))
                out.append((d, int(start[i]) + n, int(length[i]) - n, zlib.crc32(part[4 * n :]), int(total[i]), int(seq[i]) + 1, 0))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    order = Window.partitionBy("length", "salt").orderBy("doc_id", "ids_crc32", "start")
    # base grows with the tails, so no broadcast is asked for: its keys are those that the window has dealt the tails by.
    numbered = tails.withColumn("rank", F.row_number().over(order)).join(base, ["length", "salt"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "tail", (F.col("base") + F.col("rank") - 1).alias("number"))
    whole = cut.where("tail is null").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.lit(int(used)) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return numbered.mapInArrow(place, RESULT).unionByName(whole)
