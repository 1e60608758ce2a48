"""SimHash near-duplicates: a self-join of the binary trie of fingerprints.

Fingerprints of 3-word shingles (``fingerprints``) are made distinct first, so
groups of copies count once.  Two tries hold each fingerprint: from its first bit,
and rotated by half.  A pair within the radius differs in at most half the radius
in one of the halves, so each traversal allows that many errors in its first half
and the radius in all.  Node pairs of a common depth are dealt to tasks; a task
walks the two subtrees together, adds up differing bits and drops a node pair
when the budget is exceeded.  It returns a spanning forest of the links it found,
not the links, so dense groups stay linear in output.

The depth follows the number of fingerprints; subtrees with more than
``subtree_rows`` fingerprints are split into chunks by hash, and each pair of chunks
is a task of its own, so no task holds more than twice that, however hot a prefix is.

Defined cases: null text is empty (fingerprint 0); a very long text is fingerprinted whole, one at a time; documents with equal text or
equal fingerprint are one component; a component's name is its smallest doc_id that
isn't null (null if it has none); rows of one doc_id with different texts are members of
their own fingerprints' components; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.forest import Forest
from ledgerloom.operators.components import connected_components
from ledgerloom.plans.shared import staged

SEED, SHINGLE, RADIUS = 42, 3, 3
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens).tolist()
    ends = ends.tolist()[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends)], np.uint64)
    octets = h.view(np.uint8).reshape(-1, 8)
    votes = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, identity: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp), with the fingerprint's 64 bits as a long, and the long columns of identity by name."""
    identity = identity or {}
    names = ["doc_id", "fp", *identity]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            fp = np.fromiter((fingerprint(t.as_py()) for t in frame.column(1)), np.uint64, frame.num_rows)
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(fp.view(np.int64)), *frame.columns[2:]], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *[c.alias(n) for n, c in identity.items()])
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def join_subtries(a: np.ndarray, b: np.ndarray, first: int, radius: int, found, portion: int = 1 << 18) -> None:
    """Walk the tries of two sorted arrays of distinct fingerprints together (b is a: each pair once).

    first: errors allowed in the upper 32 bits.  found(i, j) gets the indices of pairs
    within the radius.  Frontiers longer than ``portion`` are put aside in parts, depth first.
    """
    same = b is a
    if not len(a) or not len(b):
        return
    budget = np.array([first] * 32 + [radius] * 32)
    # A frontier: the next bit to look at, the ranges of both nodes, and their errors so far.
    work = [(0, np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)]), np.array([0]))]
    while work:
        bit, alo, ahi, blo, bhi, err = work.pop()
        if len(alo) > portion:
            half = len(alo) // 2
            work += [(bit, *(x[:half] for x in (alo, ahi, blo, bhi, err))), (bit, *(x[half:] for x in (alo, ahi, blo, bhi, err)))]
            continue
        small = (ahi - alo) * (bhi - blo) <= 16
        if bit == 64:
            small[:] = True
        if small.any():  # a few pairs: the bits that are left at once
            na, nb = (ahi - alo)[small], (bhi - blo)[small]
            n = na * nb
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            i = np.repeat(alo[small], n) + at // np.repeat(nb, n)
            j = np.repeat(blo[small], n) + at % np.repeat(nb, n)
            if same:
                i, j = i[i < j], j[i < j]
            diff = a[i] ^ b[j]
            near = (np.bitwise_count(diff) <= radius) & (np.bitwise_count(diff >> np.uint64(32)) <= first)
            if near.any():
                found(i[near], j[near])
            alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        one, above = np.uint64(1 << (63 - bit)), np.uint64((1 << 64) - (1 << (64 - bit)) if bit else 0)
        am = np.clip(np.searchsorted(a, (a[alo] & above) | one), alo, ahi)
        bm = np.clip(np.searchsorted(b, (b[blo] & above) | one), blo, bhi)
        parts = [(alo, am, blo, bm, err), (am, ahi, bm, bhi, err), (alo, am, bm, bhi, err + 1)]
        own = (alo == blo) & same
        parts.append(tuple(x[~own] for x in (am, ahi, blo, bm, err + 1)))
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*parts))
        keep = (ahi > alo) & (bhi > blo) & (err <= budget[bit])
        if keep.any():
            work.append((bit + 1, *(x[keep] for x in (alo, ahi, blo, bhi, err))))


def links(classes: DataFrame, radius: int = RADIUS, subtree_rows: int = 8192, depth: int | None = None) -> DataFrame:
    """Edges (a, b) of spanning forests over all pairs of classes (fp distinct, rep) within the radius."""
    first = radius // 2
    if depth is None:
        depth = min(16, max(0, int(np.ceil(np.log2(max(1, classes.count()) / (subtree_rows / 2))))))
    tries = F.explode(F.array(F.struct(F.lit(0).alias("trie"), F.col("fp").alias("x")), F.struct(F.lit(1).alias("trie"), F.expr("shiftleft(fp, 32) | shiftrightunsigned(fp, 32)").alias("x"))))
    rows = classes.where("rep is not null").select("rep", tries.alias("t")).select("rep", "t.trie", "t.x")
    rows = rows.withColumn("p", F.shiftrightunsigned("x", 64 - depth).cast("int") if depth else F.lit(0))
    # A row for each node at this depth (2 * 65536 at most): into how many chunks it is split.
    nodes = rows.groupBy("trie", "p").agg(F.ceil(F.count("*") / subtree_rows).cast("int").alias("chunks"))
    rows = rows.join(F.broadcast(nodes), ["trie", "p"]).withColumn("chunk", F.pmod(F.xxhash64("x"), F.col("chunks")).cast("int"))
    # The node itself, and the nodes whose prefix is within the first half's budget.
    masks = _masks(depth, first)
    partner = F.explode(F.array(*[F.col("p").bitwiseXOR(F.lit(m)) for m in masks]))
    other = nodes.select("trie", F.col("p").alias("q"), F.col("chunks").alias("q_chunks"))
    dealt = rows.withColumn("q", partner).join(F.broadcast(other), ["trie", "q"]).withColumn("q_chunk", F.explode(F.sequence(F.lit(0), F.col("q_chunks") - 1)))
    mine, theirs = F.struct(F.col("p").alias("p"), F.col("chunk").alias("c")), F.struct(F.col("q").alias("p"), F.col("q_chunk").alias("c"))
    dealt = dealt.select("trie", F.least(mine, theirs).alias("u"), F.greatest(mine, theirs).alias("v"), (mine > theirs).alias("right"), "x", "rep")
    dealt = dealt.select("trie", F.col("u.p").alias("up"), F.col("u.c").alias("uc"), F.col("v.p").alias("vp"), F.col("v.c").alias("vc"), "right", "x", "rep")

    def task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("x", key=lambda s: s.to_numpy().view(np.uint64), kind="stable")
        x, rep, right = rows["x"].to_numpy().view(np.uint64), rows["rep"].to_numpy(), rows["right"].to_numpy()
        forest = Forest(len(x))
        at = np.arange(len(x))
        if right.any():
            sides = at[~right], at[right]
            join_subtries(x[sides[0]], x[sides[1]], first, radius, lambda i, j: forest.link(sides[0][i], sides[1][j]))
        elif key[1:3] == key[3:5]:
            join_subtries(x, x, first, radius, forest.link)
        i, j = forest.edges()
        return pd.DataFrame({"a": rep[i], "b": rep[j]})

    return dealt.groupBy("trie", "up", "uc", "vp", "vc").applyInPandas(task, "a long, b long").where("a <> b").distinct()


def _masks(depth: int, errors: int) -> list[int]:
    out = {0}
    for _ in range(errors):
        out |= {m ^ (1 << k) for m in out for k in range(depth)}
    return sorted(out)


def _components(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, rep, component): each fingerprint, its smallest doc_id, and the smallest fingerprint reachable over links."""
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    found = connected_components(links(classes.select("fp", F.col("fp").alias("rep")), radius))
    return classes.join(found, F.col("fp") == F.col("id"), "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row for each document: doc_id, fp, component_id (the smallest doc_id reachable over links)."""
    prints = staged(fingerprints(docs), "fingerprints")
    found = staged(_components(prints, radius), "components")
    named = found.join(found.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The columns of docs; one row of each near-duplicate component: the smallest doc_id, then the smallest hash of text and other columns (one of repeated rows).

    Rows without a doc_id are members too and come after all others.  A row is known by a number that is written down with it
    before anything is compared, so neither its values nor the names and types of its columns matter to what it is.
    """
    number = "row"
    while number in (c.lower() for c in docs.columns):
        number += "_"
    rows = staged(docs.select("*", F.monotonically_increasing_id().alias(number)), "numbered")
    # Only a tie of doc_id asks for the contents; as JSON, nulls in different columns are different, and maps can be hashed.
    others = [F.col(f"`{c.replace('`', '``')}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    identity = {"text_hash": F.xxhash64("text"), "rest_hash": F.xxhash64(F.to_json(F.struct(*others))), "number": F.col(number)}
    prints = staged(fingerprints(rows, identity), "fingerprints")
    order = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", *identity))
    best = prints.groupBy("fp").agg(order.alias("best"))
    kept = best.join(_components(prints, radius), "fp").groupBy("component").agg(F.min("best").alias("best")).select(F.col("best.number").alias(number))
    return rows.join(kept, number, "left_semi").drop(number)
