"""Embedding near-duplicates by collision counting on one-dimensional projections.

Equal vectors are one class.  Each class is projected on ``projections`` random
directions.  Two classes collide on a direction when their projections differ by at
most the half-width of a window centred on the query; a pair that collides on at
least ``calibrate(...).count`` directions is verified by its exact cosine in double
precision.  The half-width and the count are set so that a pair at the threshold
itself passes with probability ``recall``; pairs above it pass more often.

Which pairs are counted at all is dealt by compound keys.  A further set of directions is
cut into groups of ``SIDES``; a vector lies at the far end of one direction of a group,
on one of its two sides, and ``keys`` such ends in a row are a key.  Vectors at the threshold
agree on an end with a probability that simulation gives once and for all (it depends on the
threshold alone), others with one in 2 * SIDES.  ``dealing`` takes as many ends in a key as leave
a vector a tenth of a chance partner, and as many tables of keys as let a pair at the
threshold share a key with probability ``recall``.  So tables grow with a small power of the
number of classes (less than 0.15), and the pairs that are looked at with the links, not with its square.

Only ids and keys are shuffled first; of keys that one class alone has, no more is seen.  The
others fetch vectors and projections.  Small keys share tasks; the classes of a key that more than
``block_rows`` have are dealt to blocks, and each pair of blocks is a task, sorted by the first
projection, so that windows are ranges.  A pair is taken in the first table where it shares a key.
A task returns link counts and a spanning forest, so its output is linear in its rows
however dense a group is.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of unequal length don't link; a vector without vec_id
links as others do, and its component is named by its smallest vec_id that isn't null (null if it has none); repeated rows are links of each other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.forest import Forest
from ledgerloom.operators.components import connected_components
from ledgerloom.plans.shared import staged

THRESHOLD, PROJECTIONS, RECALL = 0.95, 32, 0.9999
SIDES = 64
_STEPS = 0.05  # of an 8-bit projection


class Calibration(NamedTuple):
    half_width: float  # of the counted windows
    count: int  # collisions a pair needs
    reach: float  # half-width of the window that all pairs at the threshold are in


class Dealing(NamedTuple):
    keys: int  # ends in a key
    tables: int


def _normal_inside(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def calibrate(threshold: float = THRESHOLD, projections: int = PROJECTIONS, recall: float = RECALL) -> Calibration:
    """Of unit vectors at distance d, Gaussian projections differ by a normal of deviation d."""
    d = math.sqrt(max(1e-12, 2 - 2 * threshold))
    z, p = 2.0, _normal_inside(2.0)
    count, mass = projections, p**projections
    while mass < recall and count > 1:
        count -= 1
        mass += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
    wide = 1.0
    while _normal_inside(wide) < recall:
        wide += 0.05
    return Calibration(z * d, count, wide * d)


@functools.cache
def same_end(threshold: float, draws: int = 100_000) -> float:
    """Probability that two vectors at the threshold agree on an end, less three deviations of the simulation."""
    rng = np.random.default_rng(17)
    u = rng.standard_normal((draws, SIDES))
    v = threshold * u + math.sqrt(max(0.0, 1 - threshold**2)) * rng.standard_normal((draws, SIDES))
    a, b = np.abs(u).argmax(1), np.abs(v).argmax(1)
    at = np.arange(draws)
    p = float(np.mean((a == b) & ((u[at, a] > 0) == (v[at, b] > 0))))
    return max(1e-6, p - 3 * math.sqrt(p * (1 - p) / draws))


def dealing(classes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> Dealing:
    """Ends in a key and tables of keys for so many classes."""
    keys = max(1, math.ceil(math.log(max(2, 10 * classes)) / math.log(2 * SIDES)))
    met = same_end(threshold) ** keys
    return Dealing(keys, max(1, math.ceil(math.log(1 - recall) / math.log1p(-min(met, 1 - 1e-12)))))


def directions(dim: int, projections: int = PROJECTIONS, seed: int = 7) -> np.ndarray:
    """One for the order in a task, and those that are counted."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, projections + 1))


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares of tiny or huge components neither vanish nor overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def compound_keys(x: np.ndarray, deal: Dealing, seed: int = 29) -> np.ndarray:
    """A 64-bit key of each unit vector in each table; vectors of unequal length have no key in common but by chance."""
    rng = np.random.default_rng([seed, x.shape[1]])
    out = np.empty((len(x), deal.tables), np.int64)
    mixed = np.uint64(0x9E3779B97F4A7C15)
    f = x.astype(np.float32)
    with np.errstate(over="ignore"):
        for t in range(deal.tables):
            h = np.full(len(x), t + 1, np.uint64) * mixed + np.uint64(x.shape[1])
            for _ in range(deal.keys):
                p = f @ rng.standard_normal((x.shape[1], SIDES), np.float32)
                far = np.abs(p).argmax(1)
                h = (h ^ (2 * far + (p[np.arange(len(x)), far] > 0)).astype(np.uint64)) * mixed
                h ^= h >> np.uint64(29)
            out[:, t] = h.view(np.int64)
    return out


def _projected(projections: int, deal: Dealing, kind: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rep, n, vec = (frame.column(k) for k in range(3))
            dims = np.diff(vec.offsets.to_numpy())
            flat, starts = vec.values.to_numpy(zero_copy_only=False), vec.offsets.to_numpy()[:-1]
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                raw = flat[starts[own, None] + np.arange(dim)].astype(kind)
                x = unit_rows(raw)
                p = x @ directions(dim, projections)
                q = np.round(p[:, 1:] / _STEPS).astype(np.int64).astype(np.uint8)
                keys = compound_keys(x, deal)
                idx = pa.array(own)
                lists = pa.ListArray.from_arrays(np.arange(len(own) + 1, dtype=np.int32) * deal.tables, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [rep.take(idx), n.take(idx), pa.array(p[:, 0]), pa.array([r.tobytes() for r in raw], pa.binary()), pa.array([r.tobytes() for r in q], pa.binary()), lists],
                    ["rep", "n", "p0", "x", "q", "keys"],
                )

    return run


class Rows:
    """Classes in a task."""

    def __init__(self, frame: pd.DataFrame, kind: str):
        self.rep, self.n, self.p0 = (frame[c].to_numpy() for c in ("rep", "n", "p0"))
        self.q = np.frombuffer(b"".join(frame["q"]), np.uint8).reshape(len(frame), -1)
        self.by_direction = np.ascontiguousarray(self.q.T)
        raw = [np.frombuffer(b, kind) for b in frame["x"]]
        dim = max(map(len, raw))
        if any(len(r) != dim for r in raw):  # a key that vectors of unequal length share by chance
            raw = [r if len(r) == dim else np.append(r, np.zeros(dim - len(r), kind)) for r in raw]
        self.dim = np.array([len(b) for b in frame["x"]])
        self.x = unit_rows(np.array(raw))
        self.keys = np.array(frame["keys"].tolist(), np.int64).reshape(len(frame), -1)


def _verified(rows: Rows, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    near = (np.einsum("ij,ij->i", rows.x[i], rows.x[j]) >= threshold) & (rows.dim[i] == rows.dim[j])
    return i[near], j[near]


def _first_met(rows: Rows, i: np.ndarray, j: np.ndarray, table: np.ndarray | int) -> np.ndarray:
    return (rows.keys[i] == rows.keys[j]).argmax(1) == table


def count_pairs(rows: Rows, left: np.ndarray, right: np.ndarray | None, table: int, cal: Calibration, threshold: float, found: Callable, tile: int = 1024, portion: int = 1 << 16) -> None:
    """Pairs of two blocks of rows that share their key of this table (indices in order of p0; right None: pairs inside left).

    found(i, j) gets the verified pairs that share no key of an earlier table, in portions.
    """
    same = right is None
    right = left if same else right
    px, py = rows.p0[left], rows.p0[right]
    reach = np.uint8(min(127, math.ceil(cal.half_width / _STEPS) + 1))
    for a in range(0, len(left), tile):
        b = min(len(left), a + tile)
        lo, hi = np.searchsorted(py, px[a] - cal.reach), np.searchsorted(py, px[b - 1] + cal.reach, side="right")
        for c in range(max(lo, a) if same else lo, hi, tile):
            d = min(hi, c + tile)
            u, v = left[a:b], right[c:d]
            fresh = np.arange(a, b)[:, None] < np.arange(c, d) if same else np.ones((b - a, d - c), bool)
            i = j = None
            for t in range(table):  # those that share an earlier key go
                if i is None:
                    fresh &= rows.keys[u, t][:, None] != rows.keys[v, t]
                    if fresh.mean() < 0.1:
                        i, j = np.nonzero(fresh)
                else:
                    apart = rows.keys[u[i], t] != rows.keys[v[j], t]
                    i, j = i[apart], j[apart]
                if i is not None and not len(i):
                    break
            if i is None:
                hits = np.zeros(fresh.shape, np.uint8)
                for k in range(len(rows.by_direction)):
                    hits += (rows.by_direction[k, u][:, None] - (rows.by_direction[k, v] - reach)) <= 2 * reach  # modulo 256
                i, j = np.nonzero((hits >= cal.count) & fresh)
            elif len(i):
                i, j = _counted(rows, u, v, i, j, cal, reach)
            for s in range(0, len(i), portion):
                near = _verified(rows, u[i[s : s + portion]], v[j[s : s + portion]], threshold)
                if len(near[0]):
                    found(*near)


def _counted(rows: Rows, u: np.ndarray, v: np.ndarray, i: np.ndarray, j: np.ndarray, cal: Calibration, reach: np.uint8) -> tuple[np.ndarray, np.ndarray]:
    enough = ((rows.q[u[i]] - (rows.q[v[j]] - reach)) <= 2 * reach).sum(1) >= cal.count
    return i[enough], j[enough]


def count_runs(rows: Rows, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, tables: np.ndarray, cal: Calibration, threshold: float, found: Callable, portion: int = 1 << 17) -> None:
    """The same for many small keys at once: order lays the rows of each key side by side, from starts on."""
    reach = np.uint8(min(127, math.ceil(cal.half_width / _STEPS) + 1))
    ends = np.cumsum(sizes * sizes)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, portion):
        at = np.arange(lo, min(lo + portion, int(ends[-1])))
        run = np.searchsorted(ends, at, side="right")
        within = at - (ends[run] - sizes[run] ** 2)
        i, j = starts[run] + within // sizes[run], starts[run] + within % sizes[run]
        once = i < j
        i, j, table = order[i[once]], order[j[once]], tables[run[once]]
        fresh = _first_met(rows, i, j, table)
        i, j = i[fresh], j[fresh]
        at = np.arange(len(rows.rep))
        i, j = _counted(rows, at, at, i, j, cal, reach)
        near = _verified(rows, i, j, threshold)
        if len(near[0]):
            found(*near)


def links(classes: DataFrame, threshold: float = THRESHOLD, projections: int = PROJECTIONS, recall: float = RECALL, block_rows: int = 4096, small: int = 128, task_rows: int = 1 << 15) -> DataFrame:
    """From classes (rep, n, embedding): rows (a, b, n); b null: n vectors of other classes are linked with class a; else an edge of a spanning forest."""
    cal, number = calibrate(threshold, projections, recall), classes.count()
    deal = dealing(number, threshold, recall)
    kind = "<f4" if classes.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = staged(classes.select("rep", "n", "embedding").mapInArrow(_projected(projections, deal, kind), "rep long, n long, p0 double, x binary, q binary, keys array<long>"), "projected")
    ends = rows.select("rep", F.posexplode("keys").alias("table", "key"))
    shared = ends.groupBy("table", "key").agg(F.count("*").alias("size"), F.min("rep").alias("least")).where("size >= 2")
    ends = ends.join(shared, ["table", "key"]).withColumn("blocks", F.ceil(F.col("size") / block_rows).cast("int"))
    # A key that many have is tasks of its own. The others share them by their smallest id, so the keys of one group of near vectors, which mostly
    # have the same, meet in one task, and its vectors are sent there once; a task has about task_rows ends.
    groups = max(1, -(-number * deal.tables // task_rows))
    hot = F.col("blocks") > 1
    ends = ends.withColumn("own", F.when(hot, F.col("key"))).withColumn("place", F.when(hot, F.col("table")).otherwise(F.pmod(F.xxhash64("least"), F.lit(groups)))).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    ends = ends.select("rep", "table", "key", "own", "place", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"))
    ends = ends.select("rep", "own", "place", F.least("block", "to").alias("u"), F.greatest("block", "to").alias("v"), (F.col("block") > F.col("to")).alias("right"), F.struct("table", "key").alias("end"))
    dealt = ends.groupBy("own", "place", "u", "v", "right", "rep").agg(F.collect_list("end").alias("ends")).join(rows, "rep")  # a table's number of ends at most

    def task(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held, reps = Rows(frame, kind), frame["rep"].to_numpy()
        number = frame["ends"].map(len).to_numpy()
        at = np.repeat(np.arange(len(frame)), number)
        table, code = (np.array([e[c] for ends in frame["ends"] for e in ends], np.int64) for c in ("table", "key"))
        order = np.lexsort((held.p0[at], code, table))
        at, table, code = at[order], table[order], code[order]
        right = frame["right"].to_numpy()[at]
        forest, more = Forest(len(reps)), np.zeros(len(reps), np.int64)

        def found(i: np.ndarray, j: np.ndarray) -> None:
            np.add.at(more, i, held.n[j])
            np.add.at(more, j, held.n[i])
            forest.link(i, j)

        starts = np.flatnonzero(np.append(True, (table[1:] != table[:-1]) | (code[1:] != code[:-1])))
        sizes = np.diff(np.append(starts, len(at)))
        few = sizes <= small
        if key[0] is None or pd.isna(key[0]):
            count_runs(held, at, starts[few], sizes[few], table[starts[few]], cal, threshold, found)
            for s, n in zip(starts[~few].tolist(), sizes[~few].tolist()):
                count_pairs(held, at[s : s + n], None, int(table[s]), cal, threshold, found)
        elif key[2] == key[3]:
            count_pairs(held, at, None, int(table[0]), cal, threshold, found)
        elif right.any():
            count_pairs(held, at[~right], at[right], int(table[0]), cal, threshold, found)
        i, j = forest.edges()
        linked = np.flatnonzero(more)
        return pd.DataFrame({"a": np.concatenate([reps[linked], reps[i]]), "b": pd.array([*[None] * len(linked), *reps[j].tolist()], "Int64"), "n": np.concatenate([more[linked], 0 * i])})

    return dealt.groupBy("own", "place", "u", "v").applyInPandas(task, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, projections: int = PROJECTIONS, recall: float = RECALL) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("embedding", lambda v: v != 0)
    # Written once, so that a class keeps its number; a class of which no vector has an id is linked by it too.
    classes = vectors.where(valid).groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = staged(classes.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    found = staged(links(classes, threshold, projections, recall), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    parts = connected_components(found.where("b is not null"))
    named = (
        classes.join(counts, "rep", "left")
        .join(parts.withColumnRenamed("id", "rep"), "rep", "left")
        .select("embedding", "least", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    named = staged(named, "classes")
    component = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(component, "component").select("embedding", "n_links", "component_id")
    done = vectors.where(valid).join(named, "embedding").select("vec_id", "n_links", "component_id")
    rest = vectors.where(~F.coalesce(valid, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
