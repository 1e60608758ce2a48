"""Quality by positive-unlabelled learning.

Trusted positives are documents labelled good; all web text, labels unseen, is
unlabelled.  Labels of bad documents are never used.  A text is described by shares and rates of
its characters, words and lines, each cut into quantile bins of the unlabelled; the score of a
text is the logistic function of LINK * z, where z is the sum of its bins' weights (1 for a good
text, -1 for another, as far as a sum can say so).

The weights minimise the non-negative unbiased risk under the squared loss,
pi R_p(+) + max(0, R_u(-) - pi R_p(-)).  This risk is a quadratic form in the weights whose coefficients
count how often two bins meet in a text, among the positives and among the unlabelled.  So
Spark adds up these counts over every document, no sample is taken, and the
minimum is found exactly: where the plain minimum has a negative second term, the minimum on
its zero is found by bisection of the multiplier.

The share pi of good text among the unlabelled is estimated first: a positive-against-unlabelled
classifier is fitted on one half of the texts, and the other half gives the least ratio of unlabelled to
positive mass above a threshold.

What reaches the driver has a bound whatever the corpus: a row for each value of a feature to
three digits, one for each pair of bins, and one for each thousandth of a score.

Defined cases: null text is empty; an empty text has all rates zero; a very long text is described whole,
one at a time; without positives every score is 0.5; repeated rows count and are scored each, all rows of a
document labelled good are positives; a document with several labels counts as good if one says so;
rows without doc_id are unlabelled; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.shared import staged

NAMES = [
    "log_chars", "letters", "upper", "digits", "marks", "symbols", "exclaims", "bars", "stops", "spaces",
    "word_length", "long_words", "one_letter", "distinct_words", "top_word", "repeats_next", "distinct_pairs", "distinct_lines", "line_words", "line_stops", "squeezed", "alphabet",
]


def describe(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    n = max(1, len(text))
    words = text.split()
    k = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    octets = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits = int(octets[65:91].sum()), int(octets[97:123].sum()), int(octets[48:58].sum())
    letters = upper + lower + int(octets[0xC2:].sum())
    count = lambda s: int(sum(octets[ord(c)] for c in s))
    lens = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    kinds: dict[str, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    return [
        np.log1p(len(text)), letters / n, upper / max(1, letters), digits / n, count(".,;:!?'\"()-") / n, count("*%$&#@^~+=<>{}[]\\/_`") / n, count("!") / n, count("|") / n, count(".?!") / k, count(" \t\n\r") / n,
        float(lens.mean()), float((lens > 12).mean()), float((lens == 1).mean()), len(kinds) / k**0.8, max(kinds.values(), default=0) / k, sum(map(str.__eq__, words[1:], words)) / k, len(set(zip(words[1:], words))) / k,
        len(set(lines)) / max(1, len(lines)), np.log1p(k / max(1, len(lines))), sum(x.rstrip()[-1] in ".?!" for x in lines) / max(1, len(lines)), len(zlib.compress(raw, 1)) / max(1, len(raw)), float((octets > 0).sum()) / n**0.5,
    ]


#: What marks the column of descriptions, in its metadata, so no column of a user's is taken for it whatever its name.
MARK = "ledgerloom.quality"
BINS, L2 = 8, 1e-3
LINK = 4.0  # so that a score of 0.7 is a fifth of the way from undecided to good
_CELL = 14  # bits of a float that a histogram drops: three digits are left


class Model(NamedTuple):
    edges: np.ndarray | None  # by feature
    weights: np.ndarray
    bias: float
    prior: float


def _bins(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    size = edges.shape[1] + 1
    return np.stack([np.searchsorted(e, x[:, i], side="right") + i * size for i, e in enumerate(edges)], 1)


def _cells(x: np.ndarray) -> np.ndarray:
    """Of each value, its feature and its place among numbers of three digits, in one integer."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    key = bits ^ np.where(bits >> 31, np.uint32(0xFFFFFFFF), np.uint32(0x80000000))  # in the order of the numbers
    return (key >> _CELL).astype(np.int64) + (np.arange(x.shape[1], dtype=np.int64) << (32 - _CELL))


def _edges(cells: np.ndarray, n: np.ndarray, features: int, bins: int) -> np.ndarray:
    """Quantiles of each feature, from sorted cells and how many values each has."""
    out = np.zeros((features, bins - 1), np.float32)
    for i in range(features):
        own = cells >> (32 - _CELL) == i
        below = np.cumsum(n[own])
        at = np.searchsorted(below, below[-1] * np.arange(1, bins) / bins, side="left")
        key = ((cells[own][at] & ((1 << (32 - _CELL)) - 1)) << _CELL).astype(np.uint32)
        out[i] = (key ^ np.where(key >> 31, np.uint32(0x80000000), np.uint32(0xFFFFFFFF))).view(np.float32)
    return out


def _half(x: np.ndarray) -> np.ndarray:
    """0 or 1 by a text's description, the same for equal ones."""
    return (np.ascontiguousarray(x, np.float32).view(np.uint32).astype(np.uint64) @ np.arange(1, 2 * x.shape[1], 2, dtype=np.uint64) >> np.uint64(7)).astype(np.int64) & 1


def _meetings(at: np.ndarray, size: int) -> np.ndarray:
    """How often bins i and j are in one text."""
    one = np.zeros((len(at), size), np.float32)
    np.put_along_axis(one, at, 1, 1)
    return np.rint(one.T @ one).astype(np.int64)  # whole numbers below 2**24 in a batch


class Moments(NamedTuple):
    """Means over a set of texts: of each bin, of each pair of bins, the bias (always 1) last."""

    n: int
    first: np.ndarray
    second: np.ndarray


def _moments(meet: np.ndarray, features: int) -> Moments:
    """From how often bins meet."""
    count = np.diag(meet)
    n = int(count.sum()) // features  # each text is in one bin of each feature
    second = np.block([[meet, count[:, None]], [count[None, :], np.array([[n]])]]) / max(1, n)
    return Moments(n, second[-1].copy(), second)


def _ridge(size: int) -> np.ndarray:
    return np.diag([L2] * (size - 1) + [1e-9])


def _risk_weights(p: Moments, u: Moments, prior: float) -> np.ndarray:
    """Weights of least non-negative risk."""

    def least(part: float) -> np.ndarray:  # of the first term and so much of the second
        both = (prior * (1 - part) * p.second + part * u.second) / 2 + _ridge(len(p.first))
        return np.linalg.solve(both, (prior * p.first - part * (u.first - prior * p.first)) / 2)

    def second_term(w: np.ndarray) -> float:
        loss = lambda m: (1 + 2 * m.first @ w + w @ m.second @ w) / 4
        return float(loss(u) - prior * loss(p))

    w, low, high = least(1.0), 0.0, 1.0
    if second_term(w) >= 0:
        return w
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if second_term(least(middle)) >= 0 else (low, middle)
    return least(low)


def _contrast(p: Moments, u: Moments) -> np.ndarray:
    """Weights of the squared loss of positives against unlabelled."""
    return np.linalg.solve(p.second + u.second + _ridge(len(p.first)), p.first - u.first)


def _grid(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z * 1000), -9000, 9000).astype(np.int64)


def _prior(grid: np.ndarray, p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio of the masses above a score, from how many of both have each score."""
    if not p.sum() or not u.sum():
        return 0.5
    order = np.argsort(-grid)
    above_p, above_u = np.cumsum(p[order]) / p.sum(), np.cumsum(u[order]) / u.sum()
    slack = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(p.sum()) + 1 / np.sqrt(u.sum()))
    best = np.argmin((above_u + slack) / np.maximum(above_p, 1e-9))
    return float(np.clip(above_u[best] / max(above_p[best], 1e-9), 0.01, 0.99))


def _with_prior(halves: list[tuple[np.ndarray, np.ndarray]], features: int, edges: np.ndarray, scores: Callable, prior: float | None = None) -> Model:
    """halves: of each half, meetings among positives and among unlabelled. scores(w): grid, positives and unlabelled of the second half at each score."""
    size = len(halves[0][0])
    p, u = (_moments(halves[0][k] + halves[1][k], features) for k in range(2))
    if not p.n:
        return Model(None, np.zeros(0), 0.0, 0.5)
    if prior is None:
        fit_p, fit_u = (_moments(m, features) for m in halves[0])
        prior = _prior(*scores(_contrast(fit_p, fit_u))) if fit_p.n else 0.5
    w = _risk_weights(p, u, prior)
    return Model(edges, w[:size], float(w[-1]), prior)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, bins: int = BINS) -> Model:
    """From rows of describe() in memory; prior: share of positives among the unlabelled, estimated if None."""
    if not len(positive) or not len(unlabelled):
        return Model(None, np.zeros(0), 0.0, 0.5)
    k = unlabelled.shape[1]
    sides = {"p": np.asarray(positive, np.float32), "u": np.asarray(unlabelled, np.float32)}
    edges = _edges(*np.unique(_cells(sides["u"]), return_counts=True), k, bins)
    at, half = {s: _bins(x, edges) for s, x in sides.items()}, {s: _half(x) for s, x in sides.items()}
    halves = [tuple(_meetings(at[s][half[s] == h], k * bins) for s in "pu") for h in (0, 1)]

    def scores(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = {s: _grid(w[at[s][half[s] == 1]].sum(1) + w[-1]) for s in "pu"}
        grid = np.unique(np.concatenate([z["p"], z["u"]]))
        return grid, *(np.bincount(np.searchsorted(grid, z[s]), minlength=len(grid)) for s in "pu")

    return _with_prior(halves, k, edges, scores, prior)


def probabilities(x: np.ndarray, model: Model) -> np.ndarray:
    if model.edges is None:
        return np.full(len(x), 0.5)
    return 1 / (1 + np.exp(-LINK * (model.weights[_bins(x, model.edges)].sum(1) + model.bias)))


def column(docs: DataFrame) -> str | None:
    """The name of the column that ``described`` has added; its mark lasts through Parquet."""
    return next((f.name for f in docs.schema if f.metadata.get(MARK)), None)


def described(docs: DataFrame) -> DataFrame:
    """docs with a column more, the description of each text, which ``column`` finds. Only the text goes to Python."""
    if column(docs) is not None:
        return docs
    name = "description"
    while name in (c.lower() for c in docs.columns):
        name += "_"

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([describe(t) for t in texts.to_pylist()], pa.list_(pa.float32()))

    return docs.select("*", run(F.coalesce("text", F.lit(""))).alias(name, metadata={MARK: True}))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def _scores(model: Model, x: str) -> Column:
    @F.arrow_udf("double")
    def run(x: pa.Array) -> pa.Array:
        return pa.array(probabilities(_matrix(x), model))

    return run(x)


def train(docs: DataFrame, labels: DataFrame, bins: int = BINS) -> Model:
    """docs: doc_id, text (or described ones, staged by the caller); labels: doc_id, label (1: good), of the rows that may be learnt from. Labels other than 1 aren't read."""
    k = len(NAMES)
    size = k * bins
    good = labels.where("doc_id is not null and label = 1").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("good")).distinct()
    rows = described(docs if column(docs) else docs.select("doc_id", "text"))
    x = column(rows)
    rows = staged(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(x).alias("x")).join(good, "doc_id", "left").select("x", F.coalesce("good", F.lit(False)).alias("good")), "described")

    def histogram(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            cells, n = np.unique(_cells(_matrix(frame.column(0))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n.astype(np.int64))], ["cell", "n"])

    found = rows.select("x").mapInArrow(histogram, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()
    if not found:
        return Model(None, np.zeros(0), 0.0, 0.5)
    edges = _edges(np.array([r.cell for r in found]), np.array([r.n for r in found]), k, bins)

    def meetings(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, size, size), np.int64)  # by half; positives, then unlabelled
        for frame in frames:
            x, is_good = _matrix(frame.column(0)), frame.column(1).to_numpy(zero_copy_only=False)
            at, half = _bins(x, edges), _half(x)
            for h in (0, 1):
                sums[2 * h] += _meetings(at[(half == h) & is_good], size)
                sums[2 * h + 1] += _meetings(at[half == h], size)
        i, j = np.nonzero(np.triu(sums.any(0)))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *(pa.array(m[i, j]) for m in sums)], ["i", "j", "m0", "m1", "m2", "m3"])

    sums = np.zeros((4, size, size), np.int64)
    met = rows.mapInArrow(meetings, "i long, j long, m0 long, m1 long, m2 long, m3 long").groupBy("i", "j").agg(*[F.sum(f"m{c}").alias(f"m{c}") for c in range(4)])
    for r in met.collect():  # one row for each pair of bins at most
        sums[:, r.i, r.j] = sums[:, r.j, r.i] = r[2:]

    def scores(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in frames:
                x, is_good = _matrix(frame.column(0)), frame.column(1).to_numpy(zero_copy_only=False)
                second = _half(x) == 1
                grid, at = np.unique(_grid(w[_bins(x[second], edges)].sum(1) + w[-1]), return_inverse=True)
                p = np.bincount(at, is_good[second], len(grid)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grid), pa.array(p), pa.array(np.bincount(at, minlength=len(grid)))], ["z", "p", "u"])

        found = rows.mapInArrow(run, "z long, p long, u long").groupBy("z").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).collect()  # 18,001 rows at most
        return tuple(np.array([r[c] for r in found], np.int64) for c in range(3))

    return _with_prior([(sums[0], sums[1]), (sums[2], sums[3])], k, edges, scores)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for every row of docs."""
    rows = described(docs.select("doc_id", column(docs) or "text"))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), _scores(model, column(rows)).alias("score"))


def keep_good(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """The rows of docs with a score of least or more, without their descriptions. Without a fitted model (model.edges null) every score is 0.5, so a caller who filters should keep all rows itself."""
    rows = described(docs)
    return rows.where(_scores(model, column(rows)) >= least).drop(column(rows))
