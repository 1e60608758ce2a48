"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is a logistic function
of the weights of its words, where a word counts by itself and by its beginnings of
3 to 6 letters (so inflected forms share weight); a document's is the noisy-or of its
sentences, 1 - prod(1 - p).  Weights are fitted on document labels alone, by
gradient descent through the noisy-or, and then locate the offending sentences.

Fitting uses a bounded sample of the labelled rows: ``max_toxic`` and ``max_clean`` documents by
hash order, one text of a repeated doc_id, however long, weighted back
to the share they have among all labels.  Tasks count features and turn the sample's texts into feature
numbers, so no text goes to the driver.  Scoring reads every text whole.

Defined cases: null text is empty; an empty text is one empty sentence and gets
the bias alone; very long texts are scored whole, one at a time, but aren't learnt from; without labels of both kinds every score is the share of toxic
labels (0 without labels); repeated rows are scored each; repeated labels of a
document count once, as the greatest.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.folds import by_hash, texts
from ledgerloom.plans.shared import staged

TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
END = re.compile(r"[.!?\n]+")
CACHE_WORDS = 400_000
LEAST = 4  # toxic texts that a feature must be in
OUTPUT = "doc_id long, score double, offending array<struct<start:int,end:int,score:double>>"


class Model(NamedTuple):
    weights: dict[str, float]  # of features
    bias: float
    constant: float | None = None  # the score of everything, where nothing could be fitted


def features(word: str) -> list[str]:
    """The word, and its beginnings (marked by a hyphen) shorter than itself."""
    return [word, *(word[:k] + "-" for k in range(3, min(7, len(word))))]


def sentences(text: str) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for t in TOKEN.findall(text.lower()):
        if t[0] in ".!?\n":
            if out[-1]:
                out.append([])
        else:
            out[-1].append(t)
    return out[:-1] if len(out) > 1 and not out[-1] else out


class Bag(NamedTuple):
    """A document as a fit sees it: its label, how many sentences have no feature, and the features of each other sentence."""

    label: int
    plain: int
    named: list[list[int]]


def feature_counts(rows: Iterable[tuple[str, int]]) -> tuple[Counter, Counter]:
    """In how many clean and toxic texts each feature is."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for text, label in rows:
        counts[label].update(set(itertools.chain.from_iterable(map(features, set(WORD.findall(text.lower()))))))
    return counts


def choose(counts: Iterable[tuple[str, int, int]], n_clean: int, n_toxic: int, least: int = LEAST) -> dict[str, float]:
    """Features (name, clean and toxic texts that have it) that toxic texts have more than twice as often: their start weights, by name."""
    found = {f: ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1)) for f, c, t in counts if t >= least}
    return {f: float(np.log(r)) * 0.5 for f, r in sorted(found.items()) if r > 2}


def bag(text: str, label: int, index: dict[str, int], known: dict[str, list[int]]) -> Bag:
    """known: of words seen so far, the indices of their features."""
    plain, named = 0, []
    for s in sentences(text):
        own: list[int] = []
        for w in s:
            if (at := known.get(w)) is None:
                if len(known) > CACHE_WORDS:
                    known.clear()
                at = known[w] = [index[f] for f in features(w) if f in index]
            own += at
        if own:
            named.append(own)
        else:
            plain += 1
    return Bag(label, plain, named)


def descend(bags: list[Bag], start: dict[str, float], toxic_share: float, rounds: int = 300, rate: float = 0.3, l2: float = 1e-6) -> Model:
    """Gradient descent through the noisy-or of each bag's sentences; toxic_share: of all labels."""
    labels = np.array([b.label for b in bags], float)
    home = np.repeat(np.arange(len(bags)), [len(b.named) for b in bags])
    plain = np.array([b.plain for b in bags], float)
    sizes = [len(s) for b in bags for s in b.named]
    feat, sent = np.array([f for b in bags for s in b.named for f in s], np.int64), np.repeat(np.arange(len(sizes)), sizes)
    n1, n0 = labels.sum(), (1 - labels).sum()
    weight = np.where(labels > 0, toxic_share / n1, (1 - toxic_share) / n0)
    w, b = np.array(list(start.values())), -6.0
    step_w, step_b = np.full(len(w), 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(sent, w[feat], len(home))
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-b))
        none = np.bincount(home, -np.logaddexp(0, z), len(bags)) - plain * np.logaddexp(0, b)  # log of prod(1 - p)
        any_ = np.maximum(-np.expm1(none), 1e-12)
        pull = weight * np.where(labels > 0, -np.exp(none) / any_, 1.0)
        g = pull[home] * p
        gw, gb = np.bincount(feat, g[sent], len(w)) + l2 * w, g.sum() + (pull * plain).sum() * p0
        step_w, step_b = step_w + gw * gw, step_b + gb * gb
        w, b = w - rate * gw / np.sqrt(step_w), b - rate * gb / np.sqrt(step_b)
    return Model({f: float(x) for f, x in zip(start, w) if abs(x) > 1e-3}, float(b))


def fit(rows: list[tuple[str, int]], toxic_share: float) -> Model:
    """From texts and labels in memory; toxic_share: of all labels."""
    n_toxic = sum(y for _, y in rows)
    if not 0 < n_toxic < len(rows):
        return Model({}, 0.0, toxic_share)
    clean, toxic = feature_counts(rows)
    start = choose(((f, clean[f], n) for f, n in toxic.items()), len(rows) - n_toxic, n_toxic)
    index, known = {f: i for i, f in enumerate(start)}, {}
    return descend([bag(t, y, index, known) for t, y in rows], start, toxic_share)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.words = model, {".": None}

    def weight(self, token: str) -> float | None:
        """None: the end of a sentence."""
        if token[0] in ".!?\n":
            return None
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        value = self.words[token] = sum(self.model.weights.get(f, 0.0) for f in features(token))
        return value

    def sentence_scores(self, text: str) -> np.ndarray:
        get = self.words.get
        tokens = TOKEN.findall(text.lower())
        found = [get(t, -1e9) for t in tokens]
        value = np.array([np.nan if (v if v != -1e9 else self.weight(t)) is None else (v if v != -1e9 else self.words[t]) for t, v in zip(tokens, found)]) if (None in found or -1e9 in found) else np.array(found, float)
        if not len(value):
            return np.array([1 / (1 + np.exp(-self.model.bias))])
        ends = np.isnan(value)
        # A sentence has a word; ends that follow each other or stand first close none.
        number = np.concatenate([[0], np.cumsum(ends)[:-1]])[~ends]
        if not len(number):
            return np.array([1 / (1 + np.exp(-self.model.bias))])
        cut = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        return 1 / (1 + np.exp(-(self.model.bias + np.add.reduceat(value[~ends], cut))))

    def score(self, text: str) -> tuple[float, np.ndarray]:
        if self.model.constant is not None:
            return self.model.constant, np.zeros(0)
        p = self.sentence_scores(text)
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-15)).sum())), p

    def offending(self, text: str, p: np.ndarray, least: float) -> list[dict]:
        """Character ranges of the sentences with a score of least or more."""
        if not (p >= least).any():
            return []
        out, k, at = [], 0, 0
        for m in itertools.chain(END.finditer(text), [None]):
            stop = m.end() if m else len(text)
            if WORD.search(text[at:stop].lower()):
                if k < len(p) and p[k] >= least:
                    out.append({"start": at, "end": stop, "score": float(p[k])})
                k += 1
            at = stop
        return out


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = 3000, max_clean: int = 5000) -> Model:
    """docs: doc_id, text; labels: doc_id, label (0, 1), of the rows that may be learnt from. Tasks turn texts into bags of feature numbers; these alone reach the driver."""
    spark = docs.sparkSession
    labels = labels.where("doc_id is not null and label is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("label").cast("int").alias("label"))
    shares = {r.label: r.n for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    toxic_share = shares.get(1, 0) / max(1, sum(shares.values()))
    picked = by_hash(labels.where("label = 1"), max_toxic).unionByName(by_hash(labels.where("label = 0"), max_clean))
    sample = staged(texts(docs, picked), "sample")
    numbers = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(numbers) < 2:
        return Model({}, 0.0, toxic_share)

    def rows(frame: pa.RecordBatch) -> list[tuple[str, int]]:
        return list(zip(frame.column(1).to_pylist(), frame.column(0).to_pylist()))

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            clean, toxic = feature_counts(rows(frame))
            names = sorted(clean | toxic)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([clean[f] for f in names], pa.int64()), pa.array([toxic[f] for f in names], pa.int64())], ["feature", "clean", "toxic"])

    counted = sample.select("label", "text").mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    often = counted.where((F.col("toxic") >= LEAST) & ((F.col("toxic") + 0.5) / (numbers[1] + 1) > 2 * (F.col("clean") + 0.5) / (numbers[0] + 1)))
    start = choose(((r.feature, r.clean, r.toxic) for r in often.collect()), numbers[0], numbers[1])
    shared = spark.sparkContext.broadcast({f: i for i, f in enumerate(start)})
    kind = pa.list_(pa.list_(pa.int32()))

    def bags(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for frame in frames:
            made = [bag(t, y, shared.value, known) for t, y in rows(frame)]
            yield pa.RecordBatch.from_arrays([frame.column(2), frame.column(0), pa.array([b.plain for b in made], pa.int64()), pa.array([b.named for b in made], kind)], ["doc_id", "label", "plain", "named"])

    found = sample.select("label", "text", "doc_id").mapInArrow(bags, "doc_id long, label int, plain long, named array<array<int>>").collect()
    return descend([Bag(r.label, r.plain, r.named) for r in sorted(found, key=lambda r: (r.doc_id, r.label))], start, toxic_share)


def score(docs: DataFrame, model: Model, sentence_least: float = 0.5) -> DataFrame:
    """doc_id, score, and the character ranges of offending sentences, for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for frame in frames:
            scores, where = [], []
            for t in frame.column(1):
                text = t.as_py()
                s, p = scorer.score(text)
                scores.append(s)
                where.append(scorer.offending(text, p, sentence_least))
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(scores, pa.float64()), pa.array(where, kind)], ["doc_id", "score", "offending"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, OUTPUT)


def keep_clean(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs with a score below least; all of them where no model could be fitted (the score is a constant that says nothing of a text)."""
    if model.constant is not None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pa.array([scorer.score(t.as_py())[0] < least for t in batch], pa.bool_())

    return docs.where(clean(F.coalesce("text", F.lit(""))))
