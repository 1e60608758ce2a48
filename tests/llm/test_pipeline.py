"""The corpus pipeline, stage by stage and whole."""

import zlib
from collections import defaultdict

import numpy as np
import plain
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import quality, toxicity
from ledgerloom.llm.tokens import tokenizer_path
from ledgerloom.plans.shared import read_table, staged

SMALL = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "simhash", "packing"]


def models(monkeypatch):
    """The models that the stages fit, in order."""
    seen = []
    for module in (toxicity, quality):
        train = module.train
        monkeypatch.setattr(module, "train", lambda *a, train=train: seen.append(train(*a)) or seen[-1])
    return seen


def test_whole_run_against_brute_force(spark, monkeypatch):
    """Every stage text by text in plain Python from the weights that were learnt, and the library's ids of every document that stays."""
    seen = models(monkeypatch)
    packed = corpus_pipeline.run(spark, SMALL).collect()
    toxic, fine = seen
    docs = sorted((r.doc_id, r.text or "") for r in read_table(spark, SMALL, "documents").collect())
    docs = [x for x in docs if plain.noisy_or(toxic, x[1]) < corpus_pipeline.TOXIC]
    left = [x for x in docs if plain.quality(fine, np.array(quality.describe(x[1]), np.float32).tolist()) >= corpus_pipeline.GOOD]
    assert 0 < len(left) < len(docs) < 200
    prints = [plain.simhash(t) for _, t in left]
    parts = plain.classes(len(left), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    kept = [x for i, x in enumerate(left) if parts[i] == i]
    assert sorted({r.doc_id for r in packed}) == [d for d, _ in kept] and len(kept) < len(left)
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    by, spots = defaultdict(list), defaultdict(list)
    for r in packed:
        by[r.doc_id].append(r)
        spots[r.sequence_id].append((r.offset, r.length))
    for d, t in kept:
        ids, at = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(by[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in spots.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:])) and sum(n for _, n in pieces) <= 1024
    assert len(spots) == -(-sum(r.length for r in packed) // 1024)


def test_stages_keep_columns(spark):
    docs = read_table(spark, SMALL, "documents").withColumn("score", F.lit(1.5)).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(7))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SMALL), name)
        assert docs.columns == [*read_table(spark, SMALL, "documents").columns, "score", "fp", "component_id"] and docs.where("score <> 1.5 or fp <> 'x' or component_id <> 7").count() == 0


def test_stages_on_odd_rows(spark, odd_documents):
    """Nulls, empty and very long texts, ties, repeated rows and clashing names: what the labels say nothing of stays, once for each text."""
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES[2:]:
        docs = staged(stage(spark, docs, SMALL), name)
    # Words: x; none (5, 6, 10); same text (7, 8, 8); word; and the odd one.
    assert {r.doc_id for r in docs.collect()} == {None, 5, 7, 9, 11}
    corpus_pipeline.drop_toxic(spark, odd_documents, SMALL).count(), corpus_pipeline.keep_good(spark, odd_documents, SMALL).count()


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_stages_on_nothing(spark, no_documents):
    docs = no_documents
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_near_duplicates_keep_rows_of_hot_and_null_ids(spark):
    """Different texts under one doc_id, or none, are different documents; which row stays doesn't depend on partitions."""
    long = [f"{w} " * 30 + f"only {w} here" for w in ("alpha", "bravo", "carol", "delta", "echoes", "foxtrot")]
    rows = [(1, long[0]), (1, long[1]), (1, long[2]), (None, long[3]), (None, long[4]), (None, long[0]), (2, long[0]), (3, long[5]), (3, long[5]), (3, long[5]), (None, long[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(1, long[0]), (1, long[1]), (1, long[2]), (None, long[3]), (None, long[4]), (3, long[5])], key=str)
    stages = dict(corpus_pipeline.STAGES)
    for parts in (1, 5):
        once = stages["simhash"](spark, docs.repartition(parts), SMALL)
        assert once.columns == docs.columns and sorted((tuple(r) for r in once.collect()), key=str) == want
    packed = stages["packing"](spark, once, SMALL).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] >= n for r, n in ((r, {1: 3, None: 2, 3: 1}[r.doc_id]) for r in packed)} == {1: True, None: True, 3: True}


def test_unfitted_models_drop_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one text"), (2, "other text"), (None, None)], "doc_id long, text string")
    for labels in ([], [(1, 0, 1), (2, 0, 1)], [(9, 1, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        monkeypatch.setattr(corpus_pipeline, "read_table", lambda *a, frame=frame: frame)
        for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.keep_good):
            assert sorted(map(tuple, stage(spark, docs, SMALL).collect()), key=str) == [(1, "one text"), (2, "other text"), (None, None)]


def test_stages_take_any_column(spark):
    """Columns named as descriptions are, maps and dotted names pass through all filters."""
    docs = read_table(spark, SMALL, "documents").limit(60)
    docs = docs.withColumn("__quality_x", F.lit("mine")).withColumn("description", F.lit(3)).withColumn("a.b", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, SMALL), name)
        assert after.columns == docs.columns and after.where("__quality_x <> 'mine' or description <> 3 or `a.b` <> 1 or m['k'] <> doc_id").count() == 0
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0
