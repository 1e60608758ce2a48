"""Near-duplicates and fingerprints against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import doc_prints, embedding_dedup, queries, simhash
from ledgerloom.llm.forest import Forest
from ledgerloom.plans.shared import read_table

SMALL = "/root/testdata/sf0.001"


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_forest():
    rng = np.random.default_rng(1)
    i, j = rng.integers(0, 200, 120), rng.integers(0, 200, 120)
    f = Forest(200)
    f.link(i[:50], j[:50]), f.link(i[50:], j[50:])
    assert f.parent.tolist() == components(200, zip(i.tolist(), j.tolist()))


def brute_vectors(rows, threshold):
    """By row number, as ids may be missing."""
    good = [(k, np.array(v, float)) for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, pairs = {k: 0 for k, _ in good}, []
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            (i, x), (j, y) = good[a], good[b]
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                links[i] += 1
                links[j] += 1
                pairs.append((a, b))
    parts, members = components(len(good), pairs), {}
    for a, (k, _) in enumerate(good):
        members.setdefault(parts[a], []).append(rows[k][0])
    least = {k: min((i for i in members[parts[a]] if i is not None), default=None) for a, (k, _) in enumerate(good)}
    return sorted(((i, links.get(k, 0), least.get(k, i), least.get(k, i) == i) for k, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block_rows", [4096, 32])
def test_vectors(spark, block_rows, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + rng.standard_normal(16) * rng.choice([0.05, 0.3, 3])).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [1.0, 2.0]), (2005, [2.0, 4.0]), (2006, [float("inf")] * 16), (2007, [])]
    rows += [(None, rows[3][1]), (None, rows[3][1]), (None, [-50.0 + i for i in range(16)]), (None, [-50.0 + i for i in range(16)]), (None, None)]  # vectors without an id link too
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit("clash"))
    links = embedding_dedup.links
    monkeypatch.setattr(embedding_dedup, "links", lambda *a: links(*a, block_rows=block_rows))
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert got == brute_vectors(rows, 0.95)


def test_vector_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, SMALL, "embeddings").collect()]
    assert sorted((tuple(r) for r in queries.op1_embedding_dedup(spark, SMALL).collect()), key=str) == brute_vectors(rows, 0.95)
    assert embedding_dedup.near_duplicates(read_table(spark, SMALL, "embeddings").where("false")).count() == 0


def pairs_at(threshold, n, dim, seed):
    """Pairs of unit vectors whose cosine is the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.standard_normal((n, dim))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    return x, threshold * x + np.sqrt(1 - threshold**2) * y


def test_calibration_holds():
    """Pairs at the threshold itself pass the count, and share a key, with the promised recall."""
    cal = embedding_dedup.calibrate()
    x, y = pairs_at(0.95, 4000, 64, 3)
    d = np.abs((x - y) @ embedding_dedup.directions(64))
    passed = ((d[:, 1:] <= cal.half_width).sum(1) >= cal.count) & (d[:, 0] <= cal.reach)
    assert passed.mean() > 0.998
    for classes in (100, 50_000, 10**9):
        deal = embedding_dedup.dealing(classes)
        met = (embedding_dedup.compound_keys(x, deal) == embedding_dedup.compound_keys(y, deal)).any(1)
        assert met.mean() > 0.998
    few, many = embedding_dedup.dealing(10**6), embedding_dedup.dealing(10**9)
    assert many.tables <= 1.2 * 1000**0.15 * few.tables  # tables grow with a small power of the classes


def test_recall_at_the_threshold(spark):
    """The whole operator on pairs just above the threshold among unlike vectors."""
    x, y = pairs_at(0.9501, 1500, 48, 11)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(r.n_links >= 1 and r.component_id == r.vec_id % 1500 for r in got) >= 0.995 * len(rows)
    x, y = pairs_at(0.9499, 300, 48, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    assert all(r.n_links == 0 for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())


@pytest.mark.parametrize("block_rows, small, task_rows", [(4096, 128, 1 << 15), (40, 4, 100), (64, 1000, 64)])
def test_dense_group_of_vectors(spark, block_rows, small, task_rows):
    """A third of all vectors within one another's reach, all unlike: every link counted once, however keys are split."""
    rng = np.random.default_rng(block_rows)
    centre = rng.standard_normal(24)
    near = centre + rng.standard_normal((150, 24)) * 0.14
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([near, rng.standard_normal((300, 24))]))]
    classes = spark.createDataFrame([(i, 1, v) for i, v in rows], "rep long, n long, embedding array<double>")
    found = embedding_dedup.links(classes, block_rows=block_rows, small=small, task_rows=task_rows).collect()
    counts = {i: 0 for i, _ in rows}
    for r in found:
        if r.b is None:
            counts[r.a] += r.n
    want = {i: n for i, n, *_ in brute_vectors(rows, 0.95)}
    assert counts == want and sum(want.values()) > 5000
    assert len({frozenset(x) for x in [(r.a, r.b) for r in found if r.b is not None]}) > 0


def brute_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


@pytest.mark.parametrize("rows, depth, chunk", [(400, 0, 8192), (400, 4, 8192), (400, 3, 20)])
def test_trie_join_finds_all(spark, rows, depth, chunk):
    rng = random.Random(rows + depth + chunk)
    prints = [rng.getrandbits(64) for _ in range(rows // 2)]
    while len(prints) < rows:
        x = rng.choice(prints)
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.randrange(64)
        prints.append(x)
    prints = sorted(set(prints))
    want = components(len(prints), [(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3])
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    edges = simhash.links(spark.createDataFrame(signed, "fp long, rep long"), subtree_rows=chunk, depth=depth)
    assert components(len(prints), [(r.a, r.b) for r in edges.collect()]) == want


def test_simhash_query(spark):
    docs = sorted((r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect())
    fp = [brute_print(t) for _, t in docs]
    parts = components(len(docs), [(i, j) for i in range(len(docs)) for j in range(i + 1, len(docs)) if (fp[i] ^ fp[j]).bit_count() <= 3])
    want = [(docs[i][0], f"{fp[i]:016x}", docs[parts[i]][0]) for i in range(len(docs))]
    assert sorted(tuple(r) for r in queries.op3_simhash(spark, SMALL).collect()) == want


def test_simhash_odd_rows(odd_documents, no_documents):
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(odd_documents).collect()), key=str)
    assert got == sorted([(None, None), (5, 5), (6, 5), (7, 7), (8, 7), (8, 7), (9, 9), (10, 5), (11, 11)], key=str)
    kept = simhash.keep_first(odd_documents)
    assert kept.columns == odd_documents.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [11, 5, 7, 9, None]
    assert simhash.near_duplicates(no_documents).count() == 0 and simhash.keep_first(no_documents).count() == 0


def test_doc_prints_by_brute_force(spark):
    texts = ["one Two three two", "a", "", "  ", "two two two", "Éa b 😀c d e f g"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.fp & (2**64 - 1) for r in doc_prints.fingerprints(df, ["k"]).collect()}
    for k, t in enumerate(texts):
        words = [w for w in t.lower().split() if w]
        pairs = [(w, words[i + 1] if i + 1 < len(words) else None) for i, w in enumerate(words)]
        h = [r.h & (2**64 - 1) for r in spark.createDataFrame(pairs, "a string, b string").select(F.xxhash64("a", "b").alias("h")).collect()] if pairs else []
        w = [min(16, len(a) + len(b or "")) for a, b in pairs]
        assert got[k] == sum(1 << b for b in range(64) if 2 * sum(x for x, y in zip(w, h) if y >> b & 1) > sum(w))


def test_edited_texts(spark, odd_documents, no_documents):
    import hashlib

    def check(df):
        rows = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in doc_prints.with_likeness(doc_prints.edited_fingerprints(df)).collect())
        want = []
        for i, (d, t) in enumerate(rows):
            h = len(t) // 2
            want.append((d is not None, d or 0, len(t), hashlib.sha256((t[: len(t) - h] + rows[(i + 1) % len(rows)][1][:h]).encode()).hexdigest()))
        assert got == sorted(want)

    check(odd_documents)
    check(read_table(spark, SMALL, "documents"))
    check(odd_documents.where("doc_id = 7"))
    assert doc_prints.with_likeness(doc_prints.edited_fingerprints(no_documents)).count() == 0
    out = doc_prints.with_likeness(doc_prints.edited_fingerprints(odd_documents)).collect()
    assert len({r.fingerprint for r in out if r.doc_id in (7, 8)}) == 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)


def test_native_plan(spark):
    plan = doc_prints.edited_fingerprints(read_table(spark, SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("radius, blocks", [(3, 6), (3, 4), (0, 1), (5, 8)])
def test_block_tables(spark, radius, blocks):
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for x in list(prints):
        for _ in range(3):
            y = x
            for _ in range(rng.randrange(1, 8)):
                y ^= 1 << rng.randrange(64)
            prints.add(y)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = sorted((a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
    got = doc_prints.block_links(spark.createDataFrame([(p,) for p in signed * 2], "fp long"), radius, blocks)
    assert sorted((r.a, r.b) for r in got.collect()) == want


def brute_doc_print(spark, texts):
    """Fingerprints by plain arithmetic over the terms; Spark gives the terms' hashes alone."""
    terms, weights = [], {}
    for k, t in enumerate(texts):
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", t.lower()) if w]
        terms += [(k, i, w, words[i + 1] if i + 1 < len(words) else None) for i, w in enumerate(words)]
    for k, h, a, b in spark.createDataFrame(terms, "k int, i int, a string, b string").select("k", F.xxhash64("a", "b"), F.col("a"), F.col("b")).toLocalIterator():
        total, bits = weights.setdefault(k, [0, [0] * 64])
        w = min(16, len(a) + len(b or ""))
        weights[k][0] = total + w
        for bit in range(64):
            bits[bit] += w * (h >> bit & 1)
    return [sum(1 << bit for bit, v in enumerate(weights[k][1]) if 2 * v > weights[k][0]) if k in weights else 0 for k in range(len(texts))]


def test_fingerprint_query(spark):
    """Every column of the query over the whole small table."""
    docs = sorted((r.doc_id, r.text or "") for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect())
    edited = [t[: len(t) - len(t) // 2] + docs[(i + 1) % len(docs)][1][: len(t) // 2] for i, (_, t) in enumerate(docs)]
    fp, other = brute_doc_print(spark, [t for _, t in docs]), brute_doc_print(spark, edited)
    like = lambda a, b: 1 - (a ^ b).bit_count() / 64
    kinds = set(fp)
    near = {a: sum(1 for b in kinds if a != b and (a ^ b).bit_count() <= 3) for a in kinds}
    want = [(d, len(t), f"{fp[i]:016x}", f"{other[i]:016x}", like(fp[i], other[i]), like(fp[i], fp[(i + 1) % len(docs)]), near[fp[i]]) for i, (d, t) in enumerate(docs)]
    got = queries.op4_fingerprints(spark, SMALL).select("doc_id", "n_chars", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near").collect()
    assert sorted(map(tuple, got)) == want


def test_order_of_hot_ids(spark):
    """A doc_id, or none, that a third of the rows have, and rows repeated often: many ranges, and the same order."""
    rows = [(None, f"n{i % 50}") for i in range(100)] + [(7, f"t{i}") for i in range(100)] + [(i, f"x{i}") for i in range(20, 60)] + [(9, "same")] * 90
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = doc_prints.with_next(df, 16).collect()
    follow = {(r.bucket, r.number): r for r in out}
    assert len(follow) == len(rows) and len({r.bucket for r in out if r.doc_id == 7}) > 3 and len({r.bucket for r in out if r.doc_id is None}) > 3 and len({r.bucket for r in out if r.doc_id == 9}) > 3
    at, seen = min(follow), []
    for _ in rows:
        seen.append(follow[at])
        at = follow[at].next_bucket, follow[at].next_number
        assert seen[-1].next_text == follow[at].text
    assert at == min(follow) and len({(r.bucket, r.number) for r in seen}) == len(rows)
    ids = [r.doc_id for r in seen]
    assert ids[:100] == [None] * 100 and ids[100:] == sorted(ids[100:]) and sorted(map(str, (r.text for r in seen))) == sorted(t for _, t in rows)


@pytest.mark.parametrize("chunk", [512, 7])
def test_block_counts_of_a_dense_group(spark, chunk):
    rng = random.Random(chunk)
    centre = rng.getrandbits(64)
    prints = {centre} | {rng.getrandbits(64) for _ in range(50)}
    while len(prints) < 250:
        x = centre
        for _ in range(rng.randrange(1, 4)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    want = {signed[a]: n for a in prints if (n := sum(1 for b in prints if a != b and (a ^ b).bit_count() <= 3))}
    df = spark.createDataFrame([(x,) for x in signed.values()] * 2, "fp long")
    assert {r.fp: r.n_near for r in doc_prints.block_counts(df, chunk_rows=chunk).collect()} == want


def test_texts_that_share_an_id_stay(spark):
    """Unlike texts stay, whatever their doc_id."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    unlike = [" ".join(random.Random(k).choices(words, k=60)) + f" w{k}" for k in range(4)]
    rows = [(1, unlike[0]), (1, unlike[1]), (None, unlike[2]), (None, unlike[3]), (2, unlike[0]), (None, unlike[1])]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(rows[:4], key=str)


def test_keep_first_keeps_what_differs_in_any_column(spark):
    """Nulls in different columns, maps, dotted names and names that were inner ones: no row vanishes, nothing crashes."""
    words = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(None, words, None, {"a": 1}), (None, None, words, {"a": 1}), (1, "other words of another kind altogether here", None, None), (1, "other words of another kind altogether here", "x", {"b": 2}), (1, "other words of another kind altogether here", "x", {"b": 2})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, m map<string,int>")
    for name in ("__h1", "row", "Row_", "number", "text_hash", "fp"):
        docs = docs.withColumn(name, F.lit(5))
    for parts in (1, 4):
        kept = simhash.keep_first(docs.repartition(parts))
        assert kept.columns == docs.columns
        got = sorted(((r.doc_id, r.text, r["a.b"]) for r in kept.collect()), key=str)
        assert len(got) == 3
        assert {(r[0], r[1]) for r in got} == {(None, words), (None, None), (1, rows[2][1])}
