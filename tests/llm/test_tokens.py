"""Token files, BPE and packing against the tokenizers library."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, packing, queries, token_files
from ledgerloom.llm.tokens import ByteEncoder, TokenCache, tokenizer_path
from ledgerloom.plans.shared import fresh_path, read_table

SMALL = "/root/testdata/sf0.001"
BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
TEXTS = st.lists(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(["'s", "'", "re", "ll", " ", "\n", "\xa0", "a", "É", "9", "²", "!", "aaaa", "<|endoftext|>", "Σ", "İ", "中", "😀", "\x1c", "\x85"]), max_size=12).map("".join)), min_size=1, max_size=20)
library, words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
encoder, merger = ByteEncoder(BYTES, entries=200), bpe.WordBpe(WORDS, entries=200)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_byte_encoder_equals_library(texts):
    ids, offs = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_word_bpe_equals_library(texts):
    for t, ids in zip(texts, merger.encode(texts)):
        assert ids.tolist() == words.encode(t, add_special_tokens=False).ids
        assert merger.decode(ids) == words.decode(ids.tolist(), skip_special_tokens=False)


def test_cache_stays_bounded():
    small = ByteEncoder(BYTES, entries=50)
    texts = [f"word{i} other{i * 7}" for i in range(300)]
    for t in (texts, texts[::-1]):
        small.encode(t[:10]), small.encode(t)
        assert small.cache.n <= 50
    cache = TokenCache(8)
    h = np.array([1 << 20 | 1, 1 << 21 | 1], np.uint64)
    cache.add(h, np.array([5, 6, 7], np.int32), np.array([1, 2]))
    assert cache.find(h).tolist() == [0, 1] and cache.find(np.array([9], np.uint64)).tolist() == [-1]


@pytest.mark.parametrize("bits", [0, 3])
def test_colliding_pre_tokens(monkeypatch, bits):
    """Pre-tokens of one hash (all, or by their length): ids are right all the same."""
    from ledgerloom.llm import tokens

    monkeypatch.setattr(tokens, "hashes", lambda cp, s, e: ((e - s) & bits).astype(np.uint64) << np.uint64(20) | np.uint64(1))
    texts = ["one two three one two", "", "aaaa bbbb aaaa cccc", "don't 12 éé é " * 5]
    for _ in range(2):
        ids, offs = ByteEncoder(BYTES).encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in bpe.WordBpe(WORDS).encode(texts)] == [words.encode(t, add_special_tokens=False).ids for t in texts]


def expected(rows, end):
    return [(d, np.array([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for d, t in rows]


def test_token_files(spark, odd_documents):
    folder = token_files.write_token_files(odd_documents, fresh_path(spark, "t"), shards=3, block_docs=2)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in token_files.read_token_files(spark, folder, with_ids=True).collect()]
    rows = sorted(((r.doc_id, r.text) for r in odd_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0))  # equal ids have equal texts here
    at, want = 0, []
    for d, ids in expected(rows, 2):
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    key = lambda r: r[1]
    assert sorted(got, key=key) == sorted(want, key=key)
    one = token_files.read_token_files(spark, folder, only=[11]).collect()
    assert [r.doc_id for r in one] == [11] and one[0].start == next(r[1] for r in want if r[0] == 11)
    blocks = token_files.read_blocks(spark, folder).collect()
    assert len({b.dictionary_hash for b in blocks}) == 1 and all(len(b.doc_ids) <= 2 for b in blocks)


def test_token_files_of_nothing(spark, no_documents):
    folder = token_files.write_token_files(no_documents, fresh_path(spark, "t"))
    assert token_files.read_token_files(spark, folder).count() == 0


def test_token_query(spark):
    docs = sorted((r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect())
    at, want = 0, []
    for d, ids in expected(docs, 2):
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in queries.op2_token_files(spark, SMALL).collect()) == want


def test_bpe_query(spark):
    want = []
    for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect():
        ids = words.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(words.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(tuple(r) for r in queries.op8_bpe(spark, SMALL).collect()) == sorted(want)


def test_bpe_odd_rows(odd_documents, no_documents):
    done = bpe.encode(odd_documents)
    got = {(r.doc_id, r.n_tokens) for r in done.collect()}
    assert got == {(r.doc_id, len(words.encode(r.text or "", add_special_tokens=False).ids)) for r in odd_documents.collect()} and done.count() == 9
    assert {r.decoded for r in bpe.decode(done.where("doc_id = 6")).collect()} == {""}
    assert bpe.encode(no_documents).count() == 0


def check_packing(rows, docs, window=1024):
    full = defaultdict(list)
    for d, ids in expected(docs, 0):
        full[d].append(ids)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == full.keys()
    for d, pieces in by_doc.items():
        ids = full[d][0]
        assert all(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces)
        cover = np.zeros(len(ids) + 1, int)
        for r in pieces:
            cover[r.start] += 1
            cover[r.start + r.length] -= 1
        assert (np.cumsum(cover)[:-1] == len(full[d])).all()
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert 0 < at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert check_packing(queries.op9_packing(spark, SMALL).collect(), docs) < 1024


def test_packing_odd_rows(odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert check_packing(packing.pack(odd_documents).collect(), docs) < 1024
    assert packing.pack(no_documents).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_plan_places_every_tail_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(1024, np.int64)
    np.add.at(counts, rng.integers(1, 1024, 60000) if seed == 1 else rng.choice([700, 324, 10, 1023, 512], 60000), 1)
    rows, used = packing.plan(counts)
    covered = np.zeros(1024, np.int64)
    for n, low, high, *_ in rows:
        assert low == covered[n]
        covered[n] = high
    assert (covered == counts).all() and used >= -(-int((np.arange(1024) * counts).sum()) // 1024)
    residual = sum((h - lo) for _, lo, h, _, each, _ in rows if not each)
    assert residual < counts.sum() * (0.35 if seed == 1 else 0.7)
    combos = packing.combinations(1024, 16)
    assert (combos.sum(1) == 1024).all()


def test_packing_spreads_equal_tails(spark):
    """Many tails of one length, repeated rows among them: more groups than one, each id in one piece, hardly any padding."""
    rows = [(None, "")] * 300 + [(i, "a b c") for i in range(200)] + [(5, "word " * 3000)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), salt_rows=16).collect()
    spots = defaultdict(list)
    for r in out:
        spots[r.sequence_id].append((r.offset, r.length))
    for pieces in spots.values():
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:])) and pieces[0][0] == 0 and sum(n for _, n in pieces) <= 1024
    total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in out) == total and len(spots) == -(-total // 1024)


def test_rows_alike_are_several_shards(spark):
    """Repeated rows of one doc_id and text are cut by a number, and the dictionary doesn't depend on partitions."""
    docs = spark.createDataFrame([(1, "same words again")] * 400 + [(1, "other"), (2, "b"), (None, "c")], "doc_id long, text string")
    seen = set()
    for parts in (2, 5):
        folder = token_files.write_token_files(docs.repartition(parts), fresh_path(spark, "tokens"), shards=4)
        assert token_files.read_blocks(spark, folder).where("array_contains(doc_ids, 1)").select("shard").distinct().count() > 1
        assert token_files.read_token_files(spark, folder).count() == 403
        seen |= {r.dictionary_hash for r in token_files.read_blocks(spark, folder).collect()}
    assert len(seen) == 1
