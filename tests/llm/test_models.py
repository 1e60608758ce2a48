"""Classifiers, chat formatting and page extraction."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import chat, folds, html_extract, quality, queries, toxicity
from ledgerloom.llm.html_blocks import leaf_blocks
from ledgerloom.plans.shared import read_table

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def held_out(spark, query, label, parts, rest):
    got = {r.doc_id: r for r in query(spark, MIDDLE).collect()}
    assert len(got) == read_table(spark, MIDDLE, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % parts == rest) and 0 <= r.score <= 1 for d, r in got.items())
    rows = [(got[r.doc_id].predicted, r[label]) for r in read_table(spark, MIDDLE, "labels").collect() if got[r.doc_id].held_out]
    return np.mean([a == b for a, b in rows])


def test_toxicity_held_out(spark):
    assert held_out(spark, queries.op5_toxicity, "toxic", 5, 0) > 0.97


def test_quality_held_out(spark):
    assert held_out(spark, queries.op6_quality, "quality", 4, 2) > 0.97


def test_noisy_or_locates_sentences():
    rng = np.random.default_rng(1)
    plain = [f"w{i}x" for i in range(60)]
    rows = []
    for i in range(300):
        sents = [" ".join(rng.choice(["al", "be", "ce", "de", "ef", "gi"], 5)) for _ in range(rng.integers(1, 6))]
        if i % 5 == 0:
            sents[rng.integers(len(sents))] += " vile thing"
        rows.append((". ".join(sents) + ".", int(i % 5 == 0)))
    model = toxicity.fit(rows, 0.2)
    scorer = toxicity.Scorer(model)
    text = "Al be ce. Be vile thing! De ef."
    s, p = scorer.score(text)
    assert s > 0.5 and [text[o["start"] : o["end"]] for o in scorer.offending(text, p, 0.5)] == [" Be vile thing!"]
    assert scorer.score("Al be ce. De.")[0] < 0.5 and scorer.score("")[0] < 0.5 and scorer.score("... !")[0] < 0.5 and plain
    brute = 1 - np.prod([1 - 1 / (1 + np.exp(-(model.bias + sum(model.weights.get(f, 0) for w in sent for f in toxicity.features(w))))) for sent in toxicity.sentences(text)])
    assert s == pytest.approx(brute)
    assert toxicity.fit([], 0.0).constant == 0.0


def test_prior_and_risk():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(2, 1, (3000, 3)), rng.normal(-2, 1, (1000, 3))
    model = quality.fit(good[:1500], np.concatenate([good[1500:], bad]))
    assert model.prior == pytest.approx(0.6, abs=0.08)
    assert (quality.probabilities(good[:500], model) >= 0.5).mean() > 0.93 and (quality.probabilities(bad, model) >= 0.5).mean() < 0.1
    assert quality.probabilities(good[:2], quality.fit(good[:0], good)).tolist() == [0.5, 0.5]


@pytest.mark.parametrize("module, keep", [(toxicity, toxicity.keep_clean), (quality, quality.keep_good)])
def test_classifiers_on_odd_rows(spark, odd_documents, no_documents, module, keep):
    labels = spark.createDataFrame([(7, 1), (9, 0), (11, 0), (None, 1), (8, None)], "doc_id long, label int")
    for l in (labels, labels.where("false")):
        model = module.train(odd_documents, l)
        scores = module.score(odd_documents, model).collect()
        assert len(scores) == 9 and all(0 <= r.score <= 1 for r in scores)
        kept = keep(odd_documents, model)
        assert kept.schema == odd_documents.schema
        assert kept.count() == sum((r.score < 0.5) if module is toxicity else (r.score >= 0.7) for r in scores)
    assert module.score(no_documents, model).count() == 0
    module.train(no_documents, labels)


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(["<|turn|>", "<|end|>\n", "\\", "<", "|", "</s>", "[INST]", "[/INST]", "[", "<s>", "<\\|", "x"]), max_size=10).map("".join)))
def test_escape_is_reversible(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text
    assert not any(c in e for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def brute_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t for *_, r, t in turns if r == "assistant")
        total = sum(len(chat.OPEN + chat.escape(r) + chat.SAYS + chat.escape(t) + chat.CLOSE) for *_, r, t in turns)
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), total))
    return sorted(out, key=str)


def test_chat_query(spark):
    odd = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in read_table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()] + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    assert sorted((tuple(r) for r in queries.op7_chat(spark, SMALL).collect()), key=str) == brute_chat(rows)


def test_chat_odd_rows(spark):
    rows = [(None, 1, "user", "a"), (1, None, None, None), (1, 2, "assistant", "<|end|>\n" * 3), (1, 2, "assistant", "b"), (1, 2, "assistant", "b"), (2, 0, "a<|says|>b", "x" * 100000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))
    got = sorted((tuple(r) for r in chat.digests(chat.format_turns(df.withColumn("parts", chat.text_parts()))).collect()), key=str)
    assert got == brute_chat(rows)
    assert chat.digests(chat.format_turns(df.where("false").withColumn("parts", chat.text_parts()))).count() == 0


def test_chat_parts(spark):
    parts = [{"type": "text", "text": "see <|image:0|> "}, {"type": "image", "uri": "a.png", "width": 57, "height": 28}, {"type": "audio", "uri": "b.wav", "seconds": 2.1}, {"type": "document", "uri": "c.pdf", "pages": 2}, {"type": "text", "text": "end"}]
    row = chat.format_turns(spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")).first()
    (role, text), = chat.parse(row.segment)
    assert role == "user" and row.attachment_tokens == 3 + 53 + 2048
    assert [(a.kind, a.uri, a.tokens) for a in row.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 53), ("document", "c.pdf", 2048)]
    content = row.segment[len(chat.OPEN + "user" + chat.SAYS) : -len(chat.CLOSE)]
    assert [content[a.place :].split("|>")[0] for a in row.attachments] == ["<|image:0", "<|audio:1", "<|document:2"]
    assert len(chat.PLACEHOLDER.findall(content)) == 3
    with pytest.raises(Exception, match="unknown part"):
        chat.Flattener().visit({"type": "video"})


@pytest.fixture(scope="module")
def model():
    return html_extract.fitted()


def test_held_out_layouts(model):
    """Generated pages that weren't trained on."""
    extractor = html_extract.Extractor(model)
    pages = html_extract.labelled_pages(150, seed=77)
    wrong = sum(extractor.main_blocks(h) != [t.strip() for t, y in gold if y] for h, gold in pages)
    assert wrong <= 4


def test_viterbi_is_the_best_path(model):
    import itertools

    rng = np.random.default_rng(4)
    for _ in range(20):
        s, moves = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
        value = lambda y: sum(s[t, y[t]] for t in range(6)) + sum(moves[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
        best = max(itertools.product((0, 1), repeat=6), key=value)
        assert tuple(html_extract.viterbi([tuple(x) for x in s.tolist()], moves)) == best


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">News</a><li><a href="/b">About us</a></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p></div><main><article><h1>The&nbsp;Title &amp; more</h1><p>First   paragraph<br>goes <b>on</b> here.<p>Second one, with a <a href="/x">link</a>.
<div class="advert">Buy now!</div><p>Third &lt;one&gt;.</article><section id="comments"><h2>Comments</h2><p>I disagree with all of this.</p></section></main>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/r">Other story</a></li></ul></aside><form><p>Search here</p><button>Go</button></form><footer><p>&copy; 2024 Someone</p></footer></body></html>"""


def test_extract_page(spark, model):
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (1, "u", PAGE), (None, "u", "<p>a < b <!-- x")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [(r.page_id, r.text) for r in html_extract.extract(df, model).collect()]
    want = "The Title & more\nFirst paragraph goes on here.\nSecond one, with a link.\nThird <one>."
    assert sorted(got[:4], key=str) == sorted([(1, want), (2, ""), (3, ""), (1, want)], key=str) and got[4][0] is None
    assert html_extract.extract(df.where("false"), model).count() == 0


def test_blocks_of_broken_markup():
    assert [b.text for b in leaf_blocks("<p>a<p>b<li>c<li>d</ul><div>e<span>f</div>g<!-- never closed <p>h")] == ["a", "b", "c", "d", "ef", "g"]
    assert [b.text for b in leaf_blocks('<div title="a>b">x</div><script>if (a<b) {"</p>"}</script><p title=unclosed">y</p>')] == ["x", "y"]
    assert leaf_blocks("<script>never closed <p>x") == []


def test_article_of_every_page(spark):
    """The supplied pages keep their main text in one element; a plain reading of it gives the same text."""
    import html as h
    import re

    got = {r.page_id: r.text for r in queries.op10_html(spark, SMALL).collect()}
    for r in read_table(spark, SMALL, "pages").collect():
        inner = re.search(r"(?s)<article>(.*?)(</article>|$)", r.html)[1]
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_samples_take_one_text_of_an_id(spark):
    """A doc_id with many texts sends one of them to the driver, the same one however the rows lie."""
    docs = spark.createDataFrame([(1, f"text {i} " * 3) for i in range(200)] + [(2, "two"), (2, "two"), (3, None)], "doc_id long, text string")
    picked = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0)], "doc_id long, label int")
    got = [sorted(map(tuple, folds.texts(docs.repartition(n), picked).collect())) for n in (1, 7)]
    assert got[0] == got[1] and [r[:2] for r in got[0]] == [(1, 0), (1, 1), (2, 1), (3, 0)] and got[0][0][2] == got[0][1][2] and got[0][3][2] == ""


def test_foreign_and_fallback_content():
    for tag in ("<svg/>", '<svg class="i" />', "<math/>", '<svg href="?a=b"/>', "<svg hidden/>"):
        assert [b.text for b in leaf_blocks(f"<article>a{tag}b<p>c</p></article><p>d")] == ["ab", "c", "d"]
    assert [b.text for b in leaf_blocks("<article><svg width=5/><text>no</text></svg><p>c</p></article>")] == ["c"]
    assert [b.text for b in leaf_blocks("<article><p>let <math><mi>x</mi></math> be</p><object>o</object><video>v</video></article>")] == ["let x be", "ov"]


PART = st.one_of(
    st.lists(st.sampled_from(["<", "|", "turn|>", "|end|>\n<", "<|", "says|>", "[", "INST]", "/INST]", "I", "NST]", "</", "/s>", "s>", "s", ">", "\\", "evil", "<|image:0|>"]), max_size=5).map(lambda x: {"type": "text", "text": "".join(x)}),
    st.text(max_size=8).map(lambda x: {"type": "text", "text": x}),
    st.just({"type": "image", "uri": "a.png", "width": 28, "height": 28}),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a<", "[IN", ""]), st.lists(PART, max_size=6)), max_size=4))
def test_parts_cannot_forge_turns(turns):
    """Lists of parts are read back as they were, whatever they spell when they are joined."""
    out, want = "", []
    for role, parts in turns:
        seen, content, images = chat.Flattener(), [], 0
        for p in parts:
            seen.visit(p)
            if p["type"] == "image":
                content.append(("image", images))
                images += 1
            elif p["text"]:
                if content and content[-1][0] == "text":
                    content[-1] = ("text", content[-1][1] + p["text"])
                else:
                    content.append(("text", p["text"]))
        body = "".join(seen.out)
        assert not any(c in chat.PLACEHOLDER.sub("", body) for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))
        out += chat.OPEN + chat.escape(role) + chat.SAYS + body + chat.CLOSE
        want.append((role, content))
    assert chat.parse_parts(out) == want


@pytest.mark.parametrize("page", ["<a " * 350_000, "<div>x" * 170_000, "</div>" * 170_000, "<p>" + "<span>" * 80_000 + "<div>" * 80_000, "> <a" + "a" * 1_000_000, "<!--" * 250_000, "<a \"'>" * 160_000, "<ul><li>" * 60_000 + "<li>" * 100_000, "<b>x</i>" * 120_000])
def test_odd_pages_take_linear_time_and_memory(page):
    import time
    import tracemalloc

    began = time.perf_counter()
    leaf_blocks(page)
    assert time.perf_counter() - began < 6  # a fraction of a second to one alone; the machine may be shared
    tracemalloc.start()
    leaf_blocks(page[: len(page) // 4])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6


def test_unmarked_layout(model):
    extractor = html_extract.Extractor(model)
    assert extractor.main_blocks("<body><div><p>prose</p><p>prose</p></div></body>") == ["prose", "prose"]
    assert extractor.main_blocks('<body><nav><a href="/">Home</a></nav><div><p>It rained all day, and nobody left the house.</p><p>Then it stopped.</p></div><div class="footer">Copyright 2024</div></body>') == ["It rained all day, and nobody left the house.", "Then it stopped."]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, name):
    from oracle import connect, rows

    ours, theirs = queries.queries()[name](spark, SMALL).toPandas(), connect().execute(queries.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows(ours) == rows(theirs)


def captured(monkeypatch, module):
    """The models that a query fits."""
    seen, train = [], module.train
    monkeypatch.setattr(module, "train", lambda *a, **k: seen.append(train(*a, **k)) or seen[-1])
    return seen


def test_toxicity_query_by_brute_force(spark, monkeypatch):
    """Plain noisy-or of every whole text of the small table, from the weights that the query learnt."""
    seen = captured(monkeypatch, toxicity)
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in queries.op5_toxicity(spark, SMALL).collect()}
    (model,) = seen
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs) and model.constant is None and model.weights
    for d, text in docs:
        held, score, predicted = got[d]
        assert held == (zlib.crc32(str(d).encode()) % 5 == 0) and score == pytest.approx(plain.noisy_or(model, text), abs=1e-9) and predicted == (score >= 0.5)


def test_toxicity_in_tasks_equals_memory(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels").select("doc_id", F.col("toxic").alias("label"))
    label = {r.doc_id: r.label for r in labels.collect()}
    rows = [(r.text or "", label[r.doc_id]) for r in docs.orderBy("doc_id").collect() if r.doc_id in label]
    there, here = toxicity.train(docs, labels), toxicity.fit(rows, np.mean([y for _, y in rows]))
    assert there.weights.keys() == here.weights.keys() and all(there.weights[f] == pytest.approx(here.weights[f], abs=1e-6) for f in there.weights)
    longer = docs.withColumn("text", F.when(F.col("doc_id") == 3, F.repeat(F.lit("word "), 100_000)).otherwise(F.col("text")))
    assert toxicity.score(longer, toxicity.train(longer, labels)).count() == docs.count()


def plain_risk(w, p, u, prior):
    """Non-negative unbiased risk of the squared loss and the ridge, text by text."""
    z = lambda rows: [w[-1] + sum(w[i] for i in r) for r in rows]
    mean = lambda x: sum(x) / len(x)
    plus, minus, all_ = mean([(1 - x) ** 2 / 4 for x in z(p)]), mean([(1 + x) ** 2 / 4 for x in z(p)]), mean([(1 + x) ** 2 / 4 for x in z(u)])
    return prior * plus + max(0.0, all_ - prior * minus) + quality.L2 / 2 * sum(x * x for x in w[:-1])


def test_quality_query_by_brute_force(spark, monkeypatch):
    """Bins, scores and the least risk over every text of the small table, text by text; labels of bad texts make no difference."""
    seen = captured(monkeypatch, quality)
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in queries.op6_quality(spark, SMALL).collect()}
    (model,) = seen
    docs = {r.doc_id: np.array(quality.describe(r.text or ""), np.float32).tolist() for r in read_table(spark, SMALL, "documents").collect()}
    good = {r.doc_id for r in read_table(spark, SMALL, "labels").where("quality = 1").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    bins = {}
    for d, x in docs.items():
        bins[d] = plain.bins_of(model, x)
        assert got[d] == (zlib.crc32(str(d).encode()) % 4 == 2, pytest.approx(plain.quality(model, x), abs=1e-9), int(got[d][1] >= 0.7))
    for i in range(len(quality.NAMES)):  # quantiles of all texts, to three digits
        x = sorted(v[i] for v in docs.values())
        for k, e in enumerate(model.edges[i].tolist(), 1):
            rank = -(-k * len(x) // quality.BINS) - 1
            assert e <= x[rank] * 1.0001 + 1e-12 and x[rank] <= e * 1.01 + 1e-12
    w, p, u = [*model.weights, model.bias], [bins[d] for d in docs if d in good], list(bins.values())
    least, rng = plain_risk(w, p, u, model.prior), np.random.default_rng(3)
    for step in (1e-1, 1e-2, 1e-3):
        assert all(plain_risk(list(w + step * rng.standard_normal(len(w)) * 0.1), p, u, model.prior) >= least - 1e-9 for _ in range(5))
    labels = read_table(spark, SMALL, "labels").select("doc_id", F.col("quality").alias("label")).where(folds.fold(4) != 2)
    alone = quality.train(read_table(spark, SMALL, "documents"), labels.where("label = 1"))
    assert alone.prior == model.prior and np.array_equal(alone.weights, model.weights)


def test_quality_prior_of_a_mixture(spark):
    """Estimated from positives and unlabelled texts alone."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9)))
    fine = lambda: " ".join(word() for _ in range(rng.integers(20, 60))).capitalize() + "."
    junk = lambda: " ".join(word().upper() + "!!" for _ in range(rng.integers(3, 30)))
    rows = [(i, fine() if i % 10 < 7 else junk()) for i in range(1500)]
    model = quality.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, 1) for i in range(0, 1500, 10)], "doc_id long, label int"))
    assert model.prior == pytest.approx(0.7, abs=0.1)
