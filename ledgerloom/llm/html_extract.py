"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is a sequence of leaf blocks; each has features of its ancestors (tags, and
groups of words in class, id and role), of its text (length, links, marks, typical
phrases), and of whether anything on the page marks its main text at all.  The field scores labels (main text or not) by block and by neighbouring pair; it
is fitted on labelled pages by gradient ascent on the conditional likelihood and
decoded by Viterbi.

Labelled pages come from ``labelled_pages``: a seeded generator of layouts (semantic
and plain ones, with every kind of surroundings, nested and unclosed tags), bounded by
its ``pages`` parameter.  Other labelled pages can be given to ``train`` instead.

Defined cases: null or empty html gives an empty text; a page without blocks of main text
too; very long pages, deep nesting and unclosed tags take time and memory linear in the page;
repeated rows are extracted each; a null page_id passes through; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.html_blocks import GROUPS, Block, Place, leaf_blocks

PHRASES = re.compile(r"cookie|copyright|©|all rights reserved|subscribe|sign up|log ?in|advert|sponsored|share this|read more|click here|newsletter|privacy|terms of|comments?\b|reply|related|follow us|menu|home\b|search", re.I)


def is_marked(blocks: list[Block]) -> bool:
    """Whether an element or a name of the page says where its main text is."""
    return any(b.place.near == "main" or not b.place.inside.isdisjoint(("article", "main")) for b in blocks)


def place_features(p: Place, marked: bool) -> list[str]:
    """Of a block's surroundings, on a page that marks its main text or doesn't."""
    out = ["bias", f"tag:{p.tag}"]
    out += [f"in:{t}" for t in p.inside]
    inside = "outside" if p.inside.isdisjoint(("article", "main")) else "inside"
    if inside == "outside":
        out += ["outside", f"outside, {'marked' if marked else 'unmarked'} page"]
    out += [f"group:{g}" for g in p.groups]
    kind = p.near if p.near in ("", "main", "head") else "other"
    out += [f"near kind:{kind}", f"near kind:{kind} {inside}", f"near:{p.near}", f"near:{p.near} {inside}", f"tag:{p.tag} {inside}"]
    if inside == "outside":
        out += [f"near kind:{kind}, {'marked' if marked else 'unmarked'} page", f"tag:{p.tag}, {'marked' if marked else 'unmarked'} page"]
    if p.header and "article" in p.inside:
        out.append(f"header of {p.header}")
    return out


def text_features(b: Block, at: int, n: int) -> list[str]:
    """Of the block's text and its place among the page's n blocks."""
    out, size = [], len(b.text)
    out.append(f"size:{min(6, size.bit_length() // 2)}")
    share = b.linked / max(1, size)
    out.append("links:" + ("none" if not b.linked else "some" if share < 0.5 else "most"))
    if b.text[-1] in ".!?…。":
        out.append("stop")
    if size < 200 and PHRASES.search(b.text):
        out.append("phrase")
    if re.match(r"\s*(©|\(c\))", b.text):
        out.append("rights")
    out.append("first" if at == 0 else "last" if at == n - 1 else "middle")
    return out


class Model(NamedTuple):
    index: dict[str, int]
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # 2 x 2


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 100, rate: float = 0.2, l2: float = 5e-4) -> Model:
    """pages: features of each block, and the labels."""
    names = sorted({f for p, _ in pages for b in p for f in b})
    index = {f: i for i, f in enumerate(names)}
    flat = [(index[f], i, t) for i, (p, _) in enumerate(pages) for t, b in enumerate(p) for f in b]
    feat, page, spot = (np.array(x) for x in zip(*flat))
    lens = np.array([len(p) for p, _ in pages])
    top, n = lens.max(), len(pages)
    live = np.arange(top) < lens[:, None]
    gold = np.zeros((n, top, 2))
    for i, (_, y) in enumerate(pages):
        gold[i, np.arange(len(y)), y] = 1
    gold_moves = np.einsum("itk,itl->kl", gold[:, :-1], gold[:, 1:])
    w, moves = np.zeros((len(names), 2)), np.zeros((2, 2))
    m, v = [np.zeros_like(w), np.zeros_like(moves)], [np.zeros_like(w), np.zeros_like(moves)]
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for r in range(1, rounds + 1):
        s = np.zeros((n * top, 2))
        for k in range(2):
            s[:, k] = np.bincount(page * top + spot, w[feat, k], n * top)
        s = s.reshape(n, top, 2)
        fore, back = np.zeros_like(s), np.zeros_like(s)
        fore[:, 0] = s[:, 0]
        for t in range(1, top):
            fore[:, t] = np.where(live[:, t, None], s[:, t] + lse(fore[:, t - 1, :, None] + moves, 1), fore[:, t - 1])
        for t in range(top - 2, -1, -1):
            back[:, t] = np.where(live[:, t + 1, None], lse(moves + (s[:, t + 1] + back[:, t + 1])[:, None, :], 2), 0)
        total = lse(fore[:, -1], 1)
        p = np.where(live[..., None], np.exp(fore + back - total[:, None, None]), 0)
        pair = np.exp(fore[:, :-1, :, None] + moves + (s[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]) * live[:, 1:, None, None]
        short = (p - gold).reshape(-1, 2)
        g = [np.stack([np.bincount(feat, short[page * top + spot, k], len(names)) for k in range(2)], 1) / n + l2 * w, (pair.sum((0, 1)) - gold_moves) / n + l2 * moves]
        for i, x in enumerate((w, moves)):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
            x -= rate * (m[i] / (1 - 0.9**r)) / (np.sqrt(v[i] / (1 - 0.999**r)) + 1e-8)
    return Model(index, w, moves)


def viterbi(scores: list[tuple[float, float]], moves: np.ndarray) -> list[int]:
    """Best labels of one page, from the two scores of each block."""
    (m00, m01), (m10, m11) = moves.tolist()
    a, b = scores[0]
    back: list[tuple[int, int]] = []
    for s0, s1 in scores[1:]:
        back.append((int(b + m10 > a + m00), int(b + m11 > a + m01)))
        a, b = max(a + m00, b + m10) + s0, max(a + m01, b + m11) + s1
    out = [int(b > a)]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


class Extractor:
    def __init__(self, model: Model):
        self.moves = model.moves
        self.scores = {f: tuple(model.weights[i].tolist()) for f, i in model.index.items()}
        self.places: dict[tuple, tuple[float, float]] = {}  # of ancestors; emptied at its bound

    def total(self, features: list[str]) -> tuple[float, float]:
        own = [s for f in features if (s := self.scores.get(f))]
        return sum(s[0] for s in own), sum(s[1] for s in own)

    def main_blocks(self, html: str) -> list[str]:
        blocks = leaf_blocks(html)
        if not blocks:
            return []
        n, scores, marked = len(blocks), [], is_marked(blocks)
        for t, b in enumerate(blocks):
            place = self.places.get((b.place, marked))
            if place is None:
                if len(self.places) > 50_000:
                    self.places.clear()
                place = self.places[b.place, marked] = self.total(place_features(b.place, marked))
            text = self.total(text_features(b, t, n))
            scores.append((place[0] + text[0], place[1] + text[1]))
        return [b.text for b, y in zip(blocks, viterbi(scores, self.moves)) if y]


def labelled_pages(pages: int = 400, seed: int = 11) -> list[tuple[str, list[tuple[str, int]]]]:
    """Generated pages, and (text, label) of each of their leaf blocks in order."""
    rng = np.random.default_rng(seed)
    syllables = "ba de ki lo mu na pe ri so tu va we ze in er an qu sch tion ment".split()
    pick = lambda *x: x[rng.integers(len(x))]
    chance = lambda p: rng.random() < p

    def words(n: int) -> str:
        kind = rng.random()
        out = ["".join(pick(*syllables) for _ in range(rng.integers(1, 5))) for _ in range(n)]
        if kind < 0.08:
            out = [w.upper() + "!!" for w in out]
        elif kind < 0.16:
            out = [w + pick("***", "%%%", "###", "|") for w in out]
        return " ".join(out).capitalize() if kind > 0.08 else " ".join(out)

    def make() -> tuple[str, list[tuple[str, int]]]:
        html: list[str] = []
        gold: list[tuple[str, int]] = []

        def block(tag: str, text: str, y: int, attrs: str = "", close: bool = True, inner: str | None = None) -> None:
            html.append(f"<{tag}{attrs}>{inner if inner is not None else text}" + (f"</{tag}>" if close else ""))
            gold.append((text, y))

        def line(y: int, most: int = 8) -> str:
            return words(int(rng.integers(1, most)))

        def listing(y: int, linked: bool) -> None:
            html.append("<ul>")
            for _ in range(rng.integers(2, 8)):
                t = line(y, 5)
                block("li", t, y, inner=f'<a href="/x">{t}</a>' if linked else t, close=chance(0.9))
            html.append("</ul>")

        def prose(y: int, n: int) -> None:
            for _ in range(n):
                t = words(int(rng.integers(1, 90) if chance(0.8) else rng.integers(1, 4))) + pick(".", ".", ".", "!", "?", "")
                bold = chance(0.1)
                tag = pick("p", "p", "p", "p", "div")
                block(tag, t, y, close=tag == "div" or chance(0.9), inner=f"<b>{t}" + ("</b>" if chance(0.5) else "<br>") if bold else t)

        def box(kind: str) -> None:
            group = pick(*GROUPS[kind].split())
            tag = {"menu": pick("nav", "div", "ul"), "head": pick("header", "div"), "foot": pick("footer", "div"), "side": pick("aside", "div", "section"), "form": pick("form", "form", "div"), "comment": pick("section", "div", "div", "ol")}.get(kind, pick("div", "section", "aside"))
            named = tag in ("div", "section", "ul", "ol") or chance(0.4)
            attrs = f' {pick("class", "class", "id")}="{group}{pick("", "-box", " block", "-wrap")}"' if named else ""
            html.append(f"<{tag}{attrs}>")
            if kind in ("menu", "social"):
                listing(0, True)
            elif kind == "comment":
                block(pick("h2", "h3"), line(0, 3), 0)
                for _ in range(rng.integers(1, 5)):
                    html.append(pick('<div class="comment">', "<li>", "<div>", "<article>", '<article class="comment">'))
                    opened = html[-1][1:].split(" ")[0].rstrip(">")
                    if chance(0.5):
                        block(pick("p", "div"), line(0, 4), 0)
                    prose(0, int(rng.integers(1, 3)))
                    html.append(f"</{opened}>")
            elif kind == "form":
                block("p", line(0, 10), 0)
                t = line(0, 3)
                block("button", t, 0)
            elif kind == "foot":
                t = pick("© ", "Copyright ", "") + line(0, 12)
                block(pick("p", "p", "div"), t, 0)
                if chance(0.4):
                    listing(0, True)
            elif kind == "side":
                block(pick("h2", "h3", "h4"), line(0, 4), 0)
                listing(0, chance(0.8)) if chance(0.6) else prose(0, int(rng.integers(1, 3)))
            elif kind == "head":
                block(pick("h1", "div", "p"), line(0, 6), 0)
                if chance(0.3):
                    listing(0, True)
            else:
                prose(0, int(rng.integers(1, 3)))
            html.append(f"</{tag}>")

        html.append('<!DOCTYPE html><html><head><meta charset="utf-8"><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>')
        for kind in ("notice", "head", "menu", "advert", "side", "form"):
            if chance(0.4 if kind != "menu" else 0.7):
                box(kind)
        opening = pick("<div>", "<div>", "", "<section>", "<div><div>", "<table><tr><td>") if chance(0.2) else pick("<article>", "<article>", "<main>", "<main><article>", '<div class="content">', '<div id="main">', '<div class="post entry">', '<div class="article-body">', '<section class="story">', '<div role="main">')
        html.append(opening)
        header = chance(0.25)
        html.append("<header>" if header else "")
        if chance(0.85):
            block(pick("h1", "h1", "h2"), line(1, 12), 1)
        if header:
            html.append("</header>")
        for _ in range(rng.integers(1, 5)):
            prose(1, int(rng.integers(1, 8)))
            extra = rng.random()
            if extra < 0.12:
                listing(1, chance(0.2))
            elif extra < 0.2:
                block("h2", line(1, 6), 1)
            elif extra < 0.26:
                html.append("<blockquote>")
                prose(1, 1)
                html.append("</blockquote>")
            elif extra < 0.32:
                html.append("<table><tr>")
                for _ in range(4):
                    block("td", line(1, 5), 1)
                html.append("</tr></table>")
            elif extra < 0.55:
                box(pick("advert", "social", "side", "notice", "form"))
        if chance(0.15):
            box("comment")
        html.append({"<main><article>": "</article></main>", "": "", "<div><div>": "</div></div>", "<table><tr><td>": "</td></tr></table>"}.get(opening, f"</{opening[1:].split(' ')[0].rstrip('>')}>"))
        for kind in ("comment", "side", "advert", "social", "form", "notice"):
            if chance(0.3):
                box(kind)
        if chance(0.8):
            box("foot")
        html.append("</body></html>" if chance(0.9) else "")
        return "".join(html), gold

    return [make() for _ in range(pages)]


def fitted(pages: list[tuple[str, list[tuple[str, int]]]] | None = None) -> Model:
    """The field, fitted on labelled pages; blocks are matched to the labels by their text, in order."""
    rows = []
    for html, gold in pages or labelled_pages():
        blocks, at, labels = leaf_blocks(html), 0, []
        for b in blocks:
            while at < len(gold) and gold[at][0].strip() != b.text:
                at += 1
            labels.append(gold[at][1] if at < len(gold) else 0)
            at += 1
        if blocks:
            marked = is_marked(blocks)
            rows.append(([place_features(b.place, marked) + text_features(b, t, len(blocks)) for t, b in enumerate(blocks)], labels))
    return train(rows)


@functools.cache
def default_model() -> Model:
    """The field fitted on the generated pages; it depends on no input, so a process fits it once."""
    return fitted()


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text: blocks of main text joined by a line feed."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(shared.value)
        for frame in frames:
            out = ["\n".join(extractor.main_blocks(h.as_py())) for h in frame.column(2)]
            yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")).mapInArrow(run, "page_id long, url string, text string")
