"""Leaf blocks of a page, with what surrounds them.

Time and memory are linear in the page: what is known of a block's surroundings is kept as a
small value (``Place``) for each open element, made from its parent's and shared by all blocks below
it; the open elements of each tag have a list of their places in the stack, so closing one
doesn't search the stack; and no tag is looked for behind the last ">".
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from html import unescape
from typing import NamedTuple

#: Tags that begin and end a block (fixed values of HTML).
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
UNSEEN = set("script style template noscript iframe svg textarea select datalist head title noframes map".split())
HEAD = set("title meta link script style base noscript template head".split())
#: An opening tag of the key closes an open tag of the values, up to the stops.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}}
STOPS = {"ul", "ol", "dl", "table", "menu", "select"}
NO_P = BLOCK - {"button", "option", "optgroup", "caption", "legend", "li", "dd", "dt", "tr", "td", "th", "tbody", "thead", "tfoot", "html", "body", "summary"} | {"li", "dd", "dt"}
#: Their content is text only, up to their closing tag.
RAW = set("script style textarea title noscript iframe noframes xmp".split())
#: Elements of other languages, which a slash at the end of the tag closes; as the end of a value without quotes it doesn't.
FOREIGN = {"svg", "math"}
_UNQUOTED_END = re.compile(r"""=\s*[^\s"']+/$""")
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: A comment, a declaration, or a tag with its attributes (quotes that don't close are taken as they are).
_MARKUP = re.compile(r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)(?:((?:[^>"']|"[^"]*"|'[^']*')*+)>|([^>]*)>)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Words of class, id and role by what they mark (fixed values).
GROUPS = {
    "menu": "nav navi navbar navigation menu menus breadcrumb breadcrumbs crumbs pagination pager tabs toc skip sitemap hamburger",
    "head": "header masthead topbar logo branding site hero",
    "foot": "footer foot copyright colophon legal bottom imprint",
    "side": "sidebar side aside rail widget widgets related recommended recommendations popular trending teaser teasers tags complementary readmore",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted adsense affiliate dfp outbrain taboola",
    "notice": "notice notices cookie cookies consent gdpr alert alerts popup modal overlay toast warning banner disclaimer paywall announcement message",
    "form": "form search login signin signup register newsletter subscribe subscription contact input",
    "comment": "comment comments commentlist reply replies disqus discussion respond feedback responses reviews guestbook",
    "social": "share sharing social follow like likes tweet facebook twitter print",
    "hidden": "hidden invisible sr screenreader visuallyhidden",
    "main": "article content post entry story body text main prose page articlebody maincontent blog",
}
_GROUP = {w: g for g, words in GROUPS.items() for w in words.split()}
#: Groups that tags stand for, and the tags that count as ancestors.
_TAG_GROUP = {"nav": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form", "article": "main", "main": "main", "menu": "menu", "dialog": "notice"}
MARKED = frozenset("nav header footer aside form article main section ul ol table figure blockquote button dialog menu address details search fieldset label".split())
_NAMING = ("class", "id", "role", "aria-label", "itemprop", "data-component")


class Place(NamedTuple):
    """What surrounds a block."""

    tag: str = ""  # of the innermost element
    inside: frozenset[str] = frozenset()  # ancestors among MARKED
    groups: frozenset[str] = frozenset()  # of all ancestors
    near: str = ""  # the group of the innermost ancestor that has one
    header: str = ""  # of a header element: "article" if it is inside an article, else "page"


class Block(NamedTuple):
    text: str
    place: Place
    linked: int  # characters inside links


def _named(attributes: str) -> frozenset[str]:
    """Groups of the attributes that name an element; hidden if it isn't shown."""
    found: set[str] = set()
    for k, *v in _ATTRIBUTE.findall(attributes):
        k, v = k.lower(), "".join(v)
        if k in _NAMING:
            found.update(_GROUP[w] for w in map(str.lower, _TOKEN.findall(v)) if w in _GROUP)
        elif k in ("hidden", "aria-hidden") and v != "false" or k == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v):
            found.add("hidden")
    return frozenset(found)


_NOTHING: frozenset[str] = frozenset()


def _below(place: Place, tag: str, own: frozenset[str]) -> Place:
    """The place inside an element of the tag, whose names have the groups own."""
    if tag in _TAG_GROUP:
        own |= {_TAG_GROUP[tag]}
    if len(own) > 1:
        own -= {"main"}
    inside, groups, near, header = place.inside, place.groups, place.near, place.header
    if tag in MARKED and tag not in inside:
        if tag == "header" and not header:
            header = "article" if "article" in inside else "page"
        inside |= {tag}
    if own and tag not in ("html", "body"):
        groups, near = (groups if own <= groups else groups | own), min(own)
    return Place(tag, inside, groups, near, header)


class Blocks:
    def __init__(self) -> None:
        self.stack: list[tuple[str, Place]] = []
        self.at: dict[str, list[int]] = {}  # of a tag, where it is in the stack
        self.block_at: list[int] = []  # where tags of BLOCK are
        self.places: dict[tuple, Place] = {}
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked = 0
        self.unseen = 0
        self.links = 0

    def feed(self, html: str) -> None:
        at, size, last = 0, len(html), html.rfind(">") + 1
        while at < last:
            m = _MARKUP.search(html, at, last)
            if not m:
                break
            if m.start() > at and not self.unseen:
                self.data(html[at : m.start()])
            at = m.end()
            tag = m[2]
            if tag is None:
                if html.startswith("<!--", m.start()) and not html.endswith(("-->", "--!>"), m.start() + 2, at):
                    at = size  # a comment that never ends
                continue
            tag = tag.lower()
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, m[3] or m[4] or "")
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else size
        if at < size and not self.unseen:
            cut = html.find("<!--", at)
            self.data(html[at : cut if cut >= 0 else size])
        self.flush()

    def data(self, data: str) -> None:
        if "&" in data:
            data = unescape(data)
        self.text.append(data)
        if self.links:
            self.linked += len(data)

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append(Block(text, self.stack[-1][1] if self.stack else Place(), self.linked))
            self.text, self.linked = [], 0

    def push(self, tag: str, own: frozenset[str]) -> None:
        parent = self.stack[-1][1] if self.stack else Place()
        key = (parent, tag, own)
        place = self.places.get(key)
        if place is None:
            place = self.places[key] = _below(parent, tag, own)
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.block_at.append(len(self.stack))
        self.stack.append((tag, place))
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def pop(self) -> None:
        tag, _ = self.stack.pop()
        self.at[tag].pop()
        if tag in BLOCK:
            self.block_at.pop()
        self.unseen -= tag in UNSEEN
        self.links -= tag == "a"

    def innermost(self, tags: Iterable[str]) -> int:
        """Place in the stack of the innermost open element of the tags; -1: none is open."""
        return max((found[-1] for t in tags if (found := self.at.get(t))), default=-1)

    def close_open(self, which: Iterable[str], stop: int = -1) -> None:
        """Closes the innermost element of the tags, with all inside it, unless it is outside the stack's place stop."""
        at = self.innermost(which)
        if at > stop:
            while len(self.stack) > at:
                self.pop()

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.flush()
            if self.unseen and tag not in HEAD and self.at.get("head"):
                self.close_open(("head",))
            if tag in NO_P and self.at.get("p"):
                self.close_open(("p",), self.innermost(("button", "table")))
            if tag in CLOSES:
                self.close_open(CLOSES[tag], self.innermost(STOPS))
        elif tag == "br":
            self.text.append(" ")
        elif tag == "a" and self.links:
            self.close_open(("a",), self.block_at[-1] if self.block_at else -1)
        if tag in VOID or tag in FOREIGN and attributes.endswith("/") and not _UNQUOTED_END.search(attributes):
            return
        self.push(tag, _named(attributes) if "=" in attributes or "hidden" in attributes else _NOTHING)

    def end(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in BLOCK:
            self.flush()
        if self.at.get(tag):
            inline = tag not in BLOCK and tag not in UNSEEN
            self.close_open((tag,), self.block_at[-1] if inline and self.block_at else -1)


def leaf_blocks(html: str) -> list[Block]:
    parser = Blocks()
    parser.feed(html)
    return parser.blocks
