"""Web pages to statements (S-06) and the link frontier (S-07)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import make_id, normalize_ws, strip
from ledgerloom.plans.model import prop_list, prop_struct, to_statements
from ledgerloom.plans.shared import staged

# Where the directory's pages keep their facts (tag, class).
FIELDS = {"title": ("h1", "c-single-header__title"), "subtitle": ("div", "c-single-header__subtitle"), "description": ("div", "c-single--directory__description")}
LIST, ITEM = ("dl", "c-single--directory__section-data-dl"), ("div", "c-single--directory__section-data-item")
ITEM_TITLE, ITEM_DATA, ITEM_MORE = "c-single--directory__section-sub-title", "c-single--directory__section-data", "c-single--directory__section-sub-data"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
PAGE = "title string, subtitle string, description string, facts array<struct<label:string,text:string,link:string>>, items array<struct<title:string,data:string,more:string>>"


class _Directory(HTMLParser):
    """Facts of one directory page; elements nest, so each open one collects the text below it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str | None, list[str]]] = []
        self.out: dict = {"title": None, "subtitle": None, "description": None, "facts": [], "items": []}
        self.link: str | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            for _, _, text in self.open:
                text.append("\n")
            return
        given = dict(attrs)
        classes = (given.get("class") or "").split()
        inside = {k for _, k, _ in self.open}
        kind = next((k for k, (t, c) in FIELDS.items() if t == tag and c in classes and self.out[k] is None), None)
        if tag == LIST[0] and LIST[1] in classes:
            kind = "list"
        elif "list" in inside and tag in ("dt", "dd"):
            kind = tag
            self.link = None
        elif tag == ITEM[0] and ITEM[1] in classes:
            kind = "item"
            self.out["items"].append({"title": None, "data": None, "more": None})
        elif "item" in inside:
            kind = next((k for k, c in (("title_", ITEM_TITLE), ("data", ITEM_DATA), ("more", ITEM_MORE)) if c in classes), kind)
        if tag == "a" and "dd" in inside and self.link is None:
            self.link = given.get("href")
        self.open.append((tag, kind, []))

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _, _ in self.open):
            return
        while self.open:
            t, kind, text = self.open.pop()
            self.close_element(kind, "".join(text))
            if t == tag:
                return

    def close_element(self, kind: str | None, text: str) -> None:
        flat = " ".join(text.split()) or None
        if kind in FIELDS:
            self.out[kind] = flat
        elif kind == "dt":
            self.out["facts"].append({"label": flat, "text": None, "link": None})
        elif kind == "dd" and self.out["facts"] and self.out["facts"][-1]["text"] is None:
            self.out["facts"][-1] |= {"text": flat, "link": self.link}
        elif kind in ("title_", "data", "more") and self.out["items"]:
            item = self.out["items"][-1]
            key = kind.rstrip("_")
            item[key] = item[key] or text.strip() or None

    def handle_data(self, data: str) -> None:
        for _, _, text in self.open:
            text.append(data)

    def done(self) -> dict:
        while self.open:
            _, kind, text = self.open.pop()
            self.close_element(kind, "".join(text))
        return self.out


def directory_fields(pages: DataFrame) -> DataFrame:
    """url and the facts of each directory page; the rest is done natively."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for url, html in zip(frame["url"], frame["html"]):
                parser = _Directory()
                parser.feed(html or "")
                rows.append({"url": url, **parser.done()})
            yield pd.DataFrame(rows, columns=["url", "title", "subtitle", "description", "facts", "items"], dtype=object)

    return pages.select("url", "html").mapInPandas(run, f"url string, {PAGE}")


def pages_to_statements(pages: DataFrame, dataset: str, prefix: str) -> DataFrame:
    """S-06: organisations with their contact facts, founders (Directorship) and leaders (Employment)."""
    p = staged(directory_fields(pages).where("title is not null"), "directory").withColumn("org", make_id(prefix, F.lit("thinktank"), "title"))  # parsed once, read three times
    fact = lambda label, take: F.transform(F.filter("facts", lambda f: F.contains(f["label"], F.lit(label)) & f["text"].isNotNull()), take)
    item = lambda label: F.filter("items", lambda i: F.contains(i["title"], F.lit(label)))
    year = F.transform(item("Year founded"), lambda i: F.nullif(F.regexp_extract(i["data"], r"(\d{4})", 1), F.lit("")))
    org = p.select(
        F.col("org").alias("entity_id"), F.lit("Organization").alias("schema"), F.lit(dataset).alias("dataset"),
        F.concat(
            F.array(prop_struct("name", F.col("title")), prop_struct("weakAlias", F.col("subtitle")), prop_struct("summary", F.col("description")), prop_struct("topics", F.lit("pol.thinktank")), prop_struct("sourceUrl", F.col("url"))),
            prop_list("website", fact("Website", lambda f: F.coalesce(f["link"], f["text"]))), prop_list("address", fact("Address", lambda f: f["text"])), prop_list("country", fact("Country", lambda f: f["text"])), prop_list("incorporationDate", year),
        ).alias("props"),
    )
    founders = p.select("org", F.explode(item("Founded by")).alias("i")).select("org", F.explode(F.split(F.regexp_extract("i.more", r"(?s)Founders:(.*?)(?:Founder gender:|$)", 1), ",")).alias("name"))
    leaders = p.select("org", F.explode(item("Leadership")).alias("i")).select("org", F.explode(F.regexp_extract_all("i.more", F.lit(r"(Leader\(s\)\s*\(\d{4}\):[^\n]*)"), 1)).alias("line"))
    leaders = leaders.select("org", F.regexp_extract("line", r"\((\d{4})\)", 1).alias("year"), F.regexp_replace(F.regexp_extract("line", r"\):(.*)$", 1), "Leader gender:.*$", "").alias("name"))
    real = lambda df: df.withColumn("name", normalize_ws("name")).where("name <> '' and lower(name) <> 'n/a'").withColumn("person", make_id(prefix, F.lit("person"), "name"))
    founders, leaders = real(founders), real(leaders)
    people = founders.select("person", "name").unionByName(leaders.select("person", "name")).select(F.col("person").alias("entity_id"), F.lit("Person").alias("schema"), F.lit(dataset).alias("dataset"), F.array(prop_struct("name", F.col("name"))).alias("props"))
    directors = founders.select(
        make_id(prefix, F.lit("founder"), "org", "person").alias("entity_id"), F.lit("Directorship").alias("schema"), F.lit(dataset).alias("dataset"),
        F.array(prop_struct("organization", F.col("org")), prop_struct("director", F.col("person")), prop_struct("role", F.lit("Founder"))).alias("props"),
    )
    jobs = leaders.select(
        make_id(prefix, F.lit("employment"), "org", "person", "year").alias("entity_id"), F.lit("Employment").alias("schema"), F.lit(dataset).alias("dataset"),
        F.array(prop_struct("employer", F.col("org")), prop_struct("employee", F.col("person")), prop_struct("role", F.lit("Leader")), prop_struct("date", F.col("year"))).alias("props"),
    )
    return to_statements(org.unionByName(people).unionByName(directors).unionByName(jobs))


_ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))[^>]*>(.*?)</a>"""


def extract_links(pages: DataFrame, text: str | None = None, within: str | None = None) -> DataFrame:
    """S-07: distinct absolute link targets of all pages; text: only links with this text; within: only inside blocks of this tag.

    Links are found and made distinct natively; only relative ones go to Python, to be joined to their page's address.
    """
    html = F.coalesce("html", F.lit(""))
    parts = F.regexp_extract_all(html, F.lit(rf"(?is)<{within}\b[^>]*>(.*?)</{within}>"), 1) if within else F.array(html)
    found = pages.select("url", F.explode(parts).alias("part")).select("url", F.explode(F.regexp_extract_all("part", F.lit(_ANCHOR), 0)).alias("a"))
    if text is not None:
        found = found.where(normalize_ws(F.regexp_replace(F.regexp_extract("a", _ANCHOR, 4), "<[^>]*>", " ")) == text)
    group = lambda k: F.nullif(F.regexp_extract("a", _ANCHOR, k), F.lit(""))
    found = found.select(F.coalesce("url", F.lit("")).alias("url"), strip(F.coalesce(group(1), group(2), group(3), F.lit(""))).alias("href")).distinct()
    whole = F.col("href").rlike(r"^https?://[^/?#.\s]+[^?#\s]*$") & ~F.contains("href", F.lit("/."))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"link": [urljoin(url, href) for url, href in zip(frame["url"], frame["href"])]}, dtype=object)

    return found.where(whole).select(F.col("href").alias("link")).unionByName(found.where(~whole).mapInPandas(run, "link string")).distinct()
