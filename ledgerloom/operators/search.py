"""Search views and pages (A-02 to A-05, L-01 to L-03, P-26, U-03)."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.model import NAME_PROPS, ONTOLOGY, Ontology
from ledgerloom.plans.shared import staged

# Letters that aren't a plain one with a mark, and what they fold to.
LIGATURES = {"æ": "ae", "œ": "oe", "ß": "ss", "þ": "th", "ĳ": "ij"}
STROKES = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "ħ": "h", "ŧ": "t", "ı": "i", "ƀ": "b", "ɨ": "i", "ŀ": "l", "ŋ": "n", "ĸ": "q", "ſ": "s"}


@functools.cache
def plain_letters() -> dict[str, str]:
    """Small Latin letters with marks, by the rule that their decomposition begins with a plain letter, and those of STROKES."""
    found = {chr(c): unicodedata.normalize("NFKD", chr(c)) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))}
    return {c: d[0] for c, d in found.items() if c.islower() and d[0].isascii() and d[0].isalpha() and len(d) > 1 and all(map(unicodedata.combining, d[1:]))} | STROKES


def fold(c: Column) -> Column:
    """Lower case, Latin letters without their marks, and no marks of their own."""
    pairs = plain_letters()
    c = F.translate(F.lower(c), "".join(pairs), "".join(pairs.values()))
    for letter, plain in LIGATURES.items():
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return F.regexp_replace(c, r"\p{Mn}", "")


def words(c: Column) -> Column:
    return F.filter(F.split(fold(c), "[^a-z0-9]+"), lambda t: t != "")


def schema_filter(df: DataFrame, names: Sequence[str], ontology: Ontology = ONTOLOGY) -> DataFrame:
    """P-26"""
    return df.where(F.col("schema").isin(ontology.descendants(names)))


def page_bounds(limit: int, offset: int) -> tuple[int, int]:
    """Limits from 1 to 100, offsets from 0."""
    return min(100, max(1, limit)), max(0, offset)


def search_view(stmt: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """A-02: id, display_name, schema, names_text and tokens of actors with a canonical id."""
    rows = stmt.where(ontology.is_a(F.col("schema"), "LegalEntity") & F.col("canonical_id").isNotNull())
    named = F.col("prop").isin(*[p for p in NAME_PROPS if p != "title"])
    view = rows.groupBy("canonical_id").agg(F.min(F.when(F.col("prop") == "name", F.col("value"))).alias("display_name"), F.min("schema").alias("schema"), F.array_join(F.sort_array(F.collect_set(F.when(named, F.col("value")))), " ").alias("names_text"))
    return view.select(F.col("canonical_id").alias("id"), "display_name", "schema", "names_text", words(F.col("names_text")).alias("tokens"))


def substring_groups(stmt: DataFrame, query: str, schemas: Sequence[str] = (), ontology: Ontology = ONTOLOGY) -> DataFrame:
    """A-03: canonical ids with a search property that holds the query: id, schema, name and title over the matching rows, exact_score."""
    rows = stmt.where(F.col("prop").isin(*NAME_PROPS) & F.contains(F.lower("value"), F.lit(query.lower())))
    if schemas:
        rows = schema_filter(rows, schemas, ontology)
    of = lambda p: F.max(F.when(F.col("prop") == p, F.col("value")))
    return rows.groupBy(F.col("canonical_id").alias("id")).agg(F.min("schema").alias("schema"), of("name").alias("name"), of("title").alias("title"), F.max(F.when(F.lower("value") == query.lower(), 3).otherwise(0)).alias("exact_score"))


def _page(rows: DataFrame, order: list[Column], limit: int, offset: int) -> DataFrame:
    """The page with total and has_next. rows are staged, so that the page and the one counted row read them without working them out twice."""
    rows = staged(rows, "hits")
    total = rows.agg(F.count("*").alias("total")).withColumn("has_next", F.lit(limit + offset) < F.col("total"))
    return rows.orderBy(*order).offset(offset).limit(limit).join(F.broadcast(total), F.lit(True))


def search_substring(stmt: DataFrame, query: str, schemas: Sequence[str] = (), limit: int = 20, offset: int = 0, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """L-01"""
    rows = substring_groups(stmt, query, schemas, ontology).withColumn("label", F.coalesce("name", "title", "id"))
    return _page(rows, [F.col("exact_score").desc(), F.col("label"), F.col("id")], *page_bounds(limit, offset))


def word_trigrams(words: Column) -> Column:
    """Distinct 3-grams of each word with two spaces before and one after it."""
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, grams)))


def trigrams(c: Column) -> Column:
    return word_trigrams(words(c))


def _shared(a: Column, b: Column) -> Column:
    """The Jaccard similarity of arrays of distinct values; callers bind both, so nothing is worked out twice."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) > 0, both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def _let(c: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(c), body), 1)


def similarity(a: Column, b: Column) -> Column:
    return _let(trigrams(a), lambda x: _let(trigrams(b), lambda y: _shared(x, y)))


def word_similarity(query: str, tokens: Column) -> Column:
    """Greatest similarity of the query to a run of words of the text, as long as the query give or take one word."""
    n = max(1, len([w for w in query.split() if w]))

    def best(q: Column) -> Column:
        runs = []
        for k in sorted({max(1, n - 1), n, n + 1}):
            starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(tokens) - k + 1))
            runs.append(F.array_max(F.transform(starts, lambda i, k=k: _let(word_trigrams(F.slice(tokens, i, k)), lambda g: _shared(q, g)))))
        return F.greatest(*runs, F.lit(0.0))

    return _let(trigrams(F.lit(query)), best)


def search_fuzzy(view: DataFrame, query: str, schemas: Sequence[str] = (), limit: int = 20, offset: int = 0, sim: float = 0.25, word_sim: float = 0.55, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """L-02: rows of the search view that hold all query words, are similar, or contain the query; best first, scores left out.

    Before anything is scored, rows go that can't match: a similarity above a bound needs more than so large a share of the query's trigrams (those
    of a run of words are among those of all names, and a row with all query words has all of them).
    """
    q, low = F.lit(query), query.lower()
    rows = schema_filter(view, schemas, ontology) if schemas else view
    shares = lambda grams, least: _let(trigrams(q), lambda asked: F.size(F.array_intersect(grams, asked)) > least * F.size(asked))
    rows = rows.where(shares(word_trigrams(F.col("tokens")), word_sim) | shares(trigrams(F.coalesce("display_name", F.lit(""))), sim) | F.contains(F.lower("names_text"), F.lit(low)))
    asked = F.array_distinct(words(q))
    found = F.size(F.array_intersect(asked, F.col("tokens")))
    rows = rows.withColumn("__all", (F.size(asked) > 0) & (found == F.size(asked))).withColumn("__rank", F.when(F.size("tokens") > 0, found / F.size("tokens")).otherwise(0.0))
    rows = rows.withColumn("__sim", similarity(F.coalesce("display_name", F.lit("")), q)).withColumn("__word", word_similarity(query, F.col("tokens")))
    rows = rows.where(F.col("__all") | (F.col("__sim") > sim) | (F.col("__word") > word_sim) | F.contains(F.lower("names_text"), F.lit(low)))
    name = F.lower(F.coalesce("display_name", F.lit("")))
    rows = rows.withColumn("__exact", (name == low).cast("int")).withColumn("__prefix", name.startswith(low).cast("int"))
    order = [F.col("__exact").desc(), F.col("__prefix").desc(), F.col("__rank").desc(), F.greatest("__sim", "__word").desc(), F.length(name), F.col("id")]
    return _page(rows, order, *page_bounds(limit, offset)).drop("__all", "__rank", "__sim", "__word", "__exact", "__prefix")


def sitemap_page(view: DataFrame, schemas: Sequence[str] = (), limit: int = 100, offset: int = 0, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """L-03: ids in order and their paths; total and has_next as in other pages."""
    rows = schema_filter(view, schemas, ontology) if schemas else view
    return _page(rows.select("id", F.concat(F.lit("/profile/"), "id").alias("path")), [F.col("id")], max(1, limit), max(0, offset))


def actor_counts(view: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """A-04: entities of each requested schema, 0 where there are none."""
    asked = view.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(schemas)], "schema string")
    return asked.join(view.groupBy("schema").agg(F.count("*").alias("n")), "schema", "left").select("schema", F.coalesce("n", F.lit(0)).alias("n"))


def dataset_names(stmt: DataFrame) -> DataFrame:
    """A-05"""
    return stmt.where("dataset <> ''").select("dataset").distinct()


def known_datasets(dataset_dim: DataFrame, stmt: DataFrame | None) -> DataFrame:
    """U-03: configured and stored names, in order; without a store (None) the configured ones."""
    names = dataset_dim.select(F.col("name").alias("dataset"))
    return (names if stmt is None else names.unionByName(dataset_names(stmt))).distinct().orderBy("dataset")
