"""A stored search index: entities, search view, names and the postings of their trigrams, brought up to date from changes (A-01, A-02, L-01, L-02).

The store is a log of segments. A segment holds whole rows of the canonical ids it is about, and the ids themselves (``touched``), so of an id that
several segments have, the newest one's rows count, and an id that is gone has a segment without rows of it. Postings lie in folders by kind and hash of
the gram and are sorted by gram, so a search reads the folders of its own grams and, of those, the row groups that hold them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import search
from ledgerloom.operators.entities import assemble_entities
from ledgerloom.plans.model import NAME_PROPS, ONTOLOGY, Ontology
from ledgerloom.plans.shared import staged
from ledgerloom.sources import commits

#: Folders of postings of a kind.
PARTS = 32
#: What a store may hold: three tables, and postings of two kinds.
TABLES = ("entities", "view", "names", "word", "piece")
#: Rows of a table whose postings of a part are one task's: some hundred thousand postings.
DEAL_ROWS = 200_000
#: Segments beyond which they are written as one.
SEGMENTS = 8
NAMES = "canonical_id string, schema string, prop string, value string"
POSTINGS = "gram string, id string, n_shown int, shown boolean, kind string, part int"


def _part(gram: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(parts)).cast("int")


def _pieces(c: Column) -> Column:
    """Distinct runs of three characters of a text, whatever they are."""
    return F.array_distinct(F.when(F.length(c) >= 3, F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(c, i, F.lit(3)))).otherwise(F.array().cast("array<string>")))


def word_postings(view: DataFrame, parts: int = PARTS) -> DataFrame:
    """gram, id, n_shown (trigrams of the display name), shown (this is one of them), part: padded trigrams of the words of the view's names."""
    rows = view.select("id", search.word_trigrams(F.col("tokens")).alias("grams"), search.trigrams(F.coalesce("display_name", F.lit(""))).alias("s"))
    # What an entity has in common isn't copied to each of its grams.
    words = rows.select("id", F.size("s").alias("n_shown"), F.inline(F.transform("grams", lambda g: F.struct(g.alias("gram"), F.array_contains("s", g).alias("shown")))))
    return words.select("gram", "id", "n_shown", "shown", _part(F.col("gram"), parts).alias("part"))


def piece_postings(names: DataFrame, parts: int = PARTS) -> DataFrame:
    """The same columns: runs of three characters of each name in lower case. Names are gathered by id, so grams needn't be made distinct across rows."""
    values = names.groupBy(F.col("canonical_id").alias("id")).agg(F.collect_set(F.lower("value")).alias("values"))
    pieces = values.select("id", F.explode(F.array_distinct(F.flatten(F.transform("values", _pieces)))).alias("gram"))
    return pieces.select("gram", "id", F.lit(0).alias("n_shown"), F.lit(False).alias("shown"), _part(F.col("gram"), parts).alias("part"))


def _checked(tables: Sequence[str]) -> list[str]:
    for table, needs in (("word", "view"), ("piece", "names")):
        if table in tables and needs not in tables:
            raise ValueError(f"postings of kind {table} need the table {needs}")
    if unknown := set(tables) - set(TABLES):
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")
    return [t for t in TABLES if t in tables]


def _write(stmt: DataFrame, path: str, parts: int, tables: Sequence[str], ontology: Ontology) -> None:
    spark = stmt.sparkSession
    if "entities" in tables:
        assemble_entities(stmt.where("canonical_id is not null"), ontology=ontology).write.parquet(f"{path}/entities")
    if "view" in tables:
        search.search_view(stmt, ontology).write.parquet(f"{path}/view")
    if "names" in tables:
        names = stmt.where(F.col("prop").isin(*NAME_PROPS) & F.col("canonical_id").isNotNull()).select("canonical_id", "schema", "prop", "value").distinct()
        names.write.parquet(f"{path}/names")
    _write_postings(spark, path, parts, tables)


def _write_postings(spark: SparkSession, path: str, parts: int, tables: Sequence[str]) -> None:
    for kind, table, of in (("word", "view", word_postings), ("piece", "names", piece_postings)):
        if kind in tables:
            rows = spark.read.schema(NAMES).parquet(f"{path}/{table}") if table == "names" else spark.read.parquet(f"{path}/{table}")
            # The ids of a gram are dealt by their hashes, so a gram that a third of all names have is many tasks, and what one holds doesn't grow.
            deals = 1 + rows.count() // DEAL_ROWS
            deal = F.pmod(F.xxhash64("id"), F.lit(deals))
            of(rows, parts).repartition(parts * deals, "part", deal).sortWithinPartitions("part", "gram", "id").write.partitionBy("part").parquet(f"{path}/postings/kind={kind}")


def build(stmt: DataFrame, store: str, parts: int = PARTS, ontology: Ontology = ONTOLOGY, tables: Sequence[str] = ()) -> None:
    """The index of canonicalised statements as the store's only segment; readers see it whole or not at all. Statements without a canonical id are left out.

    tables: those of TABLES that the store is to hold (none: all), from now on also after changes. L-01 needs names and piece, L-02 view and word.
    """
    path, tables = f"{store}/segments/{uuid.uuid4().hex}", _checked(tables or TABLES)
    _write(stmt, path, parts, tables, ontology)
    commits.commit(stmt.sparkSession, store, lambda now: {"segments": [path], "parts": parts, "tables": tables})


def touched(changed: DataFrame, link: DataFrame, moved: DataFrame) -> DataFrame:
    """The canonical ids (id) to write anew after a change: those of the changed entities (entity_id) by the linker after it, and those
    that ids which moved (entity_id, before, after) have left and joined."""
    now = changed.select("entity_id").distinct().join(link, "entity_id", "left").select(F.coalesce("canonical_id", "entity_id").alias("id"))
    return now.unionByName(moved.select(F.explode(F.array_compact(F.array("entity_id", "before", "after"))).alias("id"))).where("id is not null").distinct()


def refresh(stmt: DataFrame, store: str, ids: DataFrame, ontology: Ontology = ONTOLOGY) -> None:
    """A segment for the canonical ids (id): only their statements, of stmt after the change, are shuffled and assembled.

    An error where another writer has changed the store meanwhile: which of the two is newer isn't known. Beyond SEGMENTS segments they become one.
    """
    spark = stmt.sparkSession
    base = commits.newest(spark, store)
    if base is None:
        raise ValueError(f"there is no index in {store}")
    path = f"{store}/segments/{uuid.uuid4().hex}"
    ids.select("id").distinct().write.parquet(f"{path}/touched")
    some = stmt.join(spark.read.parquet(f"{path}/touched").withColumnRenamed("id", "canonical_id"), "canonical_id", "left_semi")
    _write(staged(some.select(*stmt.columns), "touched"), path, base["parts"], base.get("tables", TABLES), ontology)
    _replace(spark, store, base, {**base, "segments": [*base["segments"], path]})
    if len(base["segments"]) >= SEGMENTS:
        compact(spark, store)


def compact(spark: SparkSession, store: str) -> None:
    """All segments as one, from the rows they hold: nothing is assembled again."""
    base = commits.newest(spark, store)
    path = f"{store}/segments/{uuid.uuid4().hex}"
    tables = base.get("tables", TABLES)
    for table in ("entities", "view", "names"):
        if table in tables:
            _live(spark, base, table).write.parquet(f"{path}/{table}")
    _write_postings(spark, path, base["parts"], tables)
    _replace(spark, store, base, {**base, "segments": [path]})


def _replace(spark: SparkSession, store: str, base: dict, entry: dict) -> None:
    def change(now: dict | None) -> dict:
        if now != base:
            raise RuntimeError(f"another writer has changed {store}")
        return entry

    commits.commit(spark, store, change)


def _live(spark: SparkSession, entry: dict, table: str, only: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The rows of a table that count, of those that only lets through: of each segment the ids that no later one is about."""
    key, out, segments = ("canonical_id" if table == "names" else "id"), [], entry["segments"]
    for i, path in enumerate(segments):
        read = spark.read.schema(POSTINGS) if table == "postings" else spark.read
        rows = only(read.parquet(f"{path}/{table}"))
        if later := segments[i + 1 :]:
            gone = reduce(DataFrame.unionByName, [spark.read.parquet(f"{p}/touched") for p in later]).distinct()
            rows = rows.join(gone.withColumnRenamed("id", key), key, "left_anti").select(*rows.columns)
        out.append(rows)
    return reduce(DataFrame.unionByName, out)


def read(spark: SparkSession, store: str, table: str) -> DataFrame:
    """entities (A-01), view (A-02), names or postings, as of the newest segment."""
    entry = commits.newest(spark, store)
    if entry is None:
        raise ValueError(f"there is no index in {store}")
    return _live(spark, entry, table)


def _hits(spark: SparkSession, entry: dict, kind: str, grams: Sequence[str]) -> DataFrame:
    """Postings of the grams; the folders are named by literals, so others aren't listed or read."""
    parts = sorted(set(spark.range(1).select(F.array(*[_part(F.lit(g), entry["parts"]) for g in grams])).first()[0]))
    return _live(spark, entry, "postings", lambda df: df.where((F.col("kind") == kind) & F.col("part").isin(*parts) & F.col("gram").isin(*grams)))


def _sure(folded: str, grams: Sequence[str]) -> list[str]:
    """Of the query's trigrams those that every text has which contains the query: those that its ends, where a text's word may go on, don't pad."""
    text = "".join(c if c.isascii() and c.isalnum() else " " for c in folded)
    runs = text.split(" ")
    out: set[str] = set()
    for i, w in enumerate(runs):
        if w:
            padded = ("  " if i else "") + w + (" " if i < len(runs) - 1 else "")
            out |= {padded[j : j + 3] for j in range(len(padded) - 2)}
    return sorted(out & set(grams))


def candidates(spark: SparkSession, entry: dict, query: str, sim: float, word_sim: float) -> DataFrame | None:
    """Ids (id) that L-02 may find, from postings alone; None where the query has no trigram that every text has which contains it.

    A row that is similar is known exactly (trigrams shared, and trigrams of both); a run of words can be no more similar than the names' share of the query's trigrams.
    """
    first = spark.range(1).select(search.trigrams(F.lit(query)).alias("g"), search.fold(F.lit(query.lower())).alias("f")).first()
    sure = _sure(first.f, first.g)
    if not sure:
        return None
    n = len(first.g)
    counts = _hits(spark, entry, "word", first.g).groupBy("id").agg(F.count("*").alias("found"), F.count_if("shown").alias("both"), F.first("n_shown").alias("n_shown"), F.count_if(F.col("gram").isin(*sure)).alias("sure"))
    like = F.col("both") / (F.col("n_shown") + n - F.col("both"))
    return counts.where((like > sim) | (F.col("found") > word_sim * n) | (F.col("found") == n) | (F.col("sure") == len(sure))).select("id")


def search_fuzzy(spark: SparkSession, store: str, query: str, schemas: Sequence[str] = (), limit: int = 20, offset: int = 0, sim: float = 0.25, word_sim: float = 0.55, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """L-02 on the index, same rows: only candidates are scored. A query without a whole trigram (one or two characters, or signs alone) reads the view."""
    entry = commits.newest(spark, store)
    view, found = _live(spark, entry, "view"), candidates(spark, entry, query, sim, word_sim)
    return search.search_fuzzy(view if found is None else view.join(found, "id", "left_semi"), query, schemas, limit, offset, sim, word_sim, ontology)


def search_substring(spark: SparkSession, store: str, query: str, schemas: Sequence[str] = (), limit: int = 20, offset: int = 0, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """L-01 on the index, same rows: only names of ids that have all of the query's runs of three characters are looked at; a shorter query reads the names."""
    entry = commits.newest(spark, store)
    names, low = _live(spark, entry, "names"), query.lower()
    if grams := sorted({low[i : i + 3] for i in range(len(low) - 2)}):
        found = _hits(spark, entry, "piece", grams).groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(grams))
        names = names.join(found.select(F.col("id").alias("canonical_id")), "canonical_id", "left_semi")
    return search.search_substring(names, query, schemas, limit, offset, ontology)
