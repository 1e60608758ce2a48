"""Composite names: selecting, splitting, validating, replacing, reviewing (N-, J-03 to J-06, J-09, W-02, W-05, U-02, P-28, A-08, A-10, A-11, L-05, L-07, X-01)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.dates import parse_date
from ledgerloom.functions.scalars import fingerprint, is_complex, normalize_ws, parse_amount, strip
from ledgerloom.plans.model import COLUMNS, FRAGMENTS, ONTOLOGY, Ontology, conform, statement_id, to_statements
from ledgerloom.plans.shared import staged

#: Exact schemata whose names may be composite.
NER_SCHEMATA = ("LegalEntity", "Organization", "Company", "Person")
KEY = ["dataset", "entity_id", "property_name", "fingerprint", "extractor", "extractor_version"]


def distinct_texts(stmt: DataFrame) -> DataFrame:
    """A-10"""
    return stmt.select("dataset", "entity_id", "schema", F.col("prop").alias("property_name"), strip("value").alias("source_text")).dropDuplicates(["dataset", "entity_id", "property_name", "source_text"])


def skip_extracted(inputs: DataFrame, stored: DataFrame, extractor: str, version: str) -> DataFrame:
    """J-09: inputs whose (dataset, entity, property, fingerprint) isn't stored for this extractor and version."""
    old = stored.where((F.col("extractor") == extractor) & (F.col("extractor_version") == version)).select(*KEY[:4])
    return inputs.join(old, KEY[:4], "left_anti")


def extraction_budget(inputs: DataFrame, limit: int | None) -> DataFrame:
    """L-07: at most limit new inputs over all datasets."""
    return inputs if limit is None else inputs.orderBy("dataset", "entity_id", "fingerprint").limit(limit)


def ner_inputs(stmt: DataFrame, existing: DataFrame | None = None, limit: int | None = None, extractor: str = "delimiter", version: str = "1", entity_ids: Sequence[str] | None = None) -> DataFrame:
    """N-01: composite names that aren't extracted yet: dataset, entity_id, schema, property_name, source_text, fingerprint."""
    rows = stmt.where(F.col("schema").isin(*NER_SCHEMATA) & (F.col("prop") == "name") & (strip("value") != "") & is_complex("value"))
    if entity_ids is not None:
        rows = rows.where(F.col("entity_id").isin(*entity_ids))
    inputs = distinct_texts(rows).withColumn("fingerprint", fingerprint("source_text"))
    return extraction_budget(skip_extracted(inputs, existing, extractor, version) if existing is not None else inputs, limit)


def split_names(c: Column) -> Column:
    """N-02: the names between ; and , of 3 characters or more, each once."""
    return F.array_distinct(F.filter(F.transform(F.split(c, "[;,]"), normalize_ws), lambda n: F.length(n) >= 3))


def split_entities(c: Column) -> Column:
    """N-02: a LegalEntity fragment for each name."""
    fragment = lambda n: F.struct(F.lit(None).cast("string").alias("key"), F.lit("LegalEntity").alias("schema"), F.create_map(F.lit("name"), F.array(n)).alias("properties"))
    return F.transform(split_names(c), fragment)


#: X-01: extractors by name.
EXTRACTORS: dict[str, Callable[[Column], Column]] = {"delimiter": split_entities}


def extract(inputs: DataFrame, extractor: str = "delimiter", version: str = "1") -> DataFrame:
    """inputs with extraction, extractor, extractor_version and failure (a reason where nothing came out)."""
    if extractor not in EXTRACTORS:
        raise ValueError(f"unknown extractor {extractor!r}; known: {', '.join(sorted(EXTRACTORS))}")
    out = inputs.withColumn("extraction", EXTRACTORS[extractor](F.col("source_text")).cast(FRAGMENTS))
    return out.withColumn("extractor", F.lit(extractor)).withColumn("extractor_version", F.lit(version)).withColumn("failure", F.when(F.coalesce(F.size("extraction"), F.lit(0)) == 0, "nothing extracted"))


def extraction_counters(inputs: DataFrame, stored: DataFrame, results: DataFrame) -> DataFrame:
    """A-08: processed, cached, skipped, upserted in one row."""
    cached = inputs.join(stored.select(*KEY[:4]).distinct(), KEY[:4], "left_semi").agg(F.count("*").alias("cached"))
    done = results.agg(F.count("*").alias("processed"), F.count_if(F.col("failure").isNotNull()).alias("skipped"), F.count_if(F.col("failure").isNull()).alias("upserted"))
    return done.join(cached, F.lit(True))


def clean_value(value: Column, kind: Column) -> Column:
    """A value by its property's type, or null."""
    t = normalize_ws(value)
    return (
        F.when(kind == "date", F.coalesce(F.when(t.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), t), parse_date(t)))
        .when(kind == "country", F.when(F.lower(t).rlike("^[a-z]{2}$"), F.lower(t)))
        .when(kind == "url", F.when(t.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/\s]+"), t))
        .when(kind == "number", F.when(parse_amount(t).isNotNull(), t))
        .otherwise(F.nullif(t, F.lit("")))
    )


def _values(fragments: DataFrame, keys: list[str], ontology: Ontology) -> DataFrame:
    """keys, pos, key, schema, prop, at, value, type, range of each value of exploded fragments; type null: unknown property."""
    spark = fragments.sparkSession
    rows = fragments.select(*keys, F.posexplode("extraction").alias("pos", "f")).select(*keys, "pos", "f.key", "f.schema", "f.properties")
    rows = rows.select(*keys, "pos", "key", "schema", F.explode_outer("properties").alias("prop", "values")).select(*keys, "pos", "key", "schema", "prop", F.posexplode_outer("values").alias("at", "value"))
    return rows.join(F.broadcast(ontology.prop_dim(spark)), ["schema", "prop"], "left")


def validate_fragments(cands: DataFrame, key: str = "id", ontology: Ontology = ONTOLOGY) -> DataFrame:
    """N-03: (key, reasons): the sorted reason codes of each candidate's extraction; an empty array: valid."""
    known = [s for s, _ in ontology.tree]
    v = _values(cands, [key], ontology)
    defs = cands.select(key, F.explode("extraction").alias("f")).where("f.key is not null").groupBy(key, F.col("f.key").alias("ref_key")).agg(F.min("f.schema").alias("ref_schema"))
    ref = F.col("value").startswith("$ref:")
    v = v.withColumn("ref_key", F.when(ref, F.substring("value", 6, 1 << 20))).join(defs, [key, "ref_key"], "left")
    fits = F.lit(False)
    for s in known:
        fits = fits | ((F.col("ref_schema") == s) & F.col("range").isin(ontology.ancestors(s)))
    code = (
        F.when(~F.col("schema").isin(*known) | F.col("schema").isNull(), "unknown schema")
        .when(F.col("prop").isNull(), "no properties")
        .when(F.col("type").isNull(), "unknown property")
        .when(F.col("value").isNull() | (strip("value") == ""), "empty value")
        .when(ref & (F.col("type") != "entity"), "reference in a plain property")
        .when(ref & F.col("ref_schema").isNull(), "unknown reference")
        .when(ref & F.col("range").isNotNull() & ~fits, "reference out of range")
        .when(~ref & clean_value(F.col("value"), F.col("type")).isNull(), "bad value")
    )
    found = v.withColumn("code", code).groupBy(key).agg(F.sort_array(F.collect_set("code")).alias("codes"))
    empty = F.coalesce(F.size("extraction"), F.lit(0)) <= 0
    return cands.select(key, empty.alias("empty")).join(found, key, "left").select(key, F.when(F.col("empty"), F.array(F.lit("no fragments"))).otherwise(F.coalesce("codes", F.array().cast("array<string>"))).alias("reasons"))


def latest_approved(cands: DataFrame) -> DataFrame:
    """W-02: the newest approved extraction that could be parsed, for each (property_name, fingerprint)."""
    w = Window.partitionBy("property_name", "fingerprint").orderBy(F.col("updated_at").desc_nulls_last(), F.col("id").desc())
    return cands.where("status = 'approved' and extraction is not null").withColumn("__n", F.row_number().over(w)).where("__n = 1").select("property_name", "fingerprint", "extraction")


def match_extractions(stmt: DataFrame, approved: DataFrame) -> DataFrame:
    """J-03: (entity_id, dataset, extraction): of names that match, the last by (value, statement id) decides.

    The trimmed value is hashed, as extraction does.
    """
    names = stmt.where("prop = 'name'").select("entity_id", "dataset", "id", "value", fingerprint(strip("value")).alias("fingerprint"), F.lit("name").alias("property_name"))
    hits = names.join(approved.where("size(extraction) > 0"), ["property_name", "fingerprint"])
    return hits.groupBy("entity_id").agg(F.max_by(F.struct("dataset", "extraction"), F.struct("value", "id")).alias("m")).select("entity_id", "m.dataset", "m.extraction")


def fragments(matches: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """N-04: (entity_id, dataset, pos, key, fragment_id, schema, properties) with bad parts left out; references unresolved.

    The id hashes the first name under the prefix of the source's id, so one name is one id whatever its schema.
    """
    known = [s for s, _ in ontology.tree]
    v = _values(matches, ["entity_id", "dataset"], ontology).where(F.col("schema").isin(*known))
    ref = F.col("value").startswith("$ref:")
    v = v.withColumn("value", F.when(ref & (F.col("type") == "entity"), F.col("value")).when(~ref & F.col("type").isNotNull(), clean_value(F.col("value"), F.col("type"))))
    props = v.where("value is not null").groupBy("entity_id", "pos", "prop").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda s: s["value"]).alias("values"))
    spots = v.groupBy("entity_id", "dataset", "pos", "schema").agg(F.first("key").alias("key"))
    maps = props.groupBy("entity_id", "pos").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("prop", "values")))).alias("properties"))
    out = spots.join(maps, ["entity_id", "pos"], "left").withColumn("properties", F.coalesce("properties", F.create_map().cast("map<string,array<string>>")))
    prefix = F.when(F.contains(F.col("entity_id"), F.lit("-")), F.regexp_extract("entity_id", "^(.*)-[^-]*$", 1)).otherwise("ner")
    name = F.col("properties")["name"][0]
    hashed = F.when(name.isNotNull(), F.sha1(name)).otherwise(F.sha1(F.concat_ws("|", "schema", F.to_json("properties"))))
    return out.withColumn("fragment_id", F.concat_ws("-", prefix, hashed))


def resolve_refs(frags: DataFrame) -> DataFrame:
    """J-06: references become ids of fragments of the same extraction; dangling ones and then empty fragments are dropped. Of equal keys the last decides."""
    named = frags.where("key is not null").groupBy("entity_id", "key").agg(F.max_by("fragment_id", "pos").alias("fragment_id"))
    ids = named.groupBy("entity_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "fragment_id"))).alias("ids"))
    rows = frags.join(ids, "entity_id", "left").withColumn("ids", F.coalesce("ids", F.create_map().cast("map<string,string>")))
    point = lambda v: F.when(v.startswith("$ref:"), F.col("ids")[F.substring(v, 6, 1 << 20)]).otherwise(v)
    resolved = F.transform_values("properties", lambda k, vs: F.filter(F.transform(vs, point), lambda v: v.isNotNull()))
    return rows.withColumn("properties", F.map_filter(resolved, lambda k, vs: F.size(vs) > 0)).where("size(properties) > 0").drop("ids")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """W-05: the first row of each key in an explicit order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


_BUCKETS = 1024


def _bucket(c: str) -> Column:
    """A number for what an id has before its first dash: a source's ids share it."""
    return F.pmod(F.xxhash64(F.substring_index(c, "-", 1)), F.lit(_BUCKETS))


def drop_replaced(stmt: DataFrame, replacements: DataFrame) -> DataFrame:
    """J-04

    Only statements of sources from which something was replaced are joined; those whose ids begin otherwise pass by.
    """
    gone = replacements.select("entity_id").distinct()
    held = [r.b for r in gone.select(_bucket("entity_id").alias("b")).distinct().collect()]  # _BUCKETS numbers at most
    apart = F.coalesce(~_bucket("entity_id").isin(*held), F.lit(True)) if held else F.lit(True)
    return stmt.where(apart).unionByName(stmt.where(~apart).join(gone, "entity_id", "left_anti").select(*stmt.columns))


def rewrite_references(stmt: DataFrame, replacements: DataFrame, ontology: Ontology = ONTOLOGY) -> tuple[DataFrame, DataFrame]:
    """J-05: the statements that don't point at a replaced entity, and a clone for each fragment whose schema fits the property's range.

    Only entity-typed rows are joined by value; all others pass by. stmt is read several times.
    """
    entity = F.coalesce(F.col("prop_type") == "entity", F.lit(False))
    dim = F.broadcast(ontology.schema_dim(stmt.sparkSession).select("schema", "ancestors"))
    # Of the replaced entities those that something points at, often few.
    pointed = stmt.where(entity).select(F.col("value").alias("entity_id")).distinct()
    targets = replacements.select("entity_id", "fragment_id", "schema").distinct().join(pointed, "entity_id", "left_semi").join(dim, "schema")
    targets = staged(targets.groupBy(F.col("entity_id").alias("__old")).agg(F.collect_list(F.struct("fragment_id", "ancestors")).alias("__targets")), "targets")
    ranges = F.broadcast(ontology.prop_dim(stmt.sparkSession).select("schema", "prop", "range"))
    fits = F.filter("__targets", lambda t: F.col("range").isNull() | F.array_contains(t["ancestors"], F.col("range")))
    kept = stmt.where(~entity).unionByName(stmt.where(entity).join(targets, F.col("value") == F.col("__old"), "left_anti"))
    pointing = stmt.where(entity).join(targets, F.col("value") == F.col("__old")).join(ranges, ["schema", "prop"], "left")
    # Clones can be equal where a row's fragments share an id, or where rows of one entity and property point at several replaced ones.
    place = F.xxhash64(F.concat_ws("|", "dataset", "entity_id", "prop"))
    several = staged(pointing.groupBy(place.alias("__place")).agg(F.count("*").alias("n")).where("n > 1").select("__place"), "several")
    clones = pointing.withColumn("__place", place).withColumn("value", F.explode(F.array_distinct(F.transform(fits, lambda t: t["fragment_id"]))))
    clones = clones.select(*stmt.columns, "__place").withColumn("id", statement_id())
    if several.isEmpty():
        return kept, clones.drop("__place")
    one = clones.join(several, "__place", "left_anti").drop("__place")
    return kept, one.unionByName(clones.join(several, "__place", "left_semi").drop("__place").dropDuplicates(["id"]))


def union_replaced(kept: DataFrame, rewritten: DataFrame, created: DataFrame) -> DataFrame:
    """U-02"""
    return kept.unionByName(rewritten, allowMissingColumns=True).unionByName(created, allowMissingColumns=True)


def fragment_statements(frags: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """Statements of the new entities; of fragments with one id the first by (source entity, position) is kept."""
    first = keep_first(frags, ["fragment_id"], [F.col("entity_id"), F.col("pos")])
    pairs = F.flatten(F.transform(F.map_entries("properties"), lambda e: F.transform(e["value"], lambda v: F.struct(e["key"].alias("prop"), v.alias("value")))))
    return to_statements(first.select(F.col("fragment_id").alias("entity_id"), "schema", "dataset", pairs.alias("props")), ontology, unique=True)  # a row each


def staged_statements(stmt: DataFrame) -> DataFrame:
    """stmt, staged without what follows from the rest of a row, as most ids, canonical ids and markers' values do; each is as long as what remains."""
    implied = {"value": F.col("entity_id"), "canonical_id": F.col("entity_id"), "id": statement_id()}  # an id follows from the value
    rows = conform(stmt)
    rows = staged(rows.withColumns({c: F.when(~F.col(c).eqNullSafe(x), F.struct(c)) for c, x in implied.items()}), "statements")
    for c, x in implied.items():
        rows = rows.withColumn(c, F.when(F.col(c).isNull(), x).otherwise(F.col(c)[c]))
    return rows


def apply_ner(stmt: DataFrame, cands: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """N-05: statements after approved extractions have replaced the entities they matched."""
    stmt = staged_statements(stmt)  # read several times
    frags = staged(resolve_refs(fragments(match_extractions(stmt, latest_approved(cands)), ontology)), "fragments")  # used three times
    kept, rewritten = rewrite_references(drop_replaced(stmt, frags), frags, ontology)
    return union_replaced(kept, rewritten, fragment_statements(frags, ontology)).select(*COLUMNS)


def store_candidates(new: DataFrame, existing: DataFrame, now: Column | None = None) -> DataFrame:
    """N-06: existing candidates and the new ones whose key isn't there, as pending; existing ones never change."""
    at = F.current_timestamp() if now is None else now
    fresh = new.dropDuplicates(KEY).join(existing.select(*KEY), KEY, "left_anti").withColumn("status", F.lit("pending")).withColumn("created_at", at).withColumn("updated_at", at)
    fresh = fresh.withColumn("id", F.xxhash64(*KEY)) if "id" not in fresh.columns else fresh
    return existing.unionByName(fresh.select(*[c for c in existing.columns if c in fresh.columns]), allowMissingColumns=True)


STATUSES = ("pending", "approved", "rejected")


def apply_reviews(cands: DataFrame, events: DataFrame) -> DataFrame:
    """N-07: the last event (id, event_id, status, reviewer, at, extraction) of each candidate decides; pending clears reviewer and time; edits replace the extraction.

    An unknown status is an error.
    """
    last = events.groupBy("id").agg(F.max_by(F.struct("status", "reviewer", "at", "extraction"), F.struct("at", "event_id")).alias("e"))
    checked = F.when(F.col("e.status").isin(*STATUSES), F.col("e.status")).otherwise(F.raise_error(F.concat(F.lit("unknown status "), F.coalesce("e.status", F.lit("null")))))
    rows = cands.join(last, "id", "left")
    has, pending = F.col("e").isNotNull(), F.col("e.status") == "pending"
    return (
        rows.withColumn("status", F.when(has, checked).otherwise(F.col("status")))
        .withColumn("reviewer", F.when(has & pending, F.lit(None)).when(has, F.col("e.reviewer")).otherwise(F.col("reviewer")))
        .withColumn("reviewed_at", F.when(has & pending, F.lit(None)).when(has, F.col("e.at")).otherwise(F.col("reviewed_at")))
        .withColumn("updated_at", F.when(has, F.col("e.at")).otherwise(F.col("updated_at")))
        .withColumn("extraction", F.coalesce("e.extraction", "extraction"))
        .select(*cands.columns)
    )


def review_totals(cands: DataFrame) -> DataFrame:
    """A-11: candidates by status."""
    return cands.groupBy("status").agg(F.count("*").alias("n"))


def pending(cands: DataFrame, dataset: str | None = None, status: str = "pending", limit: int | None = None) -> DataFrame:
    """L-05"""
    rows = cands.where(F.col("status") == status)
    rows = rows.where(F.col("dataset") == dataset) if dataset is not None else rows
    rows = rows.orderBy("updated_at", "id")
    return rows if limit is None else rows.limit(limit)


def evidence_spans(cands: DataFrame, key: str = "id") -> DataFrame:
    """P-28: (key, start, end): places of extracted names, aliases and abbreviations in the source text, case ignored; spans that overlap or touch are one.

    Places count characters of the source text itself. It is split at each term once, so the work grows with the text, not with its square.
    """
    terms = F.flatten(F.transform("extraction", lambda f: F.flatten(F.transform(F.array(*[F.lit(p) for p in ("name", "alias", "abbreviation")]), lambda p: F.coalesce(f["properties"][p], F.array().cast("array<string>"))))))
    rows = cands.select(key, "source_text", F.explode(F.array_distinct(F.transform(terms, lambda t: strip(t)))).alias("term")).where("term <> ''")
    # Java compares letter by letter, so what is found is as long as the term.
    pattern = F.concat(F.lit(r"(?iu)\Q"), F.replace("term", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    gaps = F.transform(F.split("source_text", pattern, -1), F.length)
    found = rows.select(key, "term", F.length("term").alias("n"), gaps.alias("gaps")).select(key, "term", "n", F.posexplode(F.slice("gaps", 1, F.size("gaps") - 1)).alias("k", "gap")).repartition(key)
    so_far = F.sum("gap").over(Window.partitionBy(key, "term").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)) + F.col("k") * F.col("n")
    spans = found.select(key, so_far.cast("int").alias("start"), (so_far + F.col("n")).cast("int").alias("end"))
    w = Window.partitionBy(key).orderBy("start", "end")
    reached = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("island", F.when(F.coalesce(F.col("start") <= reached, F.lit(False)), 0).otherwise(1)).withColumn("island", F.sum("island").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")
