"""Writing entities in batches (E-01 to E-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import make_id, parse_properties
from ledgerloom.operators.ner import clean_value
from ledgerloom.plans.model import COLUMNS, ONTOLOGY, Ontology, conform, to_statements
from ledgerloom.plans.shared import dealt, staged

#: A column ``position`` (long) beside these puts specs for one id in order; without it their contents do.
SPEC = "schema_name string, dataset string, source_ref string, entity_id string, id_parts array<string>, key_prefix string, property_items array<string>"


def _placed(specs: DataFrame) -> DataFrame:
    return specs if "position" in specs.columns else specs.withColumn("position", F.lit(None).cast("long"))


def _last(built: DataFrame) -> DataFrame:
    """Of the accepted specs for one id the last by position (null first), then by contents: one aggregation, whatever the partitions.

    Rejected ones have no place in the order. A filter before it would be pushed below ``dealt``, and work out what decides on it in the few tasks that read.
    """
    held = ["schema_name", "dataset", "source_ref", "properties"]
    order = F.struct("position", F.to_json("properties"), "schema_name", "dataset", "source_ref")
    return built.groupBy("entity_id").agg(F.max_by(F.struct(*held), F.when(F.col("reject").isNull(), order)).alias("last")).where("last is not null").select("entity_id", *[F.col(f"last.{c}").alias(c) for c in held])


def _checked(ontology: Ontology) -> Column:
    """struct<properties, reject> of a spec. Its items are parsed, and its properties' types looked up, once: both are bound by ``transform``, because a filter on the result is pushed down with all that it is made of."""
    known = F.map_from_entries(F.array(*[F.struct(F.lit(f"{s}.{p}"), F.lit(k)) for s, p, k, _ in ontology.prop_rows()]))
    typed = lambda p: F.transform(F.map_entries(p["properties"]), lambda e: F.struct(known[F.concat(F.col("schema_name"), F.lit("."), e["key"])].alias("kind"), e["value"].alias("values")))

    def result(p: Column, props: Column) -> Column:
        unknown = F.exists(props, lambda e: e["kind"].isNull())
        bad = F.exists(props, lambda e: F.exists(e["values"], lambda v: clean_value(v, e["kind"]).isNull()))
        reject = F.coalesce(
            p["error"],
            F.when(~F.col("schema_name").isin([s for s, _ in ontology.tree]) | F.col("schema_name").isNull(), "unknown schema"), F.when(unknown, "unknown property"), F.when(bad, "bad value"),
        )
        return F.struct(p["properties"].alias("properties"), reject.alias("reject"))

    return F.transform(F.array(parse_properties("property_items")), lambda p: F.transform(F.array(typed(p)), lambda props: result(p, props))[0])[0]


def build_entities(specs: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """E-01: specs with entity_id, properties and reject (null: accepted).

    The id is the given one, else a hash of schema and id parts, else of schema, dataset, source and first name.
    """
    spark = specs.sparkSession
    # Dealt first: a spec is few bytes and much work, and a file of many would be few tasks.
    rows = dealt(_placed(specs), "schema_name", "source_ref", "entity_id", "id_parts", "property_items").withColumn("__p", _checked(ontology))
    rows = rows.withColumn("properties", F.col("__p.properties"))
    prefix = F.coalesce("key_prefix", "dataset")
    parts = F.when(F.size("id_parts") > 0, F.array_join("id_parts", "|"))
    hashed = F.coalesce(F.when(parts.isNotNull(), make_id(prefix, "schema_name", parts)), make_id(prefix, F.col("schema_name"), F.col("dataset"), F.col("source_ref"), F.col("properties")["name"][0]))
    rows = rows.withColumn("entity_id", F.coalesce("entity_id", hashed))
    return rows.withColumn("reject", F.col("__p.reject")).drop("__p").to(spark.createDataFrame([], "schema_name string, dataset string, source_ref string, entity_id string, id_parts array<string>, key_prefix string, property_items array<string>, position bigint, properties map<string,array<string>>, reject string").schema)


def entity_statements(built: DataFrame, ontology: Ontology = ONTOLOGY, unique: bool = False) -> DataFrame:
    """Statements of accepted entities (entity_id, schema_name, dataset, source_ref, properties); the source is their origin. unique: an entity is one row."""
    pairs = F.flatten(F.transform(F.map_entries("properties"), lambda e: F.transform(e["value"], lambda v: F.struct(e["key"].alias("prop"), v.alias("value")))))
    return to_statements(built.select("entity_id", F.col("schema_name").alias("schema"), "dataset", F.col("source_ref").alias("origin"), pairs.alias("props")), ontology, unique=unique)


def upsert_entities(stmt: DataFrame, built: DataFrame, ontology: Ontology = ONTOLOGY) -> tuple[DataFrame, DataFrame]:
    """E-02: the statements with all statements of the built entities' ids, of any dataset, replaced; and (entity_id, action): created or updated.

    Of several specs for one id the last by position counts, of equal ones that with the greatest contents.
    """
    fine = staged(_last(built), "specs")  # used three times
    kept = conform(stmt).join(fine.select("entity_id"), "entity_id", "left_anti").select(*COLUMNS)
    there = stmt.select("entity_id").distinct().join(fine.select("entity_id"), "entity_id", "left_semi").withColumn("there", F.lit(True))
    actions = fine.select("entity_id").join(there, "entity_id", "left").select("entity_id", F.when(F.col("there"), "updated").otherwise("created").alias("action"))
    return kept.unionByName(entity_statements(fine, ontology, unique=True)), actions


def update_entities(entities: DataFrame, stmt: DataFrame, patches: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """E-03: from patches (entity_id, dataset?, source_ref?, property_items) the built entities that upsert_entities takes.

    Properties given replace whole lists, others stay.  The dataset is the given or the first by name; the source the given one or an
    origin of the entity's statements, that of the canonical entity first.  An absent entity is rejected.
    """
    parsed = _placed(patches).withColumn("__p", parse_properties("property_items"))
    now = entities.select(F.col("id").alias("entity_id"), F.col("schema").alias("schema_name"), F.col("datasets")[0].alias("__dataset"), F.col("properties").alias("__old"))
    wanted = stmt.join(patches.select(F.col("entity_id").alias("canonical_id")).distinct(), "canonical_id", "left_semi").where("origin is not null")
    origins = wanted.groupBy(F.col("canonical_id").alias("entity_id")).agg(F.min(F.struct((F.col("entity_id") != F.col("canonical_id")).alias("other"), "origin")).alias("__o"))
    rows = parsed.join(now, "entity_id", "left").join(origins, "entity_id", "left")
    new = F.coalesce("__p.properties", F.create_map().cast("map<string,array<string>>"))
    merged = F.map_concat(F.map_filter("__old", lambda k, v: ~F.map_contains_key(new, k)), new)
    known = F.map_from_entries(F.array(*[F.struct(F.lit(f"{s}.{p}"), F.lit(k)) for s, p, k, _ in ontology.prop_rows()]))
    unknown = F.exists(F.map_keys(new), lambda k: known[F.concat(F.col("schema_name"), F.lit("."), k)].isNull())
    reject = F.coalesce(F.when(F.col("schema_name").isNull(), "no such entity"), F.col("__p.error"), F.when(unknown, "unknown property"))
    return rows.select("entity_id", "schema_name", F.coalesce("dataset", "__dataset").alias("dataset"), F.coalesce("source_ref", "__o.origin").alias("source_ref"), merged.alias("properties"), reject.alias("reject"), "position")
