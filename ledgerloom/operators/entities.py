"""Canonical ids and assembled entities (J-01, J-07, J-08, A-01, L-08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.model import ONTOLOGY, Ontology
from ledgerloom.plans.shared import dealt, staged


def canonicalise(stmt: DataFrame, linker: DataFrame, values: bool = False) -> DataFrame:
    """J-01: canonical_id from the linker (entity_id, canonical_id), default the entity itself; with values also of entity-typed values."""
    link = linker.select(F.col("entity_id").alias("__id"), F.col("canonical_id").alias("__canonical"))
    out = stmt.drop("canonical_id").join(link, F.col("entity_id") == F.col("__id"), "left").withColumn("canonical_id", F.coalesce("__canonical", "entity_id")).drop("__id", "__canonical")
    if values:
        out = out.join(link, (F.col("prop_type") == "entity") & (F.col("value") == F.col("__id")), "left").withColumn("value", F.coalesce("__canonical", "value")).drop("__id", "__canonical")
    return out.select(*stmt.columns) if "canonical_id" in stmt.columns else out


def schema_of(schemas: Column, ontology: Ontology = ONTOLOGY) -> Column:
    """Of a list of schemata struct<schema,schema_conflict>: the deepest (of equals the smallest name), and whether two are on different lines of descent."""
    depth = F.create_map(*[F.lit(x) for s, _ in ontology.tree for x in (s, ontology.depth(s))])
    above = F.create_map(*[x for s, _ in ontology.tree for x in (F.lit(s), F.lit(ontology.ancestors(s)))])
    top = F.array_min(F.transform(schemas, lambda s: F.struct((-F.coalesce(depth[s], F.lit(-1))).alias("d"), s.alias("s"))))["s"]
    apart = lambda t: F.exists(schemas, lambda s: ~F.coalesce(F.array_contains(above[t], s), F.lit(True)))
    return F.element_at(F.transform(F.array(top), lambda t: F.struct(t.alias("schema"), apart(t).alias("schema_conflict"))), 1)


def entity_schemas(stmt: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """canonical_id, schema (the deepest; of equals the smallest name), schema_conflict (two schemata on different lines of descent)."""
    return stmt.groupBy("canonical_id").agg(F.collect_set("schema").alias("s")).select("canonical_id", schema_of(F.col("s"), ontology).alias("s")).select("canonical_id", "s.*")


def assemble_entities(stmt: DataFrame, datasets: Sequence[str] | None = None, ontology: Ontology = ONTOLOGY, few: bool = False) -> DataFrame:
    """A-01: one row for each canonical id with its distinct values by property, datasets, schema and caption.

    One pass: dataset and schema count as two more properties of a statement. Values are made distinct (in a hash table, before
    they are shuffled) by canonical id, property and value, so a hub's repeated values don't travel; then they are gathered by canonical id.

    few: canonical ids have a few statements of one value at most. They are dealt by canonical id before they are unfolded, in partitions
    that grow with the input, which spares the two later shuffles and bounds what a task holds.
    """
    if datasets is not None:
        stmt = stmt.where(F.col("dataset").isin(*datasets))
    if few:
        stmt = dealt(stmt.select("canonical_id", "prop", "value", "dataset", "schema"), "canonical_id")
    pair = lambda p, v: F.struct(p.alias("prop"), v.alias("value"))
    own = F.when(F.col("prop") != "id", pair(F.col("prop"), F.col("value")))
    # The names of a dataset's and a schema's entry are no property's.
    rows = stmt.select("canonical_id", F.inline(F.array_compact(F.array(pair(F.lit(" dataset"), F.col("dataset")), pair(F.lit(" schema"), F.col("schema")), own))))
    rows = rows.distinct().groupBy("canonical_id").agg(F.array_sort(F.collect_list(F.struct("prop", "value"))).alias("all"))
    values = lambda p: F.transform(F.filter("all", lambda x: x["prop"] == p), lambda x: x["value"])
    names = F.filter(F.array_distinct(F.transform("all", lambda x: x["prop"])), lambda p: ~p.startswith(" "))
    properties = F.map_from_entries(F.transform(names, lambda p: F.struct(p.alias("prop"), values(p).alias("values"))))
    out = rows.select("canonical_id", properties.alias("properties"), F.array_compact(values(F.lit(" dataset"))).alias("datasets"), schema_of(values(F.lit(" schema")), ontology).alias("s"))
    first = lambda p: F.col("properties")[p][0]
    return out.select(F.col("canonical_id").alias("id"), "canonical_id", "s.schema", F.coalesce(first("name"), first("title"), first("alias"), F.col("canonical_id")).alias("caption"), "datasets", "properties", "s.schema_conflict")


def captions(stmt: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """id, caption, schema of each entity, without its other properties."""
    least = lambda p: F.min(F.when(F.col("prop") == p, F.col("value")))
    named = stmt.groupBy("canonical_id").agg(F.coalesce(least("name"), least("title"), least("alias"), F.col("canonical_id")).alias("caption"), F.collect_set("schema").alias("s"))
    return named.select(F.col("canonical_id").alias("id"), "caption", schema_of(F.col("s"), ontology)["schema"].alias("schema"))


def references(stmt: DataFrame) -> DataFrame:
    """(id, prop, ref): the distinct entity-typed values of each canonical id, straight from its statements."""
    return stmt.where("prop_type = 'entity'").select(F.col("canonical_id").alias("id"), "prop", F.col("value").alias("ref")).distinct()


def entity_references(entities: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """(id, prop, ref) of assembled entities."""
    names = sorted({p for _, p, k, _ in ontology.prop_rows() if k == "entity"})
    return entities.select("id", F.explode("properties").alias("prop", "values")).where(F.col("prop").isin(*names)).select("id", "prop", F.explode("values").alias("ref"))


def enrich_references(refs: DataFrame, captions: DataFrame, pointed: DataFrame | None = None) -> DataFrame:
    """J-07: (id, prop, ref, ref_caption, ref_schema) for each reference (id, prop, ref); what isn't known has its id as caption and schema Entity.

    pointed (ref): all that refs point at, where that is to be had for less than refs. Then the captions of those alone are joined, and staged
    before: where they are small no reference is shuffled, however often one of them is pointed at.
    """
    if pointed is not None:
        captions = staged(captions.join(pointed.select(F.col("ref").alias("id")).distinct(), "id", "left_semi"), "captions")
    known = captions.select(F.col("id").alias("ref"), F.col("caption").alias("ref_caption"), F.col("schema").alias("ref_schema"))
    return refs.join(known, "ref", "left").select("id", "prop", "ref", F.coalesce("ref_caption", "ref").alias("ref_caption"), F.coalesce("ref_schema", F.lit("Entity")).alias("ref_schema"))


def with_references(entities: DataFrame, enriched: DataFrame) -> DataFrame:
    """J-07: the entities with a map from property to the enriched references."""
    # By id at once: the map of an entity needs no second shuffle of its lists.
    grouped = enriched.repartition("id").groupBy("id", "prop").agg(F.array_sort(F.collect_list(F.struct(F.col("ref").alias("id"), F.col("ref_caption").alias("caption"), F.col("ref_schema").alias("schema")))).alias("refs"))
    return entities.join(grouped.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("prop", "refs"))).alias("references")), "id", "left")


def enrich_datasets(entities: DataFrame, dataset_dim: DataFrame) -> DataFrame:
    """J-08: (id, dataset, title) with the name as title where the dataset isn't configured. dataset_dim has a row for each configured dataset."""
    dim = dataset_dim.select(F.col("name").alias("dataset"), "title")
    return entities.select("id", F.explode("datasets").alias("dataset")).join(dim, "dataset", "left").select("id", "dataset", F.coalesce("title", "dataset").alias("title"))


def get_entities(stmt: DataFrame, ids: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """L-08: the entities of a table of canonical ids (id); absent ids have no row."""
    return assemble_entities(stmt.join(ids.select(F.col("id").alias("canonical_id")).distinct(), "canonical_id", "left_semi"), ontology=ontology)
