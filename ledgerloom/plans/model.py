"""The statement model and the ontology as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.shared import dealt

STMT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "entity_id", "canonical_id", "prop", "prop_type", "schema", "value", "dataset", "lang", "original_value", "origin")]
    + [T.StructField("external", T.BooleanType()), T.StructField("first_seen", T.TimestampType()), T.StructField("last_seen", T.TimestampType())]
)
COLUMNS = STMT.fieldNames()
EDGES = "source string, target string, judgement string, score double, user string, created_at timestamp, deleted_at timestamp"
JUDGEMENTS = ("positive", "negative", "unsure", "no_judgement")
FRAGMENTS = "array<struct<key:string,schema:string,properties:map<string,array<string>>>>"
NAME_PROPS = ("name", "alias", "previousName", "weakAlias", "abbreviation", "title")

# The schema tree (schema, parent) and the edge schemata (source, target, directed).
TREE = [
    ("Entity", None), ("LegalEntity", "Entity"), ("Person", "LegalEntity"), ("Organization", "LegalEntity"), ("Company", "Organization"), ("PublicBody", "Organization"),
    ("Representation", "Entity"), ("Employment", "Entity"), ("Directorship", "Entity"), ("Ownership", "Entity"), ("Membership", "Entity"), ("Payment", "Entity"),
    ("Family", "Entity"), ("UnknownLink", "Entity"), ("Event", "Entity"), ("Contract", "Entity"), ("ContractAward", "Entity"),
]
EDGE = {
    "Representation": ("agent", "client", True), "Employment": ("employer", "employee", True), "Directorship": ("director", "organization", True), "Ownership": ("owner", "asset", True),
    "Membership": ("member", "organization", True), "Payment": ("payer", "beneficiary", True), "Family": ("person", "relative", False), "UnknownLink": ("subject", "object", False),
    "Event": ("organizer", "involved", True), "ContractAward": ("supplier", "contract", True),
}
_COMMON = {"name": "text", "alias": "text", "previousName": "text", "weakAlias": "text", "abbreviation": "text", "title": "text", "summary": "text", "topics": "text", "sourceUrl": "url", "notes": "text", "keywords": "text", "country": "country"}
_ACTOR = {"website": "url", "address": "text", "incorporationDate": "date", "opencorporatesUrl": "url"}
_LINK = {"role": "text", "startDate": "date", "endDate": "date", "date": "date"}
_PEOPLE = {"employee", "director", "person", "relative"}
_FREE = {"subject", "object", "asset"}


@dataclass(frozen=True)
class Ontology:
    """Two small tables: schemata with their ancestors, and the properties of each schema."""

    tree: tuple[tuple[str, str | None], ...] = tuple(TREE)
    edges: dict[str, tuple[str, str, bool]] = field(default_factory=lambda: dict(EDGE))
    extra_props: tuple[tuple[str, str, str, str | None], ...] = ()

    def extend(self, tree: Sequence[tuple[str, str | None]] = (), edges: dict | None = None, props: Sequence[tuple[str, str, str, str | None]] = ()) -> Ontology:
        """X-04: more schemata, edges and properties (schema, prop, type, range); what comes later wins."""
        merged = {**dict(self.tree), **dict(tree)}
        return Ontology(tuple(merged.items()), {**self.edges, **(edges or {})}, (*self.extra_props, *props))

    def ancestors(self, schema: str) -> list[str]:
        parents, out = dict(self.tree), []
        at: str | None = schema
        while at is not None:
            out.append(at)
            at = parents[at]
        return out

    def depth(self, schema: str) -> int:
        return {"Person": 2, "Organization": 2}.get(schema, len(self.ancestors(schema)) - 1)

    def descendants(self, names: Sequence[str]) -> list[str]:
        """P-26: the names and all below them, in first-seen order; unknown names stay; no names: all schemata."""
        known = [s for s, _ in self.tree]
        if not names:
            return known
        return list(dict.fromkeys(x for n in names for x in [n, *(s for s in known if n in self.ancestors(s))]))

    def schema_rows(self) -> list[tuple]:
        return [(s, self.ancestors(s), self.depth(s), s in self.edges, *(self.edges.get(s) or (None, None, None))) for s, _ in self.tree]

    def prop_rows(self) -> list[tuple]:
        out: dict[tuple[str, str], tuple] = {}
        for s, _ in self.tree:
            kinds = dict(_COMMON)
            if "LegalEntity" in self.ancestors(s):
                kinds |= _ACTOR
            if s in self.edges or s in ("Contract",):
                kinds |= _LINK
            if s in ("Payment", "Contract", "ContractAward"):
                kinds |= {"amount": "number", "currency": "text"}
            for p, k in kinds.items():
                out[s, p] = (s, p, k, None)
            for p in (*self.edges.get(s, ())[:2], *(["authority"] if s == "Contract" else [])):
                out[s, p] = (s, p, "entity", "Person" if p in _PEOPLE else None if p in _FREE else "Contract" if p == "contract" else "LegalEntity")
        for s, p, k, r in self.extra_props:
            for t, _ in self.tree:
                if s in self.ancestors(t):
                    out[t, p] = (t, p, k, r)
        return list(out.values())

    def schema_dim(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.schema_rows(), "schema string, ancestors array<string>, depth int, is_edge boolean, source_prop string, target_prop string, directed boolean")

    def prop_dim(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.prop_rows(), "schema string, prop string, type string, range string")

    def prop_type(self, schema: Column, prop: Column) -> Column:
        """Type of a property by its name alone where all schemata agree, which they do here."""
        kinds = {p: k for _, p, k, _ in self.prop_rows()} | {"id": "id"}
        return F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[prop]

    def is_a(self, schema: Column, name: str) -> Column:
        return schema.isin(self.descendants([name]))


ONTOLOGY = Ontology()


def statement_id() -> Column:
    """Changes with the value, so first_seen is per value."""
    return F.sha1(F.concat_ws("|", "dataset", "entity_id", "prop", "value"))


def to_statements(rows: DataFrame, ontology: Ontology = ONTOLOGY, unique: bool = False, few: bool = False) -> DataFrame:
    """From rows (entity_id, schema, dataset, and props: array<struct<prop,value>>) the statement columns.

    Each entity gets its marker (prop id); null and empty values are left out; equal statements of an entity collapse: within a row
    before it is unfolded, across rows by grouping, which ``unique`` (a dataset and entity_id are one row) spares. Of schemata that
    rows of one entity give, the first of the ontology is kept.

    few: an entity has a few rows at most. They are dealt by entity before they are unfolded, so statements neither travel nor wait in a
    reader's hash table, and what groups by entity next moves nothing more. Without it an entity may have any number of rows.
    """
    if few:
        rows = dealt(rows, "entity_id")
    carried = [c for c in ("origin", "lang", "original_value", "external", "first_seen", "last_seen") if c in rows.columns]
    marker = F.array(F.struct(F.lit("id").alias("prop"), F.col("entity_id").alias("value")))
    props = F.array_distinct(F.concat(marker, F.filter(F.col("props"), lambda p: p["value"].isNotNull() & (p["value"] != ""))))
    long = rows.where("entity_id is not null").select("entity_id", "schema", "dataset", *carried, F.inline(props).alias("prop", "value"))
    if not unique and not carried:
        # Numbers are kept in a hash table; a text (schema) would make Spark sort all statements.
        names = F.lit([s for s, _ in ontology.tree])
        known = F.array_position(names, F.col("schema"))
        long = long.groupBy("dataset", "entity_id", "prop", "value", F.when(known > 0, F.lit(None)).otherwise(F.col("schema")).alias("other")).agg(F.min(F.nullif(known, F.lit(0).cast("long"))).alias("known"))
        long = long.select("entity_id", F.coalesce("other", F.get(names, F.col("known").cast("int") - 1)).alias("schema"), "dataset", "prop", "value")
    long = long.withColumn("prop_type", ontology.prop_type(F.col("schema"), F.col("prop"))).withColumn("canonical_id", F.col("entity_id")).withColumn("id", statement_id())
    return conform(long if unique or not carried else long.dropDuplicates(["id"]))


def conform(df: DataFrame) -> DataFrame:
    """The statement columns in their order; those that lack are null (external: false)."""
    kinds = {f.name: f.dataType for f in STMT}
    default = lambda c: F.lit(False) if c == "external" else F.lit(None)
    return df.select(*[(F.coalesce(F.col(c), F.lit(False)) if c == "external" else F.col(c)).cast(kinds[c]).alias(c) if c in df.columns else default(c).cast(kinds[c]).alias(c) for c in COLUMNS])


def prop_struct(prop: str, value: Column) -> Column:
    return F.struct(F.lit(prop).alias("prop"), value.cast("string").alias("value"))


def prop_list(prop: str, values: Column) -> Column:
    """An array-valued column as (prop, value) structs; null: none."""
    return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.struct(F.lit(prop).alias("prop"), v.alias("value")))
