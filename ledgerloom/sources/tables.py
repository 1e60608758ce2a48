"""Source tables to statements (S-03 to S-05, S-08) and plug-in mappings (X-02)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import make_id, parse_thousands, strip, strip_html, thousands_currency
from ledgerloom.plans.model import conform, prop_list, prop_struct, to_statements

# Kinds of people and bodies in the source and the schema and topic they mean. The first list that has the kind decides.
SCHEMA_OF = [
    (("person", "person "), "Person"), (("firm",), "Company"),
    (("political party", "political campaign", "charity", "think tank", "group", "news", "church", "horse"), "Organization"), (("government", "NHS", "tax haven"), "PublicBody"),
]
TOPIC_OF = [(("political party",), "pol.party"), (("government", "tax haven", "NHS"), "gov"), (("news",), "role.journo"), (("church",), "gov.religion")]
# Connection types, the schema of their edge, and which role the "from" and "to" ends take.
EDGE_RULES = [
    (("member", "group"), "Membership", "member", "organization"), (("corporate",), "Ownership", "owner", "asset"), (("job",), "Employment", "employee", "employer"),
    (("donor",), "Payment", "beneficiary", "payer"), (("contract",), "ContractAward", "supplier", "contract"), (("family",), "Family", "person", "relative"), (("meeting",), "Event", "involved", "organizer"),
]
SKIPPED = ("jurisdiction", "regulatory")
OTHER_EDGE = ("UnknownLink", "subject", "object")


def _chain(c: Column, rules: list[tuple], at: int, default: str | None) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        out = out.when(c.isin(*rule[0]), F.lit(rule[at]))
    return out.otherwise(F.lit(default).cast("string"))


def rows_to_statements(df: DataFrame, dataset: str, prefix: str, schema_of: list[tuple] = SCHEMA_OF, topic_of: list[tuple] = TOPIC_OF) -> DataFrame:
    """S-03: rows (id, type, desc) become entities whose schema and topic follow from the type. An id has a few rows at most."""
    rows = df.select(
        make_id(prefix, "id").alias("entity_id"), _chain(F.col("type"), schema_of, 1, "LegalEntity").alias("schema"), F.lit(dataset).alias("dataset"),
        F.array(prop_struct("name", F.col("id")), prop_struct("summary", strip_html("desc")), prop_struct("topics", _chain(F.col("type"), topic_of, 1, None))).alias("props"),
    )
    return to_statements(rows, few=True)


def edges_to_statements(df: DataFrame, dataset: str, prefix: str, rules: list[tuple] = EDGE_RULES) -> DataFrame:
    """S-04: rows (from, to, type, detail, contract_size) become relationship entities.

    The id hashes (from, to, type), so repeated rows collapse.  A contract yields its award alone, whose id
    and contract end hash the same parts.
    """
    kind = F.col("type")
    a, b = make_id(prefix, "from"), make_id(prefix, "to")
    own = make_id(prefix, "from", "to", "type")
    award = kind == "contract"
    sized = kind.isin("donor", "contract")
    rows = df.where(kind.isNull() | ~kind.isin(*SKIPPED)).select(
        F.when(award, make_id(prefix, F.lit("award"), "from", "to", "type")).otherwise(own).alias("entity_id"),
        _chain(kind, rules, 1, OTHER_EDGE[0]).alias("schema"),
        F.lit(dataset).alias("dataset"),
        F.array(
            F.struct(_chain(kind, rules, 2, OTHER_EDGE[1]).alias("prop"), a.alias("value")),
            F.struct(_chain(kind, rules, 3, OTHER_EDGE[2]).alias("prop"), F.when(award, own).otherwise(b).alias("value")),
            prop_struct("amount", F.when(sized, parse_thousands("contract_size"))),
            prop_struct("currency", F.when(sized, thousands_currency("contract_size"))),
            prop_struct("summary", strip_html("detail")),
        ).alias("props"),
    )
    return to_statements(rows)


COMPANY = "struct<title:string,uuid:string,openCorporatesId:string,description:string,website:string,alternativeNames:array<string>,evidence:array<struct<countries:array<string>,categories:array<string>,description:string>>>"


def json_records_to_statements(df: DataFrame, dataset: str, prefix: str, json: str = "json") -> DataFrame:
    """S-05: company records that are registered in, or have evidence from, the United Kingdom."""
    r = df.select(F.from_json(json, COMPANY).alias("r")).select("r.*").where("title <> '' and uuid <> ''")
    evidence = F.coalesce("evidence", F.array().cast("array<struct<countries:array<string>,categories:array<string>,description:string>>"))
    here = F.coalesce(F.lower("openCorporatesId").startswith("gb/"), F.lit(False)) | F.exists(evidence, lambda e: F.coalesce(F.array_contains(e["countries"], "GB"), F.lit(False)))
    categories = F.flatten(F.transform(evidence, lambda e: F.coalesce(e["categories"], F.array().cast("array<string>"))))
    rows = r.where(here).select(
        make_id(prefix, "uuid").alias("entity_id"), F.lit("Company").alias("schema"), F.lit(dataset).alias("dataset"),
        F.concat(
            F.array(prop_struct("name", F.col("title")), prop_struct("summary", F.col("description")), prop_struct("website", F.col("website")), prop_struct("opencorporatesUrl", F.col("openCorporatesId")), prop_struct("country", F.lit("gb"))),
            prop_list("alias", F.col("alternativeNames")),
            prop_list("notes", F.transform(evidence, lambda e: e["description"])),
            prop_list("keywords", F.array_distinct(F.transform(categories, strip))),
        ).alias("props"),
    )
    return to_statements(rows)


def page_json(pages: DataFrame, script_id: str, schema: str, html: str = "html", out: str = "payload") -> DataFrame:
    """S-08: the payload of <script id=...> in a page, parsed with schema; null if it isn't there or no JSON."""
    pattern = rf"""(?is)<script\b[^>]*\bid\s*=\s*["']?{script_id}["']?[^>]*>(.*?)</script>"""
    return pages.withColumn(out, F.from_json(F.nullif(F.regexp_extract(html, pattern, 1), F.lit("")), schema))


def run_mapping(source: DataFrame, mapping: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """X-02: a plug-in from a source table to statements; what it returns is brought to the statement columns."""
    return conform(mapping(source))
