"""The supplied tables as statements, edges, ledgers and candidates, each with its SQL twin for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.scalars import make_id, strip
from ledgerloom.operators.ner import split_entities
from ledgerloom.plans.model import EDGES, FRAGMENTS, ONTOLOGY, prop_struct, to_statements
from ledgerloom.plans.shared import dealt, read_table


def actors(spark: SparkSession, d: str) -> DataFrame:
    """Customers, suppliers, nations and parts as entity rows."""
    n = read_table(spark, d, "nation").select("n_nationkey", F.lower(F.substring("n_name", 1, 2)).alias("country"))
    c = read_table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    s = read_table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    none = F.lit(None).cast("string")
    row = lambda df, prefix, key, schema, dataset, name, alias, country: df.select(make_id(prefix, key).alias("entity_id"), F.lit(schema).alias("schema"), F.lit(dataset).alias("dataset"), name.alias("name"), alias.alias("alias"), country.alias("country"))
    return (
        row(c, "cust", "c_custkey", "Company", "customers", F.col("c_name"), F.col("c_mktsegment"), F.col("country"))
        .unionByName(row(s, "supp", "s_suppkey", "Organization", "suppliers", F.col("s_name"), none, F.col("country")))
        .unionByName(row(read_table(spark, d, "nation"), "nation", "n_nationkey", "PublicBody", "nations", F.col("n_name"), none, none))
        .unionByName(row(read_table(spark, d, "part"), "part", "p_partkey", "Company", "parts", F.concat_ws(", ", "p_name", "p_brand"), F.col("p_type"), none))
    )


ACTORS = """actors AS (
  SELECT 'cust-' || sha1(c_custkey::VARCHAR) AS entity_id, 'Company' AS schema, 'customers' AS dataset, c_name AS name, c_mktsegment AS alias, lower(substr(n_name, 1, 2)) AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'supp-' || sha1(s_suppkey::VARCHAR), 'Organization', 'suppliers', s_name, NULL, lower(substr(n_name, 1, 2)) FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'nation-' || sha1(n_nationkey::VARCHAR), 'PublicBody', 'nations', n_name, NULL, NULL FROM nation
  UNION ALL SELECT 'part-' || sha1(p_partkey::VARCHAR), 'Company', 'parts', p_name || ', ' || p_brand, p_type, NULL FROM part)"""


def actor_statements(spark: SparkSession, d: str) -> DataFrame:
    a = actors(spark, d)
    return to_statements(a.select("entity_id", "schema", "dataset", F.array(*[prop_struct(p, F.col(p)) for p in ("name", "alias", "country")]).alias("props")), unique=True, few=True)


STMT = (
    ACTORS
    + """, stmt AS (SELECT sha1(dataset || '|' || entity_id || '|' || prop || '|' || value) AS id, * FROM (
  SELECT entity_id, schema, dataset, 'id' AS prop, 'id' AS prop_type, entity_id AS value FROM actors
  UNION ALL SELECT entity_id, schema, dataset, 'name', 'text', name FROM actors
  UNION ALL SELECT entity_id, schema, dataset, 'alias', 'text', alias FROM actors WHERE alias IS NOT NULL
  UNION ALL SELECT entity_id, schema, dataset, 'country', 'country', country FROM actors WHERE country IS NOT NULL))"""
)


def supplier_linker(spark: SparkSession, d: str) -> DataFrame:
    """Every third supplier is the one before it."""
    s = read_table(spark, d, "supplier").where("s_suppkey > 0 and s_suppkey % 3 = 0")
    return s.select(make_id("supp", "s_suppkey").alias("entity_id"), make_id("supp", (F.col("s_suppkey") - 1)).alias("canonical_id"))


LINKER = "linker AS (SELECT 'supp-' || sha1(s_suppkey::VARCHAR) AS entity_id, 'supp-' || sha1((s_suppkey - 1)::VARCHAR) AS canonical_id FROM supplier WHERE s_suppkey > 0 AND s_suppkey % 3 = 0)"
CANON = STMT + ", " + LINKER + ", canon AS (SELECT s.*, coalesce(l.canonical_id, s.entity_id) AS canonical_id FROM stmt s LEFT JOIN linker l USING (entity_id))"


def representations(spark: SparkSession, d: str, by_id: bool = False, dated: bool = True) -> DataFrame:
    """Line items as edge entities from a supplier to a group of parts, with dates and a role.

    by_id: dealt by entity_id before the texts are made, so numbers travel; without dated also the start, end and role stay behind, which are null then.
    """
    li, keys = read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    if by_id:
        more = [F.to_date("l_shipdate").alias("l_shipdate"), "l_returnflag"] if dated else []
        li = dealt(li.select(*keys, *more), make_id("rep", *keys))
    if not dated:
        li = li.withColumn("l_shipdate", F.lit(None).cast("date")).withColumn("l_returnflag", F.lit(None).cast("string"))
    start = F.to_date("l_shipdate")
    end = F.when(F.col("l_linenumber") % 3 != 0, F.date_add(start, F.col("l_linenumber") * 20))
    role = F.when(F.col("l_returnflag") == "R", " Consultant Lobbyist").when(F.col("l_returnflag") == "A", "Lobbyist ")
    return li.select(
        make_id("rep", *keys).alias("entity_id"), make_id("supp", "l_suppkey").alias("source"), make_id("part", F.col("l_partkey") % 20).alias("target"),
        F.lit("Representation").alias("schema"), role.alias("role"), start.alias("start"), end.alias("end"),
    )


def represented(spark: SparkSession, d: str) -> DataFrame:
    """(ref): what representations point at; keys are made distinct before they are hashed."""
    li = read_table(spark, d, "lineitem")
    end = lambda agent, key: F.struct(F.lit(agent).alias("agent"), key.cast("bigint").alias("key"))
    keys = li.select(F.inline(F.array(end(True, F.col("l_suppkey")), end(False, F.col("l_partkey") % 20)))).distinct()
    return keys.select(make_id(F.when(F.col("agent"), "supp").otherwise("part"), "key").alias("ref"))


REPS = """reps AS (SELECT 'rep-' || sha1(l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR || '|' || l_partkey::VARCHAR || '|' || l_suppkey::VARCHAR) AS entity_id, 'supp-' || sha1(l_suppkey::VARCHAR) AS source,
  'part-' || sha1((l_partkey % 20)::VARCHAR) AS target, 'Representation' AS schema, CASE l_returnflag WHEN 'R' THEN ' Consultant Lobbyist' WHEN 'A' THEN 'Lobbyist ' END AS role,
  l_shipdate::DATE AS "start", CASE WHEN l_linenumber % 3 <> 0 THEN (l_shipdate::DATE + l_linenumber * 20)::DATE END AS "end" FROM lineitem)"""


def representation_statements(spark: SparkSession, d: str, kind: str | None = None) -> DataFrame:
    """kind: only the statements of this type, of which the others are never made."""
    r = representations(spark, d, by_id=True, dated=kind is None or kind in ("date", "text"))
    props = {"agent": "source", "client": "target", "role": "role", "startDate": "start", "endDate": "end"}
    if kind is not None:
        kinds = {p: k for s, p, k, _ in ONTOLOGY.prop_rows() if s == "Representation"}
        props = {p: c for p, c in props.items() if kinds[p] == kind}
    stmt = to_statements(r.select("entity_id", "schema", F.lit("deals").alias("dataset"), F.array(*[prop_struct(p, F.col(c)) for p, c in props.items()]).alias("props")))
    return stmt if kind is None else stmt.where(F.col("prop_type") == kind)


def part_edges(spark: SparkSession, d: str) -> DataFrame:
    """Resolver edges: parts of one name and brand form a chain; sizes over 45 give candidates, and every 40th key a deleted edge."""
    p = read_table(spark, d, "part")
    kind = F.when(F.col("p_size") % 7 == 0, F.concat(F.lit("Q"), F.col("p_partkey").cast("string"))).when(F.col("p_size") % 7 == 1, F.concat(F.lit("NK-"), F.col("p_partkey").cast("string"))).otherwise(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")))
    w = Window.partitionBy("p_name", "p_brand").orderBy("p_partkey")
    rows = p.select("p_name", "p_brand", "p_partkey", "p_size", kind.alias("target")).withColumn("source", F.lag("target").over(w)).where("source is not null")
    judgement = F.when(F.col("p_size") > 45, "no_judgement").when(F.col("p_size") > 42, "negative").otherwise("positive")
    deleted = F.when(F.col("p_partkey") % 40 == 0, F.lit("2024-01-02").cast("timestamp"))
    return rows.select("source", "target", judgement.alias("judgement"), (F.col("p_size") / 50.0).cast("double").alias("score"), F.lit(None).cast("string").alias("user"), F.lit("2024-01-01").cast("timestamp").alias("created_at"), deleted.alias("deleted_at")).to(spark.createDataFrame([], EDGES).schema)


PART_EDGES = """pid AS (SELECT *, CASE WHEN p_size % 7 = 0 THEN 'Q' WHEN p_size % 7 = 1 THEN 'NK-' ELSE 'part-' END || p_partkey::VARCHAR AS pid FROM part),
edges AS (SELECT source, pid AS target, CASE WHEN p_size > 45 THEN 'no_judgement' WHEN p_size > 42 THEN 'negative' ELSE 'positive' END AS judgement, p_size / 50.0::DOUBLE AS score, p_partkey % 40 = 0 AS deleted, p_name, p_brand, p_partkey
  FROM (SELECT *, lag(pid) OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS source FROM pid) WHERE source IS NOT NULL),
-- Along a chain, a part that isn't joined to the one before it begins a component.
chain AS (SELECT pid, p_name, p_brand, p_partkey, sum(CASE WHEN e.target IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS part_no
  FROM pid LEFT JOIN (SELECT target FROM edges WHERE judgement = 'positive' AND NOT deleted) e ON e.target = pid),
linker AS (SELECT pid AS entity_id, first(pid) OVER (PARTITION BY p_name, p_brand, part_no ORDER BY CASE WHEN regexp_matches(pid, '^Q[0-9]+$') THEN 3 WHEN pid LIKE 'NK-%' THEN 2 ELSE 1 END DESC, pid) AS canonical_id,
  count(*) OVER (PARTITION BY p_name, p_brand, part_no) AS n FROM chain)"""


def ledger_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as status changes of runs: a run for each user, hour and day."""
    e = read_table(spark, d, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type").isin("purchase", "signup"), "succeeded").otherwise("running")
    run = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
    return e.select("event_id", run.alias("run_id"), F.concat(F.lit("set-"), (F.col("user_id") % 25).cast("string")).alias("dataset_name"), status.alias("status"), F.col("ts").alias("at"), F.when(status == "failed", F.col("props")).alias("error_message"), F.col("props").alias("stats"))


LEDGER = """ledger AS (SELECT event_id, user_id::VARCHAR || '-' || strftime(ts, '%Y%m%d') AS run_id, 'set-' || (user_id % 25)::VARCHAR AS dataset_name,
  CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type IN ('purchase', 'signup') THEN 'succeeded' ELSE 'running' END AS status, ts AS t, CASE WHEN event_type = 'error' THEN props END AS error_message, props AS stats FROM events),
runs AS (SELECT run_id AS id, min(dataset_name) AS dataset_name, min(t) AS started_at, arg_max(status, (t, event_id)) AS status, max(t) FILTER (status IN ('succeeded', 'failed')) AS last_final, arg_max(stats, (t, event_id)) AS stats FROM ledger GROUP BY run_id)"""


def part_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Approved splits of the parts' composite names; blue ones are rejected."""
    p = read_table(spark, d, "part").select(F.concat_ws(", ", "p_name", "p_brand").alias("source_text")).distinct()
    return p.select(
        F.xxhash64("source_text").alias("id"), F.lit("parts").alias("dataset"), F.lit("any").alias("entity_id"), F.lit("Company").alias("schema"), F.lit("name").alias("property_name"), "source_text", F.sha1(strip("source_text")).alias("fingerprint"),
        F.lit("delimiter").alias("extractor"), F.lit("1").alias("extractor_version"), F.when(F.col("source_text").startswith("blue"), "rejected").otherwise("approved").alias("status"),
        F.lit(None).cast("string").alias("reviewer"), F.lit(None).cast("timestamp").alias("reviewed_at"), split_entities(F.col("source_text")).cast(FRAGMENTS).alias("extraction"), F.lit("2024-01-01").cast("timestamp").alias("created_at"), F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
    )
