"""One query for each operator of the library over the supplied tables, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions import dates as D
from ledgerloom.functions import scalars as S
from ledgerloom.operators import edges as E
from ledgerloom.operators import entities as N
from ledgerloom.operators import blocks, index, ner, releases, resolver, review, search, writes, xref
from ledgerloom.plans import views as V
from ledgerloom.plans.model import FRAGMENTS, ONTOLOGY, prop_struct, to_statements
from ledgerloom.plans.shared import fresh_path, once, read_table, staged
from ledgerloom.sources import pages as P
from ledgerloom.sources import snapshots as SN
from ledgerloom.sources import tables as T
from ledgerloom.sources.configs import dataset_dim

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def flat(c: str, sep: str = "|"):
    return F.array_join(c, sep)


# --- statements, entities -------------------------------------------------------------------------------------------------


@query("WITH " + V.STMT + " SELECT id, entity_id, prop, prop_type, schema, value, dataset FROM stmt")
def stmt_unpivot(spark, d):
    return V.actor_statements(spark, d).select("id", "entity_id", "prop", "prop_type", "schema", "value", "dataset")


@query("WITH " + V.CANON + " SELECT id, entity_id, canonical_id FROM canon")
def canonicalise(spark, d):
    return N.canonicalise(V.actor_statements(spark, d), V.supplier_linker(spark, d)).select("id", "entity_id", "canonical_id")


_ENTITY = """, ent AS (SELECT canonical_id AS id, arg_max(schema, CASE schema WHEN 'Organization' THEN 2 ELSE 3 END) AS schema, coalesce(min(value) FILTER (prop = 'name'), canonical_id) AS caption,
  array_to_string(list_sort(list_distinct(list(dataset))), '|') AS datasets, array_to_string(list_sort(list_distinct(list(value) FILTER (prop = 'name'))), '|') AS names, array_to_string(list_sort(list_distinct(list(value) FILTER (prop = 'country'))), '|') AS countries
  FROM canon GROUP BY canonical_id)"""


def _entities(spark, d):
    return N.assemble_entities(N.canonicalise(V.actor_statements(spark, d), V.supplier_linker(spark, d)), few=True)


@query("WITH " + V.CANON + _ENTITY + " SELECT id, schema, caption, datasets, names, coalesce(countries, '') AS countries FROM ent")
def assemble_entities(spark, d):
    prop = lambda p: F.coalesce(F.array_join(F.col("properties")[p], "|"), F.lit(""))
    return _entities(spark, d).select("id", "schema", "caption", flat("datasets").alias("datasets"), prop("name").alias("names"), prop("country").alias("countries"))


@query("WITH " + V.STMT + ", " + V.REPS + """, named AS (SELECT entity_id AS ref, min(value) FILTER (prop = 'name') AS caption, min(schema) AS schema FROM stmt GROUP BY 1),
  refs AS (SELECT DISTINCT entity_id AS id, 'agent' AS prop, source AS ref FROM reps UNION SELECT DISTINCT entity_id, 'client', target FROM reps)
  SELECT id, prop, ref, coalesce(caption, ref) AS ref_caption, coalesce(schema, 'Entity') AS ref_schema FROM refs LEFT JOIN named USING (ref)""")
def enrich_references(spark, d):
    return N.enrich_references(N.references(V.representation_statements(spark, d, "entity")), N.captions(V.actor_statements(spark, d)), V.represented(spark, d))


@query("WITH " + V.STMT + ", " + V.REPS + """, named AS (SELECT entity_id AS ref, min(value) FILTER (prop = 'name') AS caption FROM stmt GROUP BY 1), refs AS (SELECT DISTINCT entity_id AS id, source AS ref, 'agent' AS prop FROM reps UNION SELECT DISTINCT entity_id, target, 'client' FROM reps)
  SELECT id, count(*) FILTER (prop = 'agent') AS n_agents, string_agg(coalesce(caption, ref), '|' ORDER BY ref) FILTER (prop = 'client') AS clients FROM refs LEFT JOIN named USING (ref) WHERE id IN (SELECT entity_id FROM reps WHERE "end" IS NULL) GROUP BY 1""")
def entities_with_references(spark, d):
    """J-07 as a map of each entity: representations without an end."""
    stmt = V.representation_statements(spark, d)
    going = V.representations(spark, d).where("end is null").select(F.col("entity_id").alias("id"))
    entities = staged(N.get_entities(stmt, going), "entities")
    out = N.with_references(entities, N.enrich_references(N.entity_references(entities), N.captions(V.actor_statements(spark, d))))
    of = lambda p: F.col("references")[p]
    return out.select("id", F.size(of("agent")).cast("bigint").alias("n_agents"), F.array_join(F.transform(of("client"), lambda r: r["caption"]), "|").alias("clients"))


@query("WITH " + V.STMT + """ SELECT DISTINCT entity_id AS id, dataset, CASE dataset WHEN 'customers' THEN 'All customers' WHEN 'suppliers' THEN 'All suppliers' ELSE dataset END AS title FROM stmt""")
def enrich_datasets(spark, d):
    dim = spark.createDataFrame([("customers", "All customers"), ("suppliers", "All suppliers")], "name string, title string")
    return N.enrich_datasets(N.assemble_entities(V.actor_statements(spark, d)), dim)


@query("WITH " + V.STMT + " SELECT entity_id AS id, min(value) FILTER (prop = 'name') AS caption, min(schema) AS schema FROM stmt WHERE dataset = 'suppliers' GROUP BY 1")
def get_entities(spark, d):
    ids = read_table(spark, d, "supplier").select(S.make_id("supp", "s_suppkey").alias("id"))
    return N.get_entities(V.actor_statements(spark, d), ids).select("id", "caption", "schema")


# --- sources --------------------------------------------------------------------------------------------------------------


@query("""WITH k AS (SELECT 'p-' || sha1(c_name) AS entity_id, c_name AS name, c_custkey % 7 AS t, CASE c_custkey % 7 WHEN 0 THEN 'Person' WHEN 1 THEN 'Company' WHEN 2 THEN 'Organization' WHEN 3 THEN 'PublicBody' WHEN 4 THEN 'PublicBody' WHEN 5 THEN 'Organization' ELSE 'LegalEntity' END AS schema FROM customer),
  l AS (SELECT entity_id, schema, 'id' AS prop, entity_id AS value FROM k UNION ALL SELECT entity_id, schema, 'name', name FROM k UNION ALL SELECT entity_id, schema, 'summary', 'about & of ' || name FROM k
  UNION ALL SELECT entity_id, schema, 'topics', CASE WHEN t IN (3, 4) THEN 'gov' ELSE 'role.journo' END FROM k WHERE t IN (3, 4, 5))
  SELECT sha1('people|' || entity_id || '|' || prop || '|' || value) AS id, entity_id, schema, prop, value FROM l""")
def people_statements(spark, d):
    kinds = F.array(*[F.lit(x) for x in ("person ", "firm", "horse", "government", "NHS", "news", "other")])
    rows = read_table(spark, d, "customer").select(F.col("c_name").alias("id"), kinds[(F.col("c_custkey") % 7).cast("int")].alias("type"), F.concat(F.lit("<p>about &amp; <b>of</b> "), "c_name", F.lit("</p>")).alias("desc"))
    return T.rows_to_statements(rows, "people", "p").select("id", "entity_id", "schema", "prop", "value")


_KINDS = ("member", "corporate", "job", "donor", "contract", "family", "meeting", "informal", "regulatory")


@query("""WITH o AS (SELECT 'c' || o_custkey AS a, 'o' || (o_orderkey % 500) AS b, list_value('member','corporate','job','donor','contract','family','meeting','informal','regulatory')[1 + o_custkey % 9] AS t, o_totalprice::DECIMAL(18,2)::VARCHAR AS size FROM orders),
  e AS (SELECT *, 'x-' || sha1(a) AS ia, 'x-' || sha1(b) AS ib, 'x-' || sha1(a || '|' || b || '|' || t) AS own, CAST(trunc(size::DOUBLE * 1000) AS BIGINT)::VARCHAR AS amount FROM o WHERE t <> 'regulatory'),
  r AS (SELECT CASE WHEN t = 'contract' THEN 'x-' || sha1('award|' || a || '|' || b || '|' || t) ELSE own END AS entity_id, t, ia, CASE WHEN t = 'contract' THEN own ELSE ib END AS ib, amount,
    CASE t WHEN 'member' THEN 'Membership' WHEN 'corporate' THEN 'Ownership' WHEN 'job' THEN 'Employment' WHEN 'donor' THEN 'Payment' WHEN 'contract' THEN 'ContractAward' WHEN 'family' THEN 'Family' WHEN 'meeting' THEN 'Event' ELSE 'UnknownLink' END AS schema,
    CASE t WHEN 'member' THEN 'member' WHEN 'corporate' THEN 'owner' WHEN 'job' THEN 'employee' WHEN 'donor' THEN 'beneficiary' WHEN 'contract' THEN 'supplier' WHEN 'family' THEN 'person' WHEN 'meeting' THEN 'involved' ELSE 'subject' END AS pa,
    CASE t WHEN 'member' THEN 'organization' WHEN 'corporate' THEN 'asset' WHEN 'job' THEN 'employer' WHEN 'donor' THEN 'payer' WHEN 'contract' THEN 'contract' WHEN 'family' THEN 'relative' WHEN 'meeting' THEN 'organizer' ELSE 'object' END AS pb FROM e),
  l AS (SELECT entity_id, schema, 'id' AS prop, entity_id AS value FROM r UNION SELECT entity_id, schema, pa, ia FROM r UNION SELECT entity_id, schema, pb, ib FROM r UNION SELECT entity_id, schema, 'amount', amount FROM r WHERE t IN ('donor', 'contract') UNION SELECT entity_id, schema, 'currency', 'GBP' FROM r WHERE t IN ('donor', 'contract'))
  SELECT DISTINCT sha1('links|' || entity_id || '|' || prop || '|' || value) AS id, entity_id, schema, prop, value FROM l""")
def edge_statements(spark, d):
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    rows = read_table(spark, d, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("from"), F.concat(F.lit("o"), (F.col("o_orderkey") % 500).cast("string")).alias("to"), kinds[(F.col("o_custkey") % 9).cast("int")].alias("type"),
        F.lit(None).cast("string").alias("detail"), F.format_number("o_totalprice", 2).alias("contract_size"),
    )
    return T.edges_to_statements(rows, "links", "x").select("id", "entity_id", "schema", "prop", "value")


@query("""WITH e AS (SELECT event_id, json_extract_string(props, '$.k')::INT AS k, user_id, event_type FROM events), u AS (SELECT * FROM e WHERE user_id % 3 = 0 OR k >= 50),
  b AS (SELECT 'j-' || sha1('u' || event_id) AS entity_id, * FROM u),
  l AS (SELECT entity_id, 'id' AS prop, entity_id AS value FROM b UNION ALL SELECT entity_id, 'name', 'Firm ' || k FROM b UNION ALL SELECT entity_id, 'opencorporatesUrl', 'GB/' || k FROM b WHERE user_id % 3 = 0 UNION ALL SELECT entity_id, 'opencorporatesUrl', 'us/' || k FROM b WHERE user_id % 3 <> 0
  UNION ALL SELECT entity_id, 'country', 'gb' FROM b UNION ALL SELECT entity_id, 'alias', event_type FROM b UNION ALL SELECT entity_id, 'keywords', 'data' FROM b UNION ALL SELECT entity_id, 'keywords', event_type FROM b UNION ALL SELECT entity_id, 'notes', 'note ' || k FROM b)
  SELECT sha1('json|' || entity_id || '|' || prop || '|' || value) AS id, entity_id, prop, value FROM l""")
def json_records(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    e = read_table(spark, d, "events").withColumn("k", k)
    evidence = F.array(
        F.struct(F.array(F.when(F.col("k") >= 50, "GB").otherwise("FR")).alias("countries"), F.array(F.lit(" data "), F.col("event_type")).alias("categories"), F.concat(F.lit("note "), "k").alias("description")),
        F.struct(F.array(F.lit("US")).alias("countries"), F.array(F.lit("data")).alias("categories"), F.lit(None).cast("string").alias("description")),
    )
    code = F.concat(F.when(F.col("user_id") % 3 == 0, "GB/").otherwise("us/"), F.col("k").cast("string"))
    record = F.struct(F.concat(F.lit("Firm "), "k").alias("title"), F.concat(F.lit("u"), "event_id").alias("uuid"), code.alias("openCorporatesId"), F.array("event_type").alias("alternativeNames"), evidence.alias("evidence"))
    return T.json_records_to_statements(e.select(F.to_json(record).alias("json")), "json", "j").select("id", "entity_id", "prop", "value")


@query("""WITH l AS (SELECT 'org-' || sha1(s_name) AS e, unnest(['id', 'name']) AS prop, unnest(['org-' || sha1(s_name), s_name]) AS value, s_name FROM supplier)
  SELECT sha1('plugged|' || e || '|' || prop || '|' || value) AS id, e AS entity_id, e AS canonical_id, 'plugged' AS dataset, prop, value, false AS external FROM l""")
def source_mapping(spark, d):
    """X-02: a plug-in that maps a source table."""

    def mapping(source):
        rows = source.select(S.make_id("org", "s_name").alias("entity_id"), F.lit("Organization").alias("schema"), F.lit("plugged").alias("dataset"), F.array(prop_struct("name", F.col("s_name"))).alias("props"))
        return to_statements(rows).drop("external", "origin").withColumn("extra", F.lit(1))

    return T.run_mapping(read_table(spark, d, "supplier"), mapping).select("id", "entity_id", "canonical_id", "dataset", "prop", "value", "external")


@query("""SELECT 'n' || n_nationkey AS name, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'n' || n_nationkey END AS title, 'http://x/' || n_nationkey AS url, CASE WHEN n_nationkey % 2 = 0 THEN 'a|b' ELSE '' END AS tags, CASE WHEN n_nationkey % 2 = 0 THEN r_name END AS publisher, CASE WHEN n_nationkey % 2 = 0 THEN 'gb' ELSE '' END AS countries
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 0""")
def dataset_configs(spark, d):
    """S-09: a configuration file for each nation: nested and flat ones, publishers that aren't blocks, every fifth without a name."""
    n = read_table(spark, d, "nation").join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey").cast("string")
    nested = F.concat(F.lit("dataset:\n  name: n"), key, F.lit("\n  title: '"), "n_name", F.lit("'\n  tags: [a, b]\n  url: http://x/"), key, F.lit("\npublisher:\n  name: '"), "r_name", F.lit("'\ncoverage:\n  countries: [gb]\n"))
    flat_ = F.concat(F.lit("name: n"), key, F.lit("\nindex_url: http://x/"), key, F.lit("\npublisher: text\nlicence: text\n"))
    text = F.when(F.col("n_nationkey") % 5 == 0, "title: nameless\n").when(F.col("n_nationkey") % 2 == 0, nested).otherwise(flat_)
    path = fresh_path(spark, "configs")
    n.select(text.alias("value"), "n_nationkey").write.partitionBy("n_nationkey").text(path)
    return dataset_dim(spark, path).select("name", "title", "url", flat("tags").alias("tags"), F.col("publisher.name").alias("publisher"), flat("coverage.countries").alias("countries"))


@query("""WITH a AS (SELECT DISTINCT regexp_replace(url, '^(https?://[^/]+).*$', '\\1') || h AS link FROM (SELECT url, unnest(regexp_extract_all(html, '<a href="(/[^"]*)">', 1)) AS h FROM pages))
  SELECT link FROM a WHERE link IS NOT NULL""")
def page_links(spark, d):
    return P.extract_links(read_table(spark, d, "pages"))


@query("""SELECT page_id, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, page_id AS k FROM pages""")
def page_payload(spark, d):
    wrapped = read_table(spark, d, "pages").select("page_id", "html", F.concat(F.lit('<html><script id="data" type="application/json">{"k":'), F.col("page_id"), F.lit("}</script>"), "html").alias("page"))
    out = T.page_json(wrapped, "data", "k bigint", html="page")
    return out.select("page_id", F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"), F.col("payload.k").alias("k"))


_HEADING = """trim(regexp_replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&amp;', '&'), '\\s+', ' ', 'g'))"""


@query(f"SELECT page_id, trim('’Aé ' || {_HEADING}) AS heading FROM pages")
def page_headings(spark, d):
    return read_table(spark, d, "pages").select("page_id", S.strip_html(F.concat(F.lit("\u2003<i></i>&#8217;&#x41;&#XE9;\u00a0"), F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1))).alias("heading"))


#: HTML's parsers also decode these references where their semicolon is missing.
_TITLE = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))"""


@query(f"""WITH t AS (SELECT page_id, url, {_TITLE} AS title FROM pages), p AS (SELECT *, 'dir-' || sha1('thinktank|' || title) AS org, 'Ann ' || page_id AS name, 'dir-' || sha1('person|Ann ' || page_id) AS person FROM t WHERE title <> ''),
  f AS (SELECT *, 'dir-' || sha1('founder|' || org || '|' || person) AS founder FROM p),
  l AS (SELECT org AS e, 'Organization' AS schema, unnest(['id', 'name', 'topics', 'sourceUrl', 'website']) AS prop, unnest([org, title, 'pol.thinktank', url, url]) AS value FROM f UNION SELECT person, 'Person', unnest(['id', 'name']), unnest([person, name]) FROM f
    UNION SELECT founder, 'Directorship', unnest(['id', 'organization', 'director', 'role']), unnest([founder, org, person, 'Founder']) FROM f)
  SELECT DISTINCT sha1('directory|' || e || '|' || prop || '|' || value) AS id, e AS entity_id, schema, prop, value FROM l""")
def pages_extract(spark, d):
    """The pages dressed as directory pages: their heading, and facts made from their address, before the whole page."""
    p = read_table(spark, d, "pages")
    body = F.concat(
        F.lit('<h1 class="c-single-header__title">'), F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1), F.lit('</h1><dl class="c-single--directory__section-data-dl"><dt>Website</dt><dd><a href="'), "url",
        F.lit('">site</a></dd></dl><div class="c-single--directory__section-data-item"><div class="c-single--directory__section-sub-title">Founded by</div><div class="c-single--directory__section-sub-data">Founders: Ann '), F.col("page_id"), F.lit(", n/a</div></div>"), F.coalesce("html", F.lit("")),
    )
    return P.pages_to_statements(p.select("url", body.alias("html")), "directory", "dir").select("id", "entity_id", "schema", "prop", "value")


# --- snapshots ------------------------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT sha1('set|' || user_id || '|' || event_type || '|' || 'v') AS id, ts FROM events), p AS (SELECT id, min(ts) AS first_seen FROM s WHERE hour(ts) < 8 GROUP BY id), n AS (SELECT DISTINCT id FROM s WHERE hour(ts) >= 8)
  SELECT id, strftime(coalesce(first_seen, TIMESTAMP '2024-02-01'), '%Y-%m-%d %H:%M:%S') AS first_seen, '2024-02-01 00:00:00' AS last_seen FROM n LEFT JOIN p USING (id)""")
def first_seen_carry(spark, d):
    e = read_table(spark, d, "events").withColumn("id", F.sha1(F.concat_ws("|", F.lit("set"), "user_id", "event_type", F.lit("v"))))
    before = e.where(F.hour("ts") < 8).groupBy("id").agg(F.min("ts").alias("first_seen"))
    now = e.where(F.hour("ts") >= 8).select("id").distinct().withColumn("first_seen", F.lit(None).cast("timestamp"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return SN.carry_first_seen(now, before, F.lit("2024-02-01").cast("timestamp")).select("id", text("first_seen"), text("last_seen"))


@query("WITH " + V.STMT + " SELECT dataset, count(*) AS n_statements, count(DISTINCT entity_id) AS n_entities FROM stmt GROUP BY 1")
def snapshot_round_trip(spark, d):
    """Snapshots of each dataset are written, read, and loaded twice into a target; loading replaces."""
    root, stmt = fresh_path(spark, "store"), staged(V.actor_statements(spark, d), "statements")
    for name in ("customers", "suppliers", "nations", "parts"):
        SN.write_snapshot(stmt.where(F.col("dataset") == name), root, name, "r1")
    names = ["customers", "suppliers", "nations", "parts"]
    rows = SN.read_statements(spark, root, names)
    SN.load_statements(rows, f"{root}/working", names)
    SN.load_statements(rows, f"{root}/working", ["parts"], known=names)
    return SN.read_target(spark, f"{root}/working").groupBy("dataset").agg(F.count("*").alias("n_statements"), F.count_distinct("entity_id").alias("n_entities"))


def _two_runs(spark, d):
    """Suppliers with a succeeded run of all statements, a newer one without the last digit 7, and a failed one; customers with one run; nations with a failed one. The store and its ledger."""
    root, stmt = fresh_path(spark, "store"), staged(V.actor_statements(spark, d).where("dataset in ('customers', 'suppliers', 'nations')"), "statements")
    of = lambda name: stmt.where(F.col("dataset") == name)
    for rows, name, run in ((of("suppliers"), "suppliers", "r1"), (of("suppliers").where("not endswith(value, '7')"), "suppliers", "r2"), (of("suppliers").where("prop = 'name'"), "suppliers", "r3"), (of("customers"), "customers", "r4"), (of("nations"), "nations", "r5")):
        SN.write_snapshot(rows, root, name, run)
    day = lambda n: f"2024-01-0{n}"
    runs = spark.createDataFrame([("r1", "suppliers", "succeeded", day(1)), ("r2", "suppliers", "succeeded", day(2)), ("r3", "suppliers", "failed", day(3)), ("r4", "customers", "succeeded", day(1)), ("r5", "nations", "failed", day(1))], "id string, dataset_name string, status string, at string")
    runs = runs.withColumn("started_at", F.to_timestamp("at"))
    artifacts = spark.createDataFrame([(i, f"r{i}", "statements_pack", f"k{i}") for i in range(1, 6)], "id long, dataset_run_id string, artifact_type string, storage_key string")
    return root, runs, artifacts


@query("WITH " + V.STMT + """ SELECT dataset, CASE dataset WHEN 'suppliers' THEN 'r2' ELSE 'r4' END AS run_id, count(*) AS n_statements, count(DISTINCT entity_id) AS n_entities FROM stmt
  WHERE dataset = 'customers' OR dataset = 'suppliers' AND value NOT LIKE '%7' GROUP BY 1""")
def snapshot_latest(spark, d):
    """S-01: of several runs the newest succeeded one is read."""
    root, runs, artifacts = _two_runs(spark, d)
    return SN.read_statements(spark, root, ["suppliers", "customers", "nations"], runs=runs, artifacts=artifacts).groupBy("dataset", "run_id").agg(F.count("*").alias("n_statements"), F.count_distinct("entity_id").alias("n_entities"))


@query("WITH " + V.STMT + " SELECT dataset, count(*) AS n_statements FROM stmt WHERE dataset IN ('customers', 'parts') GROUP BY 1")
def snapshot_empty_load(spark, d):
    """S-10: a dataset loaded without statements has none afterwards; others stay."""
    target, stmt = fresh_path(spark, "working"), staged(V.actor_statements(spark, d), "statements")
    SN.load_statements(stmt, target, ["customers", "suppliers", "nations", "parts"])
    SN.load_statements(stmt.where("dataset = 'parts'"), target, ["suppliers", "nations", "parts"])
    return SN.read_target(spark, target).groupBy("dataset").agg(F.count("*").alias("n_statements"))


@query("WITH " + V.STMT + " SELECT dataset, count(*) AS n_statements, sum(('0x' || substr(id, 1, 15))::BIGINT::HUGEINT)::VARCHAR AS content_hash FROM stmt GROUP BY 1")
def manifest(spark, d):
    return SN.content_manifest(V.actor_statements(spark, d))


@query("WITH " + V.STMT + " SELECT dataset, left(id, 1) AS part, sha256(string_agg(id || chr(10), '' ORDER BY id)) AS sha256, (41 * count(*))::BIGINT AS size_bytes FROM stmt GROUP BY 1, 2")
def file_manifest(spark, d):
    """A-09: the statements' ids, a file for each dataset and first digit, in order; then key, sha256 and size of each file."""
    path = fresh_path(spark, "listed")
    ids = V.actor_statements(spark, d).select("dataset", F.substring("id", 1, 1).alias("part"), "id")
    ids.repartition("dataset", "part").sortWithinPartitions("dataset", "part", "id").write.partitionBy("dataset", "part").text(path)
    of = lambda name: F.regexp_extract("artifact_key", f"/{name}=([^/]*)/", 1).alias(name)
    return SN.manifest(spark, path).where("size_bytes > 0").select(of("dataset"), of("part"), "sha256", "size_bytes")


@query("WITH " + V.CANON + _ENTITY + " SELECT id, caption FROM ent")
def exported_entities(spark, d):
    path = fresh_path(spark, "export")
    SN.export_entities(_entities(spark, d), path)
    return spark.read.text(path).select(F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.caption").alias("caption"))


# --- scalars --------------------------------------------------------------------------------------------------------------

_DATE_TEXTS = [
    ("dd/MM/yyyy", "%d/%m/%Y"), ("d/M/yy", None), ("yyyy-MM-dd", None), ("d-M-yyyy", None), ("d-MMM-yyyy", None), ("dd-MMM-yy", None), ("d MMM yyyy", None), ("d MMM yy", None), ("d MMMM yyyy", None), ("dd MMMM yy", None),
    ("MMMM d, yyyy", None), ("EEEE, MMMM d, yyyy", None), ("EEEE, d MMMM yyyy", None), ("yyyy/MM/dd", None), ("dd.MM.yyyy", None), ("yyyy.M.d", None), ("yyyy-MM-dd'T'HH:mm", None), (" ? d MMMM yyyy*", None), ("\u00a0d\u00a0MMMM\u2003yyyy\u3000", None), ("dd/MM/yyyy\u00a0", None),
]


@query(f"SELECT o_orderkey, (o_orderkey % {len(_DATE_TEXTS)})::INT AS form, strftime(o_orderdate, '%Y-%m-%d') AS parsed FROM orders")
def dates_parse(spark, d):
    o = read_table(spark, d, "orders").withColumn("form", (F.col("o_orderkey") % len(_DATE_TEXTS)).cast("int"))
    text = F.lit(None).cast("string")
    for i, (fmt, _) in enumerate(_DATE_TEXTS):
        pattern = fmt.replace(" ? ", "' ? '").replace("*", "'*'")
        text = F.when(F.col("form") == i, F.date_format("o_orderdate", pattern)).otherwise(text)
    return once(o.select("o_orderkey", "form", text.alias("text")), ["text"], D.parse_date(F.col("text")).alias("parsed")).drop("text")


@query("""SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, strftime(o_orderdate, '%Y-%m-%d') AS range_start,
  strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m-%d') AS range_end, strftime(o_orderdate, '%Y-%m-%d') AS partial, strftime(o_orderdate, '%Y-%m-%d') AS repaired, strftime(o_orderdate, '%Y-%m-%d') AS serial,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS span_start, strftime(last_day(o_orderdate + INTERVAL 62 DAY), '%Y-%m-%d') AS span_end FROM orders""")
def dates_ranges(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    end, far = F.date_add("day", 40), F.date_add("day", 62)
    fmt = lambda c, f: F.date_format(c, f)
    year_start, year_end = F.trunc("day", "year"), F.last_day(F.add_months(F.trunc("day", "year"), 11))
    month = D.parse_month_value(fmt("day", "MMMM yyyy"))
    span = D.parse_day_range(F.concat(fmt("day", "d MMM yyyy"), F.lit(" _ "), fmt(end, "d MMMM yyyy")))
    partial = D.parse_partial_date(fmt("day", "d/MMMM"), year_start, year_end)
    wrong = F.concat(fmt("day", "dd/MM/"), (F.year("day") + 1000).cast("string"))
    months = D.parse_month_span(F.concat(fmt("day", "MMM"), F.lit(" to "), fmt(far, "MMMM")), F.year(far))
    serial = D.parse_date(F.datediff("day", F.lit("1899-12-30").cast("date")).cast("string"))
    parsed = once(
        o, ["day"], month["start"].alias("month_start"), month["end"].alias("month_end"), span["start"].alias("range_start"), span["end"].alias("range_end"), partial.alias("partial"),
        D.parse_year_hint_date(wrong, year_start, year_end).alias("repaired"), serial.alias("serial"), months["start"].alias("span_start"), months["end"].alias("span_end"),
    )
    return parsed.drop("day")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'month' ELSE 'day' END AS kind, CASE WHEN o_orderkey % 3 = 2 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "start",
  CASE o_orderkey % 3 WHEN 2 THEN strftime(last_day(o_orderdate), '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') END AS "end" FROM orders""")
def dates_day_or_month(spark, d):
    day = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "d MMMM yyyy")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" - "), F.date_format(F.date_add(day, 3), "dd/MM/yyyy"))).otherwise(F.date_format(day, "MMM, yyyy"))
    o = read_table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    return once(o, ["text"], D.parse_day_or_month(F.col("text")).alias("p")).select("o_orderkey", "p.*")


@query("""SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_first, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_last, strftime(o_orderdate, '%Y-%m-%d') AS day, false AS bad_day, true AS bad_month FROM orders""")
def dates_tokens(spark, d):
    t = lambda f: F.date_format("o_orderdate", f)
    return read_table(spark, d, "orders").select("o_orderkey", D.date_token(t("yyyy-MM")).cast("string").alias("month_first"), D.date_token(t("yyyy-MM"), True).cast("string").alias("month_last"), D.date_token(t("yyyy-MM-dd")).cast("string").alias("day"), D.bad_token(t("yyyy-MM-dd")).alias("bad_day"), D.bad_token(F.concat(t("yyyy"), F.lit("-13"))).alias("bad_month"))


@query("""SELECT c_custkey, round(c_acctbal, 2) AS amount, CAST(trunc(c_acctbal::DECIMAL(18,2)::VARCHAR::DOUBLE * 1000) AS BIGINT) AS thousands, 'GBP' AS currency, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS cleaned FROM customer""")
def amounts(spark, d):
    text = F.format_number("c_acctbal", 2)
    cleaned = F.when(F.col("c_custkey") % 8 == 0, "\u00a0N/A\u2003").when(F.col("c_custkey") % 4 == 0, " N/A ").otherwise(F.concat(F.lit(" \u00a0"), "c_name", F.lit("\u2003 ")))
    return read_table(spark, d, "customer").select("c_custkey", F.round(S.parse_amount(F.concat(F.lit("£ "), text)), 2).alias("amount"), S.parse_thousands(text).alias("thousands"), S.thousands_currency(text).alias("currency"), S.clean_string(cleaned).alias("cleaned"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 < 4 THEN CASE c_custkey % 5 WHEN 0 THEN lpad(c_custkey::VARCHAR, 8, '0') WHEN 1 THEN 'SC' || lpad(c_custkey::VARCHAR, 6, '0') WHEN 2 THEN 'IP' || lpad(c_custkey::VARCHAR, 5, '0') || 'R' ELSE 'OC' || lpad(c_custkey::VARCHAR, 6, '0') END END AS number,
  c_custkey % 5 < 4 AND c_custkey % 5 > 0 OR (c_custkey % 5 = 0 AND length(c_custkey::VARCHAR) = 8) AS as_it_is, 'GB-COH-' || CASE WHEN c_custkey % 5 = 0 THEN c_custkey::VARCHAR WHEN c_custkey % 5 = 1 THEN 'SC' || lpad(c_custkey::VARCHAR, 6, '0') WHEN c_custkey % 5 = 2 THEN 'IP' || lpad(c_custkey::VARCHAR, 5, '0') || 'R'
  WHEN c_custkey % 5 = 3 THEN 'OC' || lpad(c_custkey::VARCHAR, 6, '0') ELSE 'ZZ' || c_custkey END AS registry_id, 4 AS weight FROM customer""")
def company_numbers(spark, d):
    key = F.col("c_custkey").cast("string")
    k = F.col("c_custkey") % 5
    raw = F.when(k == 0, key).when(k == 1, F.concat(F.lit("SC"), F.lpad(key, 6, "0"))).when(k == 2, F.concat(F.lit("IP"), F.lpad(key, 5, "0"), F.lit("R"))).when(k == 3, F.concat(F.lit("OC"), F.lpad(key, 6, "0"))).otherwise(F.concat(F.lit("ZZ"), key))
    reg = S.make_id("x", key, reg_nr=raw, register="GB-COH")
    return read_table(spark, d, "customer").select("c_custkey", S.normalize_gb_coh(F.concat(F.lit(" "), F.lower(raw))).alias("number"), S.is_gb_coh(raw).alias("as_it_is"), reg.alias("registry_id"), S.id_weight(reg).alias("weight"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_returnflag WHEN 'R' THEN 'lobbyist' WHEN 'A' THEN 'adviser' END AS role, least('s' || l_suppkey, 'p' || l_partkey) || '::' || greatest('s' || l_suppkey, 'p' || l_partkey) AS pair, 'team:' || l_suppkey || ':' || l_linestatus AS label FROM lineitem""")
def roles_and_keys(spark, d):
    role = F.when(F.col("l_returnflag") == "R", " Consultant Lobbyist").when(F.col("l_returnflag") == "A", "Adviser ").otherwise("  ")
    a, b = F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("p"), "l_partkey")
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.normalize_role(role).alias("role"), S.pair_key(a, b).alias("pair"), S.user_label("l_suppkey", F.concat(F.lit(" "), "l_linestatus"), "team").alias("label"))


@query("""SELECT p_partkey, CASE lower(p_brand) WHEN 'brand#1' THEN 'first' WHEN 'brand#2' THEN 'second' END AS looked_up FROM part""")
def value_lookup(spark, d):
    table = spark.createDataFrame([("brands", "BRAND#1", "first"), ("brands", "brand#2 ", "second"), ("other", "Brand#3", "third")], "lookup string, match string, value string")
    return S.lookup(read_table(spark, d, "part"), table, "p_brand", "brands").select("p_partkey", "looked_up")


@query("""SELECT o_orderkey, 1 AS n_names, o_orderpriority AS name, o_orderstatus || ',' || (o_custkey % 10)::VARCHAR AS aliases, CASE WHEN o_orderkey % 5 = 0 THEN 'missing =' END AS error FROM (SELECT * FROM orders WHERE o_orderkey % 5 <> 0) UNION ALL SELECT o_orderkey, NULL, NULL, NULL, 'missing =' FROM orders WHERE o_orderkey % 5 = 0""")
def property_items(spark, d):
    items = F.array(F.concat(F.lit(" name = "), "o_orderpriority"), F.concat(F.lit("alias="), "o_orderstatus"), F.when(F.col("o_orderkey") % 5 == 0, "alias").otherwise(F.concat(F.lit("alias="), (F.col("o_custkey") % 10).cast("string"))))
    p = read_table(spark, d, "orders").select("o_orderkey", S.parse_properties(items).alias("p"))
    return p.select("o_orderkey", F.size(F.col("p.properties")["name"]).alias("n_names"), F.col("p.properties")["name"][0].alias("name"), F.array_join(F.col("p.properties")["alias"], ",").alias("aliases"), "p.error")


# --- relationship edges ---------------------------------------------------------------------------------------------------

_CHAINS = V.REPS + """, r AS (SELECT entity_id, source, target, schema, CASE WHEN role LIKE '%obbyist%' THEN 'lobbyist' END AS role, "start", "end" FROM reps),
  a AS (SELECT *, lag("start") OVER w AS ps, lag("end") OVER w AS pe, row_number() OVER w AS rn FROM r WINDOW w AS (PARTITION BY source, target, schema, role ORDER BY "start" NULLS FIRST, "end" NULLS LAST, entity_id)),
  b AS (SELECT *, CASE WHEN coalesce(ps = "start" AND (pe IS NULL) <> ("end" IS NULL), false) OR coalesce(ps IS NOT NULL AND pe IS NOT NULL AND "end" IS NOT NULL AND "start" <= pe + 1, false) THEN 0 ELSE 1 END AS brk FROM a),
  c AS (SELECT *, sum(brk) OVER (PARTITION BY source, target, schema, role ORDER BY rn) AS chain FROM b),
  chains AS (SELECT *, count(*) OVER (PARTITION BY source, target, schema, role, chain) AS chain_size, first(entity_id) OVER (PARTITION BY source, target, schema, role, chain ORDER BY rn) AS chain_first FROM c)"""


@query("WITH " + _CHAINS + " SELECT entity_id, source, target, role, chain::BIGINT AS chain, chain_size, chain_first FROM chains WHERE chain_size >= 2")
def edge_chains(spark, d):
    return E.edge_chains(V.representations(spark, d).withColumn("role", S.normalize_role("role"))).select("entity_id", "source", "target", "role", "chain", "chain_size", "chain_first")


_ONE = V.REPS.replace("reps AS (", "raw AS (") + """, reps AS (SELECT entity_id, min(source) AS source, min(target) AS target, 'Representation' AS schema, min(role) AS role, min("start") AS "start", min("end") AS "end" FROM raw
  GROUP BY entity_id HAVING count(DISTINCT source) = 1 AND count(DISTINCT target) = 1 AND (min("end") IS NULL OR min("end") >= min("start")))"""


@query("WITH " + _ONE + _CHAINS[len(V.REPS):] + " SELECT chain_first AS source, entity_id AS target, 'positive' AS judgement FROM chains WHERE chain_size >= 2 AND entity_id <> chain_first")
def edge_dedupe(spark, d):
    none = spark.createDataFrame([], "entity_id string, canonical_id string")
    return E.dedupe_edges(E.edge_entities(V.representation_statements(spark, d)), none).select("source", "target", "judgement")


@query("""WITH t AS (SELECT 'rep-' || sha1(l_suppkey::VARCHAR || '|' || l_partkey::VARCHAR) AS id, strftime(l_shipdate, '%Y-%m-%d') AS s, CASE WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%Y-%m') ELSE strftime(l_shipdate + INTERVAL 10 DAY, '%Y-%m-%d') END AS e,
  CASE WHEN l_linenumber % 3 = 0 THEN last_day(l_shipdate) ELSE (l_shipdate + INTERVAL 10 DAY)::DATE END AS ed FROM lineitem),
  g AS (SELECT id, min(s) AS s, arg_max(e, (ed, e)) AS e, count(DISTINCT s) AS ns, count(DISTINCT e) AS ne FROM t GROUP BY id)
  SELECT id, s AS start_date, e AS end_date FROM g""")
def temporal_extent(spark, d):
    li = read_table(spark, d, "lineitem")
    end = F.when(F.col("l_linenumber") % 3 == 0, F.date_format("l_shipdate", "yyyy-MM")).otherwise(F.date_format(F.date_add(F.to_date("l_shipdate"), 10), "yyyy-MM-dd"))
    from_ = li.select(S.make_id("rep", "l_suppkey", "l_partkey").alias("entity_id"), F.lit("Representation").alias("schema"), F.lit("deals").alias("dataset"), F.array(F.struct(F.lit("startDate").alias("prop"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("value")), F.struct(F.lit("endDate").alias("prop"), end.alias("value"))).alias("props"))
    out = E.collapse_extent(N.assemble_entities(to_statements(from_, few=True)))
    return out.select("id", F.array_join(F.col("properties")["startDate"], "|").alias("start_date"), F.array_join(F.col("properties")["endDate"], "|").alias("end_date"))


# --- resolver and cross-references ------------------------------------------------------------------------------------------


@query("WITH " + V.PART_EDGES + " SELECT entity_id, canonical_id FROM linker WHERE n > 1")
def resolver_closure(spark, d):
    return resolver.linker(V.part_edges(spark, d))


@query("WITH " + V.PART_EDGES + " SELECT entity_id, canonical_id FROM linker WHERE n > 1")
def resolver_update(spark, d):
    """G-01 from changes: of four edges one is new, and one was live and positive before."""
    edges = staged(V.part_edges(spark, d).withColumn("k", F.pmod(F.xxhash64("target"), F.lit(4))), "edges")
    same = edges.drop("k")
    live = F.col("deleted_at").isNull() & (F.col("judgement") == "positive")
    before = edges.where("k > 0").withColumn("judgement", F.when(F.col("k") == 1, "positive").otherwise(F.col("judgement"))).withColumn("deleted_at", F.when(F.col("k") > 1, F.col("deleted_at")))
    store = fresh_path(spark, "linker")
    resolver.write_linker(resolver.linker(before.drop("k")), store)
    resolver.refresh_linker(spark, store, same, edges.where("k = 0").drop("k"), edges.where((F.col("k") == 1) & ~live).drop("k"))
    return resolver.read_linker(spark, store)


@query("WITH " + V.PART_EDGES + " SELECT source, target, judgement FROM edges WHERE judgement <> 'no_judgement'")
def resolver_prune(spark, d):
    return resolver.prune(V.part_edges(spark, d)).select("source", "target", "judgement")


@query("WITH " + V.PART_EDGES + """, hit AS (SELECT DISTINCT canonical_id FROM linker WHERE n > 1 AND entity_id LIKE 'Q%'), m AS (SELECT entity_id FROM linker WHERE n > 1 AND canonical_id IN (SELECT canonical_id FROM hit))
  SELECT source, target, judgement, deleted OR (source IN (SELECT entity_id FROM m) AND target IN (SELECT entity_id FROM m)) AS deleted FROM edges""")
def resolver_explode(spark, d):
    edges = V.part_edges(spark, d)
    link = staged(resolver.linker(edges), "linker")
    ids = link.where("entity_id like 'Q%'").select(F.col("entity_id").alias("id"))
    return resolver.explode(edges, link, ids).select("source", "target", "judgement", F.col("deleted_at").isNotNull().alias("deleted"))


@query("WITH " + V.PART_EDGES + """, g AS (SELECT p_brand, pid, first(pid) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS head, count(*) OVER (PARTITION BY p_brand) AS n FROM pid),
  k AS (SELECT g.*, coalesce(a.canonical_id, head) AS goal, coalesce(b.canonical_id, pid) AS own FROM g LEFT JOIN linker a ON a.entity_id = head LEFT JOIN linker b ON b.entity_id = pid WHERE g.n >= 2)
  SELECT DISTINCT goal AS source, pid AS target, 'positive' AS judgement FROM k WHERE own <> goal""")
def manual_merge(spark, d):
    p = read_table(spark, d, "part")
    k = F.col("p_size") % 7
    pid = F.concat(F.when(k == 0, "Q").when(k == 1, "NK-").otherwise("part-"), F.col("p_partkey").cast("string"))
    groups = p.select(F.col("p_brand").alias("group_id"), F.col("p_partkey").alias("position"), pid.alias("id"))
    return resolver.merge(V.part_edges(spark, d), groups).select("source", "target", "judgement")


_XREF = V.STMT + """, names AS (SELECT entity_id AS id, max(schema) AS schema, max(value) FILTER (prop = 'name') AS name, max(value) FILTER (prop = 'country') AS country FROM stmt WHERE dataset IN ('customers', 'suppliers') GROUP BY 1),
  tok AS (SELECT *, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(name), '[^a-z0-9]+'), lambda x: x <> ''))) AS ts FROM names),
  ex AS (SELECT id, t FROM (SELECT id, unnest(ts) AS t FROM tok) WHERE length(t) >= 3), tx AS (SELECT *, array_to_string(ts, ' ') AS txt FROM tok),
  neg AS (SELECT 'cust-' || sha1(s_suppkey::VARCHAR) AS l, 'supp-' || sha1(s_suppkey::VARCHAR) AS r FROM supplier WHERE s_suppkey % 3 = 0),
  pr AS (SELECT DISTINCT a.id AS l, b.id AS r FROM ex a JOIN ex b USING (t) WHERE a.id < b.id),
  sc AS (SELECT l, r, 0.5::DOUBLE * (len(list_intersect(a.ts, b.ts))::DOUBLE / len(list_distinct(list_concat(a.ts, b.ts)))) + 0.4::DOUBLE * (1::DOUBLE - levenshtein(a.txt, b.txt)::DOUBLE / greatest(length(a.txt), length(b.txt)))
  + 0.1::DOUBLE * CASE WHEN a.country = b.country THEN 1 ELSE 0 END AS score FROM pr ANTI JOIN neg USING (l, r) JOIN tx a ON a.id = l JOIN tx b ON b.id = r)"""


def _pair_rows(spark, d):
    return V.actor_statements(spark, d).where("dataset in ('customers', 'suppliers')").withColumn("canonical_id", F.col("entity_id"))


def _judged(spark, d):
    """A third of the customers and suppliers of one key differ."""
    s = read_table(spark, d, "supplier").where("s_suppkey % 3 = 0")
    return resolver.new_edges(s.select(S.make_id("cust", "s_suppkey").alias("source"), S.make_id("supp", "s_suppkey").alias("target")), "negative")


@query("WITH " + _XREF + """ SELECT l AS source, r AS target, CASE WHEN score >= 0.8 THEN 'positive' ELSE 'no_judgement' END AS judgement, round(score, 6) AS score FROM sc ORDER BY sc.score DESC, l || '::' || r LIMIT 50000""")
def xref_candidates(spark, d):
    """Customers and suppliers, whatever the frequency of their tokens."""
    return xref.xref(_pair_rows(spark, d), _judged(spark, d), limit=50000, threshold=0.8).select("source", "target", "judgement", F.round("score", 6).alias("score"))


_XREF_ALL = V.STMT + """, names AS (SELECT entity_id AS id, max(value) FILTER (prop = 'name') AS name, max(value) FILTER (prop = 'country') AS country FROM stmt WHERE dataset IN ('customers', 'suppliers', 'parts') GROUP BY 1),
  tok AS (SELECT *, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(name), '[^a-z0-9]+'), lambda x: x <> ''))) AS ts FROM names),
  ex AS (SELECT id, t FROM (SELECT id, unnest(ts) AS t FROM tok) WHERE length(t) >= 3), pr AS (SELECT DISTINCT a.id AS l, b.id AS r FROM ex a JOIN ex b USING (t) WHERE a.id < b.id),
  neg AS (SELECT 'cust-' || sha1(s_suppkey::VARCHAR) AS l, 'supp-' || sha1(s_suppkey::VARCHAR) AS r FROM supplier WHERE s_suppkey % 3 = 0),
  tx AS (SELECT *, array_to_string(ts, ' ') AS txt FROM tok),
  sc AS (SELECT l, r, 0.5::DOUBLE * (len(list_intersect(a.ts, b.ts))::DOUBLE / len(list_distinct(list_concat(a.ts, b.ts)))) + 0.4::DOUBLE * (1::DOUBLE - levenshtein(a.txt, b.txt)::DOUBLE / greatest(length(a.txt), length(b.txt)))
  + 0.1::DOUBLE * CASE WHEN a.country = b.country THEN 1 ELSE 0 END AS score FROM pr ANTI JOIN neg USING (l, r) JOIN tx a ON a.id = l JOIN tx b ON b.id = r)"""


@query("WITH " + _XREF_ALL + """ SELECT l AS source, r AS target, CASE WHEN score >= 0.8 THEN 'positive' ELSE 'no_judgement' END AS judgement, round(score, 6) AS score FROM sc ORDER BY sc.score DESC, l || '::' || r LIMIT 50000""")
def xref_all_candidates(spark, d):
    """Customers, suppliers and parts, whatever the frequency of their tokens; a third of the customers and suppliers of one key differ."""
    stmt = V.actor_statements(spark, d).where("dataset in ('customers', 'suppliers', 'parts')").withColumn("canonical_id", F.col("entity_id"))
    return xref.xref(stmt, _judged(spark, d), limit=50000, threshold=0.8).select("source", "target", "judgement", F.round("score", 6).alias("score"))


@query("WITH " + V.STMT + """, n AS (SELECT entity_id AS id, lower(value) AS name FROM stmt WHERE dataset = 'parts' AND prop = 'name')
  SELECT a.id AS source, b.id AS target, 1.0::DOUBLE AS score FROM n a JOIN n b ON a.name = b.name AND a.id < b.id""")
def xref_exact_names(spark, d):
    """X-03: the exact-name scorer over parts; all pairs of one name."""
    stmt = V.actor_statements(spark, d).where("dataset = 'parts'")
    out = xref.xref(stmt, resolver.new_edges(spark.createDataFrame([], "source string, target string"), "negative"), limit=None, threshold=1.0, algorithm="exact-name")
    return out.where("judgement = 'positive'").select("source", "target", "score")


_NEIGHBOURS = """, nb AS (SELECT lag(pid) OVER w AS a1, lag(pid, 2) OVER w AS a2, pid FROM pid WINDOW w AS (PARTITION BY p_name, p_brand ORDER BY p_partkey)),
  pairs AS (SELECT a1 AS l, pid AS r FROM nb WHERE a1 IS NOT NULL UNION ALL SELECT a2, pid FROM nb WHERE a2 IS NOT NULL), judged AS (SELECT source, target, judgement FROM edges WHERE NOT deleted AND judgement <> 'no_judgement'),
  c AS (SELECT l, r, a.canonical_id AS ca, b.canonical_id AS cb FROM pairs JOIN linker a ON a.entity_id = l JOIN linker b ON b.entity_id = r),
  apart AS (SELECT DISTINCT least(a.canonical_id, b.canonical_id) AS x, greatest(a.canonical_id, b.canonical_id) AS y FROM judged JOIN linker a ON a.entity_id = source JOIN linker b ON b.entity_id = target WHERE judgement = 'negative')"""


@query("WITH " + V.PART_EDGES + _NEIGHBOURS + """ SELECT l AS left_id, r AS right_id FROM c WHERE ca <> cb AND NOT EXISTS (SELECT 1 FROM judged WHERE least(source, target) = least(l, r) AND greatest(source, target) = greatest(l, r)) AND NOT EXISTS (SELECT 1 FROM apart WHERE x = least(ca, cb) AND y = greatest(ca, cb))""")
def decided_pairs(spark, d):
    """J-14: of parts next to each other in a chain, or with one between them, the pairs that nothing has decided."""
    edges = staged(V.part_edges(spark, d), "edges")
    p = read_table(spark, d, "part")
    k = F.col("p_size") % 7
    pid = F.concat(F.when(k == 0, "Q").when(k == 1, "NK-").otherwise("part-"), F.col("p_partkey").cast("string"))
    w = Window.partitionBy("p_name", "p_brand").orderBy("p_partkey")
    near = p.select(pid.alias("right_id"), F.lag(pid, 1).over(w).alias("one"), F.lag(pid, 2).over(w).alias("two")).select(F.explode(F.array("one", "two")).alias("left_id"), "right_id").where("left_id is not null")
    return resolver.prune_decided(near, edges, resolver.linker(edges))


@query("WITH " + V.STMT + """, n AS (SELECT entity_id AS id, lower(value) AS name FROM stmt WHERE dataset = 'parts' AND prop = 'name'), neg AS (SELECT 'part-' || sha1(p_partkey::VARCHAR) AS id FROM part WHERE p_partkey % 10 = 0)
  SELECT a.id AS source, b.id AS target, CASE WHEN a.id IN (SELECT id FROM neg) AND b.id IN (SELECT id FROM neg) THEN 'negative' ELSE 'no_judgement' END AS judgement, CASE WHEN a.id IN (SELECT id FROM neg) AND b.id IN (SELECT id FROM neg) THEN NULL ELSE 1.0::DOUBLE END AS score FROM n a JOIN n b ON a.name = b.name AND a.id < b.id""")
def candidate_store(spark, d):
    """G-02: parts of one name, crossed twice into one store; between the runs pairs of parts with keys that end in 0 are told apart, and scores are old ones."""
    stmt = staged(V.actor_statements(spark, d).where("dataset = 'parts'"), "statements")
    none = resolver.new_edges(spark.createDataFrame([], "source string, target string"), "negative")
    run = lambda edges, stored, judged=None: blocks.store_blocks(edges, stored, *xref.cross_names(stmt, edges, judged=judged), judged)
    edges, stored = run(none, spark.createDataFrame([], blocks.BLOCKS))
    old = lambda df, name: staged(df.withColumn("score", F.lit(0.5).cast("double")), name)
    edges, stored = old(edges, "edges"), old(stored, "blocks")
    tens = read_table(spark, d, "part").where("p_partkey % 10 = 0").select(S.make_id("part", "p_partkey").alias("id"))
    # Judgements are as many as pairs only where candidates are edges; of a block they are a block.
    told = edges.join(tens.select(F.col("id").alias("source")), "source", "left_semi").join(tens.select(F.col("id").alias("target")), "target", "left_semi").select("source", "target")
    edges = staged(edges.join(told, ["source", "target"], "left_anti").unionByName(resolver.new_edges(told, "negative")), "edges")
    judged = staged(stored.join(tens, "id", "left_semi").withColumn("judgement", F.lit("negative")).withColumn("score", F.lit(None).cast("double")), "judged")
    for _ in range(2):
        edges, stored = run(edges, stored, judged)
        stored = staged(stored, "blocks")
    edges = edges.unionByName(blocks.block_edges(judged, edges)).unionByName(blocks.block_edges(stored, edges, judged=judged))
    return edges.select("source", "target", "judgement", "score")


@query("WITH " + V.PART_EDGES + " SELECT least(source, target) || '::' || greatest(source, target) AS pair_key, score FROM edges WHERE judgement = 'no_judgement' AND NOT deleted ORDER BY score DESC, pair_key LIMIT 200")
def candidate_queue(spark, d):
    return xref.candidate_queue(V.part_edges(spark, d), 200).select("pair_key", "score")


# --- review ---------------------------------------------------------------------------------------------------------------


def _brand_edges(spark, d):
    """Candidates between suppliers that ship one part: every pair of neighbours by key."""
    li = read_table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    w = Window.partitionBy("l_partkey").orderBy("l_suppkey")
    rows = li.withColumn("other", F.lag("l_suppkey").over(w)).where("other is not null").groupBy("other", "l_suppkey").agg((F.sum("q") / 1000).alias("score"))
    return resolver.new_edges(rows.select(F.concat(F.lit("s"), F.lpad(F.col("other").cast("string"), 5, "0")).alias("source"), F.concat(F.lit("s"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("target"), F.round("score", 3).alias("score")), "no_judgement")


_BRAND = """li AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), nb AS (SELECT *, lag(l_suppkey) OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS other FROM li),
  be AS (SELECT 's' || lpad(other::VARCHAR, 5, '0') AS source, 's' || lpad(l_suppkey::VARCHAR, 5, '0') AS target, round(sum(q) / 1000, 3) AS score FROM nb WHERE other IS NOT NULL GROUP BY other, l_suppkey)"""


@query("WITH " + _BRAND + ", b AS (SELECT source AS m, score FROM be UNION ALL SELECT target, score FROM be) SELECT m AS member, max(score) AS score FROM b GROUP BY 1")
def best_scores(spark, d):
    return review.member_scores(review.best_scores(_brand_edges(spark, d)))


@query("WITH RECURSIVE " + _BRAND + """, q AS (SELECT source || '::' || target AS seed, source AS l, target AS r, score FROM be ORDER BY score DESC NULLS LAST, 1 LIMIT 200), ways AS (SELECT l AS a, r AS b, score FROM q UNION ALL SELECT r, l, score FROM q),
  cl AS (SELECT seed, [l, r] AS members, 0 AS step FROM q UNION ALL SELECT c.seed, list_append(c.members, arg_min(n.b, (-n.score, n.b))), c.step + 1 FROM cl c JOIN ways n ON list_contains(c.members, n.a) AND NOT list_contains(c.members, n.b) WHERE c.step < 6 GROUP BY c.seed, c.members, c.step),
  last AS (SELECT seed, arg_max(members, step) AS members FROM cl GROUP BY 1) SELECT seed, unnest(members) AS member, greatest(generate_subscripts(members, 1) - 2, 0)::INT AS step FROM last""")
def review_clusters(spark, d):
    pairs = review.best_scores(xref.candidate_queue(_brand_edges(spark, d), 200))
    return review.review_clusters(pairs)


def _tens(spark, d):
    return read_table(spark, d, "supplier").select(F.floor(F.col("s_suppkey") / 10).cast("string").alias("cluster_id"), F.concat(F.lit("s"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("member"))


_INSIDE = _BRAND + """, tens AS (SELECT (s_suppkey // 10)::VARCHAR AS cluster_id, 's' || lpad(s_suppkey::VARCHAR, 5, '0') AS member FROM supplier),
  pin AS (SELECT a.cluster_id, source || '::' || target AS pair_key, source AS left_id, target AS right_id, score FROM be JOIN tens a ON a.member = source JOIN tens b ON b.member = target AND a.cluster_id = b.cluster_id)"""


@query("WITH " + _INSIDE + " SELECT * FROM pin")
def pairs_in_clusters(spark, d):
    return review.pairs_in_clusters(_brand_edges(spark, d), _tens(spark, d))


@query("WITH " + _INSIDE + """, mem AS (SELECT cluster_id, count(*) AS n FROM tens GROUP BY 1) SELECT cluster_id, n AS n_members, count(*) AS n_pairs, max(score) AS best FROM pin JOIN mem USING (cluster_id) WHERE n >= 2 GROUP BY 1, 2""")
def cluster_payload(spark, d):
    clusters = _tens(spark, d)
    entities = clusters.select(F.col("member").alias("id"), F.col("member").alias("caption"), F.lit("Organization").alias("schema"))
    pairs = staged(review.pairs_in_clusters(_brand_edges(spark, d), clusters), "pairs")
    out = review.cluster_payload(clusters, entities, pairs)
    return out.select("cluster_id", F.size("members").cast("bigint").alias("n_members"), F.size("pairs").cast("bigint").alias("n_pairs"), F.array_max(F.transform("pairs", lambda p: p["score"])).alias("best"))


@query("""WITH l AS (SELECT ((user_id * 7 + event_id) % 40)::VARCHAR AS pair_key, (user_id % 4)::VARCHAR AS user_id, event_type, max(ts) AS t FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2, 3),
  held AS (SELECT pair_key FROM l WHERE event_type = 'view' AND user_id <> '1' AND t + INTERVAL 30 MINUTE > TIMESTAMP '2024-01-30 20:00:00' UNION SELECT pair_key FROM l WHERE event_type = 'click' AND user_id = '1' AND t + INTERVAL 120 MINUTE > TIMESTAMP '2024-01-30 20:00:00')
  SELECT p_partkey::VARCHAR AS pair_key FROM part WHERE p_partkey::VARCHAR NOT IN (SELECT pair_key FROM held)""")
def review_queue(spark, d):
    e = read_table(spark, d, "events").select(((F.col("user_id") * 7 + F.col("event_id")) % 40).cast("string").alias("pair_key"), (F.col("user_id") % 4).cast("string").alias("user_id"), "event_type", F.col("ts").alias("at"))
    leases, skips = review.lease_ends(e.where("event_type = 'view'"), 30), review.lease_ends(e.where("event_type = 'click'"), 120)
    return review.open_pairs(read_table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("pair_key")), leases, skips, "1", F.lit("2024-01-30 20:00:00").cast("timestamp"))


def _decisions(spark, d):
    ids = _tens(spark, d).groupBy("cluster_id").agg(F.sort_array(F.collect_list("member")).alias("ids"))
    n = F.col("cluster_id").cast("int")
    picked = F.when(n % 3 == 0, F.slice("ids", 1, 1)).when(n % 3 == 1, F.slice("ids", 1, 3)).otherwise(F.col("ids"))
    return ids.select(F.concat(F.lit("d"), "cluster_id").alias("decision_id"), "cluster_id", picked.alias("selected_ids"), F.when(n % 2 == 0, "negative").otherwise("positive").alias("judgement"), F.lit("u1").alias("user_id"))


_DECIDED = _INSIDE + """, dec AS (SELECT cluster_id, CASE cluster_id::INT % 3 WHEN 0 THEN list_sort(list(member))[1:1] WHEN 1 THEN list_sort(list(member))[1:3] ELSE list_sort(list(member)) END AS ids, CASE WHEN cluster_id::INT % 2 = 0 THEN 'negative' ELSE 'positive' END AS judgement FROM tens GROUP BY 1),
  hits AS (SELECT p.*, judgement FROM pin p JOIN dec USING (cluster_id) WHERE list_contains(ids, left_id) AND list_contains(ids, right_id))"""


@query("WITH " + _DECIDED + " SELECT left_id AS source, right_id AS target, judgement, 'u1' AS \"user\" FROM hits")
def apply_decisions(spark, d):
    return review.apply_decisions(staged(_brand_edges(spark, d), "edges"), _decisions(spark, d)).select("source", "target", "judgement", "user")


@query("WITH " + _BRAND + """, e AS (SELECT *, substr(source, 2)::INT % 4 AS k FROM be), joined AS (SELECT source, target FROM e WHERE k = 0), dec AS (SELECT source, target, CASE WHEN k = 1 THEN 'negative' ELSE 'unsure' END AS judgement FROM e WHERE k IN (1, 2))
  SELECT source, target, judgement, 'u1' AS "user" FROM dec""")
def decide_pairs(spark, d):
    """G-10 by pair: pairs that are joined or judged already (a source's number divided by four leaves 0 or 3) stay as they are."""
    e = staged(_brand_edges(spark, d), "edges").withColumn("k", F.substring("source", 2, 9).cast("int") % 4)
    done = resolver.new_edges(e.where("k = 3").select("source", "target"), "negative")
    asked = e.select(F.col("source").alias("left_id"), F.col("target").alias("right_id"), F.when(F.col("k") == 1, "negative").otherwise("unsure").alias("judgement"), F.lit("u1").alias("user_id"), "k").where("k <> 0").drop("k")
    return review.decide_pairs(e.drop("k").unionByName(done), asked).select("source", "target", "judgement", "user")


@query("WITH RECURSIVE " + _DECIDED + """, ways AS (SELECT cluster_id, left_id AS a, right_id AS b FROM hits UNION SELECT cluster_id, right_id, left_id FROM hits), reach AS (SELECT cluster_id, a AS start, a AS node FROM ways UNION SELECT r.cluster_id, r.start, b.b FROM reach r JOIN ways b ON b.cluster_id = r.cluster_id AND b.a = r.node),
  least AS (SELECT cluster_id, start, min(node) AS component FROM reach GROUP BY 1, 2), n AS (SELECT cluster_id, count(*) AS covered, count(DISTINCT component) AS groups FROM least GROUP BY 1)
  SELECT 'd' || cluster_id AS decision_id, judgement, CASE WHEN len(ids) < 2 THEN 'fewer than two selected' WHEN covered IS NULL THEN 'no shared pair' WHEN covered < len(ids) THEN 'an id without a pair' WHEN judgement = 'positive' AND groups > 1 THEN 'not connected' END AS reason FROM dec LEFT JOIN n USING (cluster_id)""")
def validate_decisions(spark, d):
    pairs = staged(review.pairs_in_clusters(_brand_edges(spark, d), _tens(spark, d)), "pairs")
    return review.validate_decisions(_decisions(spark, d), pairs).select("decision_id", "judgement", "reason")


@query("WITH " + V.STMT + """, n AS (SELECT entity_id AS id, min(value) FILTER (prop = 'name') AS caption, min(schema) AS schema FROM stmt GROUP BY 1), p AS (SELECT 'cust-' || sha1(s_suppkey::VARCHAR) AS l, CASE WHEN s_suppkey % 2 = 0 THEN 'supp-' ELSE 'gone-' END || sha1(s_suppkey::VARCHAR) AS r FROM supplier)
  SELECT l AS left_id, r AS right_id, a.caption AS left_caption, b.caption AS right_caption, 'profile' AS route FROM p JOIN n a ON a.id = l JOIN n b ON b.id = r""")
def pair_payload(spark, d):
    s = read_table(spark, d, "supplier")
    pairs = s.select(S.make_id("cust", "s_suppkey").alias("left_id"), S.make_id(F.when(F.col("s_suppkey") % 2 == 0, "supp").otherwise("gone"), "s_suppkey").alias("right_id"))
    return review.pair_payload(pairs, N.captions(V.actor_statements(spark, d))).select("left_id", "right_id", "left_caption", "right_caption", "route")


# --- composite names ------------------------------------------------------------------------------------------------------

#: A text without white space at its ends.
_TRIMMED = "trim(text, '" + "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "')"
_COMPLEX = f"length({_TRIMMED}) >= 20 AND regexp_matches(lower({_TRIMMED}), '[,;():]| and | & ')"


def _text_statements(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select(F.sha1(F.col("doc_id").cast("string")).alias("id"), F.concat(F.lit("doc-"), "doc_id").alias("entity_id"), F.lit("Company").alias("schema"), F.lit("name").alias("prop"), F.col("text").alias("value"), F.col("source").alias("dataset"))


@query(f"SELECT source AS dataset, 'doc-' || doc_id AS entity_id, sha1({_TRIMMED}) AS fingerprint FROM documents WHERE {_COMPLEX}")
def composite_fields(spark, d):
    return ner.ner_inputs(_text_statements(spark, d)).select("dataset", "entity_id", "fingerprint")


@query("""WITH s AS (SELECT doc_id, list_distinct(list_filter(list_transform(regexp_split_to_array(text, '[;,]'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: length(x) >= 3)) AS names FROM documents)
  SELECT doc_id, len(names)::INT AS n_names, sha1(array_to_string(list_sort(names), '|')) AS names_sha1 FROM s""")
def delimiter_split(spark, d):
    names = ner.split_names(F.col("text"))
    return read_table(spark, d, "documents").select("doc_id", F.size(names).alias("n_names"), F.sha1(F.array_join(F.sort_array(names), "|")).alias("names_sha1"))


@query(f"WITH c AS (SELECT source AS dataset, 'doc-' || doc_id AS entity_id, sha1({_TRIMMED}) AS fingerprint, lang FROM documents WHERE {_COMPLEX}) SELECT dataset, entity_id, fingerprint FROM c WHERE lang <> 'en'")
def skip_extracted(spark, d):
    inputs = ner.ner_inputs(_text_statements(spark, d))
    old = read_table(spark, d, "documents").where("lang = 'en'").select(F.col("source").alias("dataset"), F.concat(F.lit("doc-"), "doc_id").alias("entity_id"), F.lit("name").alias("property_name"), S.fingerprint(S.strip("text")).alias("fingerprint"), F.lit("delimiter").alias("extractor"), F.lit("1").alias("extractor_version"))
    return ner.skip_extracted(inputs, old, "delimiter", "1").select("dataset", "entity_id", "fingerprint")


@query(f"""SELECT source AS dataset, 'doc-' || doc_id AS entity_id, sha1({_TRIMMED}) AS fingerprint FROM documents WHERE {_COMPLEX} AND lang <> 'en' ORDER BY 1, 2, 3 LIMIT 25""")
def extraction_budget(spark, d):
    """L-07: what is stored already doesn't count."""
    old = ner.ner_inputs(_text_statements(spark, d).join(read_table(spark, d, "documents").where("lang = 'en'").select(F.concat(F.lit("doc-"), "doc_id").alias("entity_id")), "entity_id", "left_semi"))
    stored = old.withColumn("extractor", F.lit("delimiter")).withColumn("extractor_version", F.lit("1"))
    return ner.ner_inputs(_text_statements(spark, d), stored, limit=25).select("dataset", "entity_id", "fingerprint")


@query("WITH " + V.STMT + ", " + V.REPS + """, ap AS (SELECT DISTINCT p_name || ', ' || p_brand AS txt, p_name, p_brand FROM part WHERE p_name NOT LIKE 'blue%'),
  rp AS (SELECT 'part-' || sha1(p_partkey::VARCHAR) AS entity_id, p_name, p_brand FROM part WHERE p_name NOT LIKE 'blue%'),
  frag AS (SELECT entity_id, 'part-' || sha1(p_name) AS fid, p_name AS name FROM rp UNION ALL SELECT entity_id, 'part-' || sha1(p_brand), p_brand FROM rp),
  kept AS (SELECT entity_id, schema, prop, value, dataset FROM stmt WHERE entity_id NOT IN (SELECT entity_id FROM rp)),
  rs AS (SELECT DISTINCT entity_id, 'Representation' AS schema, prop, value, 'deals' AS dataset FROM (SELECT entity_id, 'id' AS prop, entity_id AS value FROM reps UNION ALL SELECT entity_id, 'agent', source FROM reps UNION ALL SELECT entity_id, 'client', target FROM reps UNION ALL SELECT entity_id, 'role', role FROM reps
    UNION ALL SELECT entity_id, 'startDate', "start"::VARCHAR FROM reps UNION ALL SELECT entity_id, 'endDate', "end"::VARCHAR FROM reps) WHERE value IS NOT NULL),
  rw AS (SELECT r.entity_id, r.schema, r.prop, coalesce(f.fid, r.value) AS value, r.dataset FROM rs r LEFT JOIN (SELECT DISTINCT entity_id, fid FROM frag) f ON r.prop IN ('agent', 'client') AND f.entity_id = r.value),
  made AS (SELECT DISTINCT fid AS entity_id, 'LegalEntity' AS schema, prop, value, 'parts' AS dataset FROM (SELECT fid, 'id' AS prop, fid AS value FROM frag UNION ALL SELECT fid, 'name', name FROM frag)),
  out AS (SELECT * FROM kept UNION ALL SELECT DISTINCT * FROM rw UNION ALL SELECT * FROM made)
  SELECT sha1(dataset || '|' || entity_id || '|' || prop || '|' || value) AS id, entity_id, schema, prop, value, dataset FROM out""")
def ner_apply(spark, d):
    stmt = SN.combine(V.actor_statements(spark, d), V.representation_statements(spark, d))
    return ner.apply_ner(stmt, V.part_candidates(spark, d)).select("id", "entity_id", "schema", "prop", "value", "dataset")


@query("""WITH p AS (SELECT 'part-' || sha1(p_name) AS pp, 'part-' || sha1(p_brand) AS cc, p_name, p_brand, p_name || ' at ' || p_brand AS role FROM part),
  e AS (SELECT *, 'part-' || sha1('Employment|{"employee":["$ref:p1"],"employer":["$ref:c1"],"role":["' || role || '"]}') AS ee FROM p),
  l AS (SELECT pp AS entity_id, 'Person' AS schema, unnest(['id', 'name']) AS prop, unnest([pp, p_name]) AS value FROM e UNION SELECT cc, 'Company', unnest(['id', 'name']), unnest([cc, p_brand]) FROM e
  UNION SELECT ee, 'Employment', unnest(['id', 'employee', 'employer', 'role']), unnest([ee, pp, cc, role]) FROM e)
  SELECT DISTINCT sha1('parts|' || entity_id || '|' || prop || '|' || value) AS id, entity_id, schema, prop, value FROM l""")
def ner_references(spark, d):
    """J-06, W-02: references between fragments, one that leads nowhere, and four candidates of each key, of which the newest approved one with an extraction counts."""
    p = read_table(spark, d, "part").select("p_name", "p_brand", F.concat_ws(", ", "p_name", "p_brand").alias("source_text")).distinct()
    part = lambda key, schema, props: F.struct(F.lit(key).alias("key"), F.lit(schema).alias("schema"), F.create_map(*[x for k, v in props.items() for x in (F.lit(k), F.array(v))]).alias("properties"))
    job = {"employee": F.lit("$ref:p1"), "employer": F.lit("$ref:c1"), "role": F.concat("p_name", F.lit(" at "), "p_brand")}
    new = F.array(part("p1", "Person", {"name": F.col("p_name")}), part("c1", "Company", {"name": F.col("p_brand")}), part("e1", "Employment", job), part("e2", "Employment", {"employee": F.lit("$ref:zz")})).cast(FRAGMENTS)
    old = F.array(part("p1", "Person", {"name": F.concat(F.lit("Old "), "p_name")})).cast(FRAGMENTS)
    made = p.select("source_text", F.explode(F.array(*[F.struct(F.lit(s).alias("status"), F.lit(f"2024-01-0{n}").alias("day"), x.alias("extraction")) for n, (s, x) in enumerate([("approved", old), ("approved", new), ("approved", F.lit(None).cast(FRAGMENTS)), ("rejected", old)], 1)])).alias("c"))
    cands = made.select(F.xxhash64("source_text", "c.day").alias("id"), F.lit("name").alias("property_name"), S.fingerprint("source_text").alias("fingerprint"), "c.status", "c.extraction", F.to_timestamp("c.day").alias("updated_at"))
    stmt = V.actor_statements(spark, d).where("dataset = 'parts'")
    return ner.apply_ner(stmt, cands).select("id", "entity_id", "schema", "prop", "value")


@query("""SELECT p_partkey, array_to_string(CASE p_partkey % 6 WHEN 0 THEN [] WHEN 1 THEN ['reference out of range', 'unknown schema'] WHEN 2 THEN ['unknown property'] WHEN 3 THEN ['unknown reference'] WHEN 4 THEN ['bad value'] ELSE ['reference out of range'] END, '|') AS reasons FROM part""")
def ner_validate(spark, d):
    k = F.col("p_partkey") % 6
    schema = F.when(k == 1, "Planet").otherwise("Person")
    one = F.struct(F.lit("p1").alias("key"), schema.alias("schema"), F.create_map(F.when(k == 2, "colour").otherwise("name"), F.array("p_name")).alias("properties"))
    ref = F.when(k == 3, "$ref:zz").when(k == 5, "$ref:c1").otherwise("$ref:p1")
    two = F.struct(F.lit("c1").alias("key"), F.lit("Company").alias("schema"), F.create_map(F.lit("website"), F.array(F.when(k == 4, "no address").otherwise("https://a.example/x"))).alias("properties"))
    three = F.struct(F.lit("e1").alias("key"), F.lit("Employment").alias("schema"), F.create_map(F.lit("employee"), F.array(ref)).alias("properties"))
    cands = read_table(spark, d, "part").select("p_partkey", F.array(one, two, three).alias("extraction"))
    return ner.validate_fragments(cands, "p_partkey").select("p_partkey", flat("reasons").alias("reasons"))


@query("""WITH k AS (SELECT DISTINCT sha1(p_name || ', ' || p_brand) AS fingerprint, p_name LIKE 'blue%' AS old FROM part) SELECT fingerprint, CASE WHEN old THEN 'rejected' ELSE 'pending' END AS status FROM k""")
def ner_store(spark, d):
    all_ = V.part_candidates(spark, d)
    return ner.store_candidates(all_.drop("status", "created_at", "updated_at", "reviewer", "reviewed_at", "id"), all_.where("status = 'rejected'")).select("fingerprint", "status")


@query("""WITH c AS (SELECT DISTINCT p_name AS id FROM part), n AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i FROM c), e AS (SELECT i, arg_max(event_type, (ts, event_id)) AS t, max(ts) AS ats, arg_max(user_id, (ts, event_id))::VARCHAR AS u FROM (SELECT *, user_id % 80 AS i FROM events) GROUP BY i)
  SELECT id, CASE WHEN t IS NULL OR t IN ('error', 'view') THEN 'pending' WHEN t IN ('purchase', 'signup') THEN 'approved' ELSE 'rejected' END AS status, CASE WHEN t IN ('purchase', 'signup', 'click') THEN u END AS reviewer FROM n LEFT JOIN e USING (i)""")
def ner_reviews(spark, d):
    n = read_table(spark, d, "part").select("p_name").distinct().withColumn("i", F.row_number().over(Window.orderBy("p_name")) - 1)  # one row a name: a few dozen
    none = lambda t: F.lit(None).cast(t)
    cands = n.select(F.col("p_name").alias("id"), "i", F.lit("pending").alias("status"), none("string").alias("reviewer"), none("timestamp").alias("reviewed_at"), none("timestamp").alias("updated_at"), none("string").alias("extraction"))
    e = read_table(spark, d, "events").select((F.col("user_id") % 80).alias("i"), "event_id", F.when(F.col("event_type").isin("error", "view"), "pending").when(F.col("event_type") == "click", "rejected").otherwise("approved").alias("status"), F.col("user_id").cast("string").alias("reviewer"), F.col("ts").alias("at"), none("string").alias("extraction"))
    events = e.join(n.select(F.col("p_name").alias("id"), "i"), "i")
    return ner.apply_reviews(cands, events).select("id", "status", "reviewer")


@query("""SELECT CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'approved' ELSE 'pending' END AS status, count(*) AS n FROM labels GROUP BY 1""")
def review_totals(spark, d):
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "approved").otherwise("pending")
    return ner.review_totals(read_table(spark, d, "labels").select(status.alias("status")))


@query("""WITH t AS (SELECT DISTINCT p_name, p_brand, p_name || ', ' || p_brand AS t FROM part), s AS (SELECT sha1(t) AS id, 9 AS b, length(p_name) AS n, length(p_brand) AS m, length(t) AS k FROM t),
  l AS (SELECT id, unnest([b, b + n + 2, b + k + 11, b + k + 11 + n + 2]) AS "start", unnest([n, m, n, m]) AS size FROM s) SELECT id, "start"::INT AS "start", ("start" + size)::INT AS "end" FROM l""")
def evidence_spans(spark, d):
    cands = V.part_candidates(spark, d).select(F.col("fingerprint").alias("id"), F.concat(F.lit("İ: About "), "source_text", F.lit(" and again "), F.upper("source_text")).alias("source_text"), "extraction")
    return ner.evidence_spans(cands)


@query("WITH c AS (SELECT DISTINCT p_name || ', ' || p_brand AS t FROM part) SELECT sha1(t) AS fingerprint FROM c WHERE t NOT LIKE 'blue%'")
def pending_extractions(spark, d):
    rows = V.part_candidates(spark, d).withColumn("id", F.col("fingerprint"))
    return ner.pending(rows, status="approved").select("fingerprint")


@query("""SELECT count(*) AS processed, count(*) FILTER (NOT ok) AS skipped, count(*) FILTER (ok) AS upserted, (SELECT count(*) FROM documents WHERE lang = 'en') AS cached FROM (SELECT len(list_filter(list_transform(regexp_split_to_array(text, '[;,]'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: length(x) >= 3)) > 0 AS ok FROM documents)""")
def extraction_counters(spark, d):
    docs = read_table(spark, d, "documents")
    inputs = docs.select(F.col("source").alias("dataset"), F.concat(F.lit("doc-"), "doc_id").alias("entity_id"), F.lit("name").alias("property_name"), S.fingerprint("text").alias("fingerprint"), F.col("text").alias("source_text"), "lang")
    return ner.extraction_counters(inputs, inputs.where("lang = 'en'"), ner.extract(inputs))


# --- search ---------------------------------------------------------------------------------------------------------------

_VIEW = ", view AS (SELECT canonical_id AS id, min(value) FILTER (prop = 'name') AS display_name, min(schema) AS schema, array_to_string(list_sort(list_distinct(list(value) FILTER (prop IN ('name', 'alias')))), ' ') AS names_text FROM canon GROUP BY 1)"


def _canon(spark, d):
    return N.canonicalise(V.actor_statements(spark, d), V.supplier_linker(spark, d))


@query("WITH " + V.CANON + _VIEW + " SELECT id, display_name, schema, names_text, len(list_filter(regexp_split_to_array(lower(names_text), '[^a-z0-9]+'), lambda x: x <> ''))::INT AS n_tokens FROM view")
def search_view(spark, d):
    return search.search_view(_canon(spark, d)).select("id", "display_name", "schema", "names_text", F.size("tokens").alias("n_tokens"))


@query("WITH " + V.CANON + """, hit AS (SELECT canonical_id AS id, min(schema) AS schema, max(value) FILTER (prop = 'name') AS name, max(CASE WHEN lower(value) = 'building' THEN 3 ELSE 0 END) AS exact_score FROM canon WHERE prop IN ('name', 'alias') AND contains(lower(value), 'building') AND schema IN ('Organization', 'Company', 'PublicBody') GROUP BY 1)
  SELECT id, schema, name, exact_score, (SELECT count(*) FROM hit) AS total, 10 + 20 < (SELECT count(*) FROM hit) AS has_next FROM hit ORDER BY exact_score DESC, coalesce(name, id), id LIMIT 20 OFFSET 10""")
def search_substring(spark, d):
    return search.search_substring(_canon(spark, d), "BUILDING", ["Organization"], 20, 10).select("id", "schema", "name", "exact_score", "total", "has_next")


def _grams(x: str) -> str:
    return f"list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


def _like(a: str, b: str) -> str:
    return f"CASE WHEN len(list_concat({a}, {b})) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


@query("WITH " + V.CANON + _VIEW + f""", g AS (SELECT *, list_filter(regexp_split_to_array(lower(names_text), '[^a-z0-9]+'), lambda x: x <> '') AS ts, {_grams("coalesce(display_name, '')")} AS dg, {_grams("names_text")} AS ng, {_grams("'red wigdet'")} AS qg FROM view),
  k AS (SELECT * FROM g WHERE len(list_intersect(ng, qg)) > 0 OR len(list_intersect(dg, qg)) > 0 OR contains(lower(names_text), 'red wigdet')),
  runs AS (SELECT id, qg, unnest(list_distinct(flatten(list_transform(range(1, len(ts) + 1), lambda i: [ts[i:i], ts[i:i + 1], ts[i:i + 2]])))) AS run FROM k),
  word AS (SELECT id, max({_like("qg", _grams("array_to_string(run, ' ')"))}) AS word FROM runs GROUP BY 1),
  hit AS (SELECT k.*, coalesce(word, 0) AS word, {_like("dg", "qg")} AS sim, len(list_intersect(ts, ['red', 'wigdet'])) AS found FROM k LEFT JOIN word USING (id)),
  fine AS (SELECT *, found::DOUBLE / greatest(len(ts), 1) AS rank, lower(coalesce(display_name, '')) AS low FROM hit WHERE found = 2 OR sim > 0.25 OR word > 0.55 OR contains(lower(names_text), 'red wigdet'))
  SELECT id, display_name, schema, (SELECT count(*) FROM fine) AS total FROM fine ORDER BY low = 'red wigdet' DESC, starts_with(low, 'red wigdet') DESC, rank DESC, greatest(sim, word) DESC, length(low), id LIMIT 50""")
def search_fuzzy(spark, d):
    return search.search_fuzzy(search.search_view(_canon(spark, d)), "red wigdet", limit=50).select("id", "display_name", "schema", "total")


def _changed_index(spark, d, *tables):
    """An index of these tables after a change: before it a tenth of the entities weren't there, a tenth had other names, nations had namesakes, and every other supplier wasn't merged yet."""
    stmt, link = staged(V.actor_statements(spark, d), "statements"), staged(V.supplier_linker(spark, d), "linker")
    kind, late = F.pmod(F.xxhash64("entity_id"), F.lit(10)), F.pmod(F.xxhash64("entity_id"), F.lit(2)) == 1
    other = F.when((kind == 1) & (F.col("prop") == "name"), F.concat(F.lit("former red widget "), "value")).otherwise(F.col("value"))
    gone = stmt.where("dataset = 'nations'").withColumn("entity_id", F.concat(F.lit("gone-"), "entity_id"))
    store = fresh_path(spark, "index")
    index.build(N.canonicalise(stmt.where(kind > 0).withColumn("value", other).unionByName(gone), link.where(~late)), store, tables=tables)
    ids = index.touched(stmt.where(kind <= 1).select("entity_id").unionByName(gone.select("entity_id")), link, link.where(late).select("entity_id", F.lit(None).cast("string").alias("before"), F.col("canonical_id").alias("after")))
    index.refresh(N.canonicalise(stmt, link), store, ids)
    return store


@query(SQL["assemble_entities"])
def index_entities(spark, d):
    """A-01 from changes only."""
    prop = lambda p: F.coalesce(F.array_join(F.col("properties")[p], "|"), F.lit(""))
    return index.read(spark, _changed_index(spark, d, "entities"), "entities").select("id", "schema", "caption", flat("datasets").alias("datasets"), prop("name").alias("names"), prop("country").alias("countries"))


@query(SQL["search_view"])
def index_view(spark, d):
    """A-02 from changes only."""
    return index.read(spark, _changed_index(spark, d, "view"), "view").select("id", "display_name", "schema", "names_text", F.size("tokens").alias("n_tokens"))


@query(SQL["search_substring"])
def index_substring(spark, d):
    """L-01 on the stored postings."""
    return index.search_substring(spark, _changed_index(spark, d, "names", "piece"), "BUILDING", ["Organization"], 20, 10).select("id", "schema", "name", "exact_score", "total", "has_next")


@query(SQL["search_fuzzy"])
def index_fuzzy(spark, d):
    """L-02 on the stored postings."""
    return index.search_fuzzy(spark, _changed_index(spark, d, "view", "word"), "red wigdet", limit=50).select("id", "display_name", "schema", "total")


@query("WITH " + V.CANON + _VIEW + " SELECT s AS schema, count(id) AS n FROM (SELECT unnest(['Company', 'Organization', 'PublicBody', 'Person']) AS s) LEFT JOIN view ON view.schema = s GROUP BY 1")
def actor_counts(spark, d):
    return search.actor_counts(search.search_view(_canon(spark, d)), ["Company", "Organization", "PublicBody", "Person"])


@query("WITH " + V.CANON + _VIEW + " SELECT id, '/profile/' || id AS path, (SELECT count(*) FROM view) AS total, 150 < (SELECT count(*) FROM view) AS has_next FROM view ORDER BY id LIMIT 100 OFFSET 50")
def sitemap(spark, d):
    return search.sitemap_page(search.search_view(_canon(spark, d)), limit=100, offset=50)


@query("""SELECT 'supp-' || sha1(s_suppkey::VARCHAR) AS id, array_to_string(list_filter(regexp_split_to_array(lower(s_name) || ' weissae og ii lodz', '[^a-z0-9]+'), lambda x: x <> ''), ' ') AS tokens FROM supplier""")
def search_accents(spark, d):
    """A-02: names with Latin letters beyond the first 256 are found by their plain letters."""
    marked = F.concat(F.translate("s_name", "eilopu", "ęįłőpů"), F.lit(" Weißæ Øğ İI Łódź"))
    rows = read_table(spark, d, "supplier").select(S.make_id("supp", "s_suppkey").alias("entity_id"), F.lit("Organization").alias("schema"), F.lit("suppliers").alias("dataset"), F.array(prop_struct("name", marked)).alias("props"))
    return search.search_view(to_statements(rows, unique=True)).select("id", F.array_join("tokens", " ").alias("tokens"))


@query("WITH " + V.STMT + " SELECT id, schema FROM stmt WHERE schema IN ('Organization', 'Company', 'PublicBody')")
def schema_filter(spark, d):
    return search.schema_filter(V.actor_statements(spark, d), ["Organization"]).select("id", "schema")


@query("SELECT unnest(['customers', 'nations', 'parts', 'planned', 'suppliers']) AS dataset")
def known_datasets(spark, d):
    dim = spark.createDataFrame([("customers",), ("planned",)], "name string")
    return search.known_datasets(dim, V.actor_statements(spark, d))


@query("""WITH l AS (SELECT 'ship-' || sha1(p_partkey::VARCHAR) AS e, p_size % 2 = 0 AS big, unnest(['id', 'name', 'flag']) AS prop, unnest(['id', 'text', 'country']) AS prop_type, unnest(['ship-' || sha1(p_partkey::VARCHAR), p_name, 'gb']) AS value FROM part)
  SELECT sha1('ships|' || e || '|' || prop || '|' || value) AS id, CASE WHEN big THEN 'Tanker' ELSE 'Vessel' END AS schema, prop, prop_type, value FROM l""")
def ontology_extension(spark, d):
    """X-04: two schemata and a property that the ontology lacks; a third of the rows has a schema outside them."""
    ships = ONTOLOGY.extend(tree=[("Vessel", "Entity"), ("Tanker", "Vessel")], props=[("Vessel", "flag", "country", None)])
    kind = F.when(F.col("p_size") % 2 == 0, "Tanker").otherwise("Vessel")
    rows = read_table(spark, d, "part").select(S.make_id("ship", "p_partkey").alias("entity_id"), kind.alias("schema"), F.lit("ships").alias("dataset"), F.array(prop_struct("name", F.col("p_name")), prop_struct("flag", F.lit("gb"))).alias("props"))
    stmt = to_statements(rows, ships, few=True).unionByName(V.actor_statements(spark, d))
    return search.schema_filter(stmt, ["Vessel"], ships).select("id", "schema", "prop", "prop_type", "value")


# --- writes ---------------------------------------------------------------------------------------------------------------


def _specs(spark, d):
    k = F.col("c_custkey") % 5
    items = F.array(F.concat(F.lit("name="), "c_name"), F.when(k == 1, "colour=red").when(k == 2, "nothing").otherwise("country= GB "))
    return read_table(spark, d, "customer").select(
        F.lit("Company").alias("schema_name"), F.lit("typed").alias("dataset"), F.lit("source-1").alias("source_ref"), F.when(k == 3, S.make_id("cust", "c_custkey")).alias("entity_id"), F.when(k == 4, F.array(F.col("c_custkey").cast("string"))).alias("id_parts"), F.lit(None).cast("string").alias("key_prefix"), items.alias("property_items")
    )


_SPECS = """specs AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 3 THEN 'cust-' || sha1(c_custkey::VARCHAR) WHEN 4 THEN 'typed-' || sha1('Company|' || c_custkey) WHEN 2 THEN 'typed-' || sha1('Company|typed|source-1') ELSE 'typed-' || sha1('Company|typed|source-1|' || c_name) END AS entity_id,
  CASE c_custkey % 5 WHEN 1 THEN 'unknown property' WHEN 2 THEN 'missing =' END AS reject, c_name FROM customer)"""


@query("WITH " + _SPECS + " SELECT entity_id, reject, count(*) AS n FROM specs GROUP BY 1, 2")
def entity_build(spark, d):
    return writes.build_entities(_specs(spark, d)).groupBy("entity_id", "reject").agg(F.count("*").alias("n"))


@query("WITH " + V.STMT + ", " + _SPECS + """, fine AS (SELECT * FROM specs WHERE reject IS NULL), kept AS (SELECT entity_id, prop, value, dataset FROM stmt WHERE entity_id NOT IN (SELECT entity_id FROM fine))
  SELECT entity_id, prop, value, dataset FROM kept UNION ALL SELECT entity_id, 'id', entity_id, 'typed' FROM fine UNION ALL SELECT entity_id, 'name', c_name, 'typed' FROM fine UNION ALL SELECT entity_id, 'country', 'GB', 'typed' FROM fine""")
def entity_upsert(spark, d):
    stmt, _ = writes.upsert_entities(V.actor_statements(spark, d), writes.build_entities(_specs(spark, d)))
    return stmt.select("entity_id", "prop", "value", "dataset")


@query("WITH " + V.STMT + ", " + _SPECS + " SELECT DISTINCT entity_id, CASE WHEN entity_id IN (SELECT entity_id FROM stmt) THEN 'updated' ELSE 'created' END AS action FROM specs WHERE reject IS NULL")
def entity_actions(spark, d):
    """E-02: what an upsert did to each entity."""
    return writes.upsert_entities(V.actor_statements(spark, d), writes.build_entities(_specs(spark, d)))[1]


@query("WITH c AS (SELECT 'cust-' || sha1((o_custkey % 200)::VARCHAR) AS entity_id, arg_max(o_orderpriority, o_orderkey) AS name FROM orders GROUP BY 1) SELECT entity_id, name FROM c")
def entity_last_spec(spark, d):
    """E-01, E-02: of hundreds of specs for one id the last by position counts."""
    specs = read_table(spark, d, "orders").select(
        F.lit("Company").alias("schema_name"), F.lit("typed").alias("dataset"), F.lit("s").alias("source_ref"), S.make_id("cust", F.col("o_custkey") % 200).alias("entity_id"), F.lit(None).cast("array<string>").alias("id_parts"), F.lit(None).cast("string").alias("key_prefix"),
        F.array(F.concat(F.lit("name="), "o_orderpriority")).alias("property_items"), F.col("o_orderkey").alias("position"),
    )
    stmt, _ = writes.upsert_entities(V.actor_statements(spark, d), writes.build_entities(specs))
    return stmt.where("dataset = 'typed' and prop = 'name'").select("entity_id", F.col("value").alias("name"))


@query("""WITH p AS (SELECT 'cust-' || sha1(o_custkey::VARCHAR) AS entity_id, arg_max(o_orderpriority, o_orderkey) AS alias FROM orders GROUP BY o_custkey) SELECT entity_id, c_name AS name, alias, 'customers' AS dataset, CASE WHEN c_name IS NULL THEN 'no such entity' END AS reject FROM p LEFT JOIN (SELECT 'cust-' || sha1(c_custkey::VARCHAR) AS entity_id, c_name FROM customer) USING (entity_id)""")
def entity_overlay(spark, d):
    stmt = staged(V.actor_statements(spark, d).where("dataset = 'customers'"), "customers")
    last = read_table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderpriority", "o_orderkey").alias("p"))
    patches = last.select(S.make_id("cust", "o_custkey").alias("entity_id"), F.lit(None).cast("string").alias("dataset"), F.lit(None).cast("string").alias("source_ref"), F.array(F.concat(F.lit("alias="), "p")).alias("property_items"))
    out = writes.update_entities(N.assemble_entities(stmt), stmt, patches)
    return out.select("entity_id", F.col("properties")["name"][0].alias("name"), F.array_join(F.col("properties")["alias"], "|").alias("alias"), "dataset", "reject")


# --- ledger and releases --------------------------------------------------------------------------------------------------


def _stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query("WITH " + V.LEDGER + """ SELECT id AS run_id, dataset_name, status, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, CASE WHEN status IN ('succeeded', 'failed') THEN strftime(last_final, '%Y-%m-%d %H:%M:%S') END AS finished_at,
  CASE WHEN status = 'failed' THEN stats END AS error_message, stats FROM runs""")
def run_ledger(spark, d):
    return releases.run_ledger(V.ledger_events(spark, d)).select("run_id", "dataset_name", "status", _stamp("started_at"), _stamp("finished_at"), "error_message", "stats")


def _runs(spark, d):
    return releases.run_ledger(V.ledger_events(spark, d)).withColumnRenamed("run_id", "id")


@query("WITH " + V.LEDGER + " SELECT dataset_name, arg_max(id, (started_at, id)) AS id, strftime(max(started_at), '%Y-%m-%d %H:%M:%S') AS started_at FROM runs WHERE status = 'succeeded' GROUP BY 1")
def latest_run(spark, d):
    return releases.latest_runs(_runs(spark, d)).select("dataset_name", "id", _stamp("started_at"))


def _artifacts(spark, d):
    e = V.ledger_events(spark, d)
    kind = F.when(F.col("event_id") % 2 == 0, "statements_pack").otherwise("log")
    return e.select(F.col("event_id").alias("id"), F.col("run_id").alias("dataset_run_id"), kind.alias("artifact_type"), F.concat(F.lit("k/"), "event_id").alias("storage_key"))


@query("WITH " + V.LEDGER + """, art AS (SELECT event_id AS id, run_id, CASE WHEN event_id % 2 = 0 THEN 'statements_pack' ELSE 'log' END AS kind FROM ledger)
  SELECT dataset_name, arg_max(art.run_id, (started_at, art.run_id, art.id)) AS dataset_run_id, arg_max(art.id, (started_at, art.run_id, art.id)) AS artifact_id, 'k/' || arg_max(art.id, (started_at, art.run_id, art.id)) AS storage_key FROM art JOIN runs ON runs.id = art.run_id WHERE kind = 'statements_pack' AND status = 'succeeded' GROUP BY 1""")
def latest_artifact(spark, d):
    return releases.latest_artifacts(_runs(spark, d), _artifacts(spark, d))


@query("WITH " + V.LEDGER + " SELECT run_id AS dataset_run_id, CASE WHEN event_id % 2 = 0 THEN 'statements_pack' ELSE 'log' END AS artifact_type, max(event_id) AS id FROM ledger GROUP BY 1, 2")
def artifacts_by_type(spark, d):
    return releases.latest_per_type(_artifacts(spark, d)).select("dataset_run_id", "artifact_type", "id")


def _release_events(spark, d):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "published").when(F.col("event_type") == "signup", "built").otherwise("building")
    return read_table(spark, d, "events").select("event_id", F.col("user_id").alias("release_id"), status.alias("status"), F.col("ts").alias("at"))


_RELEASE = """rel AS (SELECT user_id AS id, arg_max(CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'published' WHEN 'signup' THEN 'built' ELSE 'building' END, (ts, event_id)) AS status, max(ts) FILTER (event_type = 'purchase') AS p FROM events GROUP BY 1),
  newest AS (SELECT max((p, id)) AS m FROM rel WHERE status = 'published')"""


@query("WITH " + _RELEASE + " SELECT id, CASE WHEN status = 'published' AND (p, id) < (SELECT m FROM newest) THEN 'superseded' ELSE status END AS status FROM rel")
def release_status(spark, d):
    return releases.release_status(_release_events(spark, d)).select("id", "status")


@query("WITH " + _RELEASE + " SELECT id FROM rel ORDER BY id DESC LIMIT 20")
def recent_releases(spark, d):
    return releases.recent_releases(releases.release_status(_release_events(spark, d))).select("id")


@query("WITH " + V.STMT + """, rp AS (SELECT 'part-' || sha1(p_partkey::VARCHAR) AS entity_id, p_name, p_brand FROM part WHERE p_name NOT LIKE 'blue%'), frag AS (SELECT 'part-' || sha1(p_name) AS fid, p_name AS name FROM rp UNION SELECT 'part-' || sha1(p_brand), p_brand FROM rp),
  o AS (SELECT dataset, count(*) AS n FROM stmt WHERE entity_id NOT IN (SELECT entity_id FROM rp) GROUP BY 1 UNION ALL SELECT 'parts', 2 * count(*) FROM frag) SELECT dataset, sum(n)::BIGINT AS n_statements FROM o GROUP BY 1""")
def release_build(spark, d):
    """Snapshots, a release of all datasets after replacements, publishing; then the published statements by dataset."""
    root, runs, arts = _snapshots(spark, d)
    releases.build_release(spark, root, runs, arts, V.part_candidates(spark, d), _DATASETS, "1")
    link = V.supplier_linker(spark, d)
    edges = resolver.new_edges(link.select(F.col("canonical_id").alias("source"), F.col("entity_id").alias("target")), "positive")
    paths = releases.publish(spark, root, "1", edges, f"{root}/published", f"{root}/working")
    return spark.read.parquet(paths["statements"]).groupBy("dataset").agg(F.count("*").alias("n_statements"))


_DATASETS = ["customers", "suppliers", "nations", "parts"]


def _snapshots(spark, d):
    """A store with one succeeded run of each dataset, and its ledger."""
    root, stmt = fresh_path(spark, "release"), staged(V.actor_statements(spark, d), "statements")
    for i, name in enumerate(_DATASETS):
        SN.write_snapshot(stmt.where(F.col("dataset") == name), root, name, f"r{i}")
    runs = spark.createDataFrame([(f"r{i}", n, "succeeded") for i, n in enumerate(_DATASETS)] + [("r9", "parts", "failed")], "id string, dataset_name string, status string").withColumn("started_at", F.lit("2024-01-01").cast("timestamp"))
    return root, runs, spark.createDataFrame([(i, f"r{i}", "statements_pack", f"k{i}") for i in range(4)], "id long, dataset_run_id string, artifact_type string, storage_key string")


@query("WITH " + V.STMT + """, n AS (SELECT count(*) AS n FROM stmt WHERE dataset = 'customers') SELECT unnest(['1', '2', '3']) AS release_id, unnest(['superseded', 'published', 'built']) AS status, unnest([false, true, false]) AS held, unnest([NULL, (SELECT n FROM n), NULL]) AS n_statements""")
def release_publish(spark, d):
    """R-03, R-04: two releases are published, one after the other, a third is built only; their statuses by the ledger, and what the target holds."""
    root, runs, arts = _snapshots(spark, d)
    none = resolver.new_edges(spark.createDataFrame([], "source string, target string"), "positive")
    for release, names in (("1", ["suppliers", "nations"]), ("2", ["customers"]), ("3", ["nations"])):
        releases.build_release(spark, root, runs, arts, V.part_candidates(spark, d).limit(0), names, release)
        if release != "3":
            releases.publish(spark, root, release, none, f"{root}/published", f"{root}/working")
    now = releases.published(spark, f"{root}/published")
    held = spark.read.parquet(now["paths"]["statements"]).agg(F.count("*").alias("n_statements")).withColumn("id", F.lit(now["release"]))
    out = releases.release_status(releases.release_events(spark, root)).join(held, "id", "left")
    return out.select(F.col("id").alias("release_id"), "status", F.col("n_statements").isNotNull().alias("held"), "n_statements")


@query("""SELECT '1' AS release_id, 'built' AS status, 'suppliers' AS inputs, (SELECT 3 * count(*) FROM supplier) AS n_statements UNION ALL SELECT '2', 'failed', NULL, NULL""")
def release_records(spark, d):
    """R-02: what builds leave in the store: one that succeeds, with inputs and manifest, and one that fails, whose statements are gone."""
    root, stmt = fresh_path(spark, "release"), V.actor_statements(spark, d).where("dataset = 'suppliers'")
    runs = spark.createDataFrame([("r1", "suppliers", "succeeded"), ("r2", "parts", "failed")], "id string, dataset_name string, status string").withColumn("started_at", F.lit("2024-01-01").cast("timestamp"))
    arts = spark.createDataFrame([(1, "r1", "statements_pack", "a"), (2, "r2", "statements_pack", "b")], "id long, dataset_run_id string, artifact_type string, storage_key string")
    SN.write_snapshot(stmt, root, "suppliers", "r1")
    _, inputs, manifest = releases.build_release(spark, root, runs, arts, V.part_candidates(spark, d), ["suppliers"], "1")
    try:
        releases.build_release(spark, root, runs, arts, V.part_candidates(spark, d), ["suppliers", "parts"], "2")
    except ValueError:
        pass  # parts have no succeeded run; the record says so
    about = inputs.select(F.lit("1").alias("id"), F.col("dataset_name").alias("inputs")).join(manifest.select("n_statements"), F.lit(True))
    return releases.release_status(releases.release_events(spark, root)).join(about, "id", "left").select(F.col("id").alias("release_id"), "status", "inputs", "n_statements")


def minimum_slice(spark: SparkSession, d: str) -> DataFrame:
    """Statements, canonical ids, entities, and a page of a search with their captions."""
    stmt = _canon(spark, d)
    page = search.search_substring(stmt, "supplier", ["LegalEntity"], 50)
    return page.join(N.captions(stmt).select("id", "caption"), "id").select("id", "schema", "caption", "exact_score", "total", "has_next")


QUERIES["search_page"] = minimum_slice
SQL["search_page"] = (
    "WITH " + V.CANON + """, hit AS (SELECT canonical_id AS id, min(schema) AS schema, max(value) FILTER (prop = 'name') AS name FROM canon WHERE prop IN ('name', 'alias') AND contains(lower(value), 'supplier') GROUP BY 1),
  cap AS (SELECT canonical_id AS id, min(value) FILTER (prop = 'name') AS caption FROM canon GROUP BY 1)
  SELECT id, schema, caption, 0 AS exact_score, (SELECT count(*) FROM hit) AS total, 50 < (SELECT count(*) FROM hit) AS has_next FROM (SELECT * FROM hit ORDER BY name, id LIMIT 50) JOIN cap USING (id)"""
)
