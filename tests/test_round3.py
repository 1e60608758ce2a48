"""Cases of the third round's findings."""

from collections import Counter

import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ledgerloom.functions import scalars as S
from ledgerloom.operators import edges as E
from ledgerloom.operators import entities as N
from ledgerloom.operators import index, ner, writes, xref
from ledgerloom.plans import shared
from ledgerloom.plans import views as V
from ledgerloom.plans.model import FRAGMENTS, to_statements


def same_rows(spark, folder, query):
    """The rows of a query over tables in a folder, which must be its SQL's."""
    c = oracle.duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in oracle.TABLES:
        if (folder / f"{t}.parquet").exists():
            c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    got = Counter(oracle.rows(__spark_entry__.queries()[query](spark, str(folder)).toPandas()))
    assert got == Counter(oracle.rows(c.execute(__spark_entry__.oracle_sql()[query]).df()))
    return got


def test_headings_that_end_in_a_reference_without_semicolon(spark, tmp_path):
    heads = ["Plain", "One &amp;&amp", "Two &ampc", "Three &am", "Four &amp;lt &lt;b&gt x &quot"]
    rows = [(i, f"https://a.example/{i}", f"<html><h1>{h}</h1></html>") for i, h in enumerate(heads)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "p"))
    next((tmp_path / "p").glob("*.parquet")).rename(tmp_path / "pages.parquet")
    got = same_rows(spark, tmp_path, "pages_extract")
    assert {r[4] for r in got if r[2] == "name" and r[3] == "Organization"} == {"Plain", "One &&", "Two &c", "Three &am", 'Four &lt <b> x "'}


def moves(df):
    """The shuffles by key in a plan."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_few_rows_an_entity_travel_once(spark):
    stmt = V.representation_statements(spark, oracle.SMALL)
    assert moves(stmt) == 1
    assert moves(E.edge_entities(stmt)) == 1
    assert moves(N.assemble_entities(stmt)) == 1
    rows = spark.createDataFrame([("a", [("name", "x"), ("role", "r")]), ("a", [("name", "x"), ("role", "s")]), (None, [("name", "x")])], "entity_id string, props array<struct<prop:string,value:string>>")
    rows = rows.withColumn("schema", F.lit("Person")).withColumn("dataset", F.lit("d"))
    of = lambda df: sorted(tuple(r) for r in df.select("id", "prop", "value").collect())
    assert of(to_statements(rows, few=True)) == of(to_statements(rows)) and len(of(to_statements(rows))) == 4


def test_partitions_of_dealt_rows_grow_with_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(shared, "UNFOLDED_BYTES", 100)
    assert shared.dealt(table, "id").rdd.getNumPartitions() > 8  # the session has 4


def test_extent_travels_once(spark):
    assert moves(__spark_entry__.queries()["temporal_extent"](spark, oracle.SMALL)) == 1


def test_references_of_an_entity_travel_once(spark):
    refs = spark.createDataFrame([("a", "p", "r1", "c", "s"), ("a", "q", "r2", "c", "s")], "id string, prop string, ref string, ref_caption string, ref_schema string")
    entities = spark.createDataFrame([("a",), ("b",)], "id string")
    out = N.with_references(entities, refs)
    # The entities' own shuffle for the join, or none where they are broadcast, and one of the references (a repartition and its grouping by property before).
    assert "hashpartitioning(id" in (plan := out._jdf.queryExecution().executedPlan().toString()) and ", prop#" not in "".join(x for x in plan.split("\n") if "Exchange hashpartitioning" in x)
    assert {r.id: r.references and sorted(r.references) for r in out.collect()} == {"a": ["p", "q"], "b": None}


def test_names_replaced_without_writing_what_follows_from_a_row(spark, monkeypatch):
    written = {}

    def kept(df, name, path=None):
        written[name] = df
        return shared.staged(df, name, path)

    monkeypatch.setattr(ner, "staged", kept)
    # x-1 and x-2 have one fragment in common; y-1 points at both by one property, so the clone is one statement.
    rows = [("x-1", "Company", "d", [("name", "Ada, Bob")]), ("x-2", "Company", "d", [("name", "Ada, Cid")]), ("y-1", "Representation", "d", [("agent", "x-1"), ("agent", "x-2"), ("client", "z-1")]), ("z-1", "Company", "d", [("name", "Zed")])]
    stmt = to_statements(spark.createDataFrame(rows, "entity_id string, schema string, dataset string, props array<struct<prop:string,value:string>>"))
    stmt = stmt.withColumn("id", F.when(F.col("value") == "Zed", "own").otherwise(F.col("id")))
    cands = spark.createDataFrame([("Ada, Bob",), ("Ada, Cid",)], "t string")
    cands = cands.select(F.xxhash64("t").alias("id"), F.lit("name").alias("property_name"), S.fingerprint("t").alias("fingerprint"), F.lit("approved").alias("status"), ner.split_entities(F.col("t")).cast(FRAGMENTS).alias("extraction"), F.current_timestamp().alias("updated_at"))
    out = ner.apply_ner(stmt, cands).collect()
    named = {r.entity_id: r.value for r in out if r.prop == "name"}
    assert sorted(named.values()) == ["Ada", "Bob", "Cid", "Zed"] and not [r for r in out if r.entity_id in ("x-1", "x-2")]
    assert sorted(named[r.value] for r in out if r.prop == "agent") == ["Ada", "Bob", "Cid"] and [r.value for r in out if r.prop == "client"] == ["z-1"]
    assert len({r.id for r in out}) == len(out) and [r.id for r in out if r.value == "Zed"] == ["own"]
    assert written["statements"].where("id is not null").count() == 1


def test_ties_of_one_name_are_cut_by_pair_key(spark):
    """Hundreds of entities of one name give the first pairs by key, not all their pairs."""
    rows = [(f"e{(i * 37) % 401:03}", "Company", "Acme Widgets", "gb" if i % 40 == 0 else None, ["d"]) for i in range(400)]
    entities_ = spark.createDataFrame(rows, "id string, schema string, name string, country string, datasets array<string>")
    undecided = lambda p: p.where("left_id > 'e003'")
    scored = undecided(xref.score_pairs(xref.block_pairs(entities_)).select("left_id", "right_id", "score")).collect()
    order = lambda rs: sorted((-round(x.score, 9), x.left_id, x.right_id) for x in rs)
    for limit in (20, 60):  # within the pairs of one country, and beyond them
        got = xref.best_pairs(entities_, limit, undecided).collect()
        assert order(got)[:limit] == order(scored)[:limit]
        assert len(got) < 3000 < len(scored)


def test_dates_are_parsed_once_for_each_text(spark):
    """what follows from a few values is worked out for these, nulls among them, and no row is lost or repeated."""
    seen = spark.sparkContext.accumulator(0)

    def slow(x):
        seen.add(1)
        return None if x is None else x * 2

    rows = spark.range(1000).withColumn("k", F.when(F.col("id") % 4 > 0, F.col("id") % 4))
    got = shared.once(rows, ["k"], F.udf(slow, "long")("k").alias("twice")).collect()
    assert sorted((r.id, r.k, r.twice) for r in got) == [(i, i % 4 or None, i % 4 * 2 or None) for i in range(1000)]
    assert seen.value == 4
    for q in ("dates_ranges", "dates_parse", "dates_day_or_month"):  # no row travels by key where values are few
        assert moves(__spark_entry__.queries()[q](spark, oracle.SMALL)) == 0


def test_index_holds_what_it_is_asked_for(spark, tmp_path, monkeypatch):
    """tables that a search doesn't need aren't made, before or after a change; a gram's ids are dealt to several files."""
    monkeypatch.setattr(index, "DEAL_ROWS", 10)
    rows = [(f"e{i:02}", [("name", f"Red Widgets {i}")]) for i in range(40)]
    rows = spark.createDataFrame(rows, "entity_id string, props array<struct<prop:string,value:string>>")
    stmt = to_statements(rows.withColumn("schema", F.lit("Company")).withColumn("dataset", F.lit("d")), unique=True)
    few, whole = str(tmp_path / "few"), str(tmp_path / "whole")
    index.build(stmt, few, parts=2, tables=("view", "word"))
    index.build(stmt, whole, parts=2)
    for store in (few, whole):
        index.refresh(stmt.where("entity_id <> 'e07'"), store, spark.createDataFrame([("e07",)], "id string"))
    assert {p.name for p in (tmp_path / "few" / "segments").glob("*/*")} == {"view", "postings", "touched"}
    assert {p.parent.name for p in (tmp_path / "few" / "segments").glob("*/postings/*/part=*")} == {"kind=word"}
    assert len(list((tmp_path / "few" / "segments").glob("*/postings/kind=word/part=0/*.parquet"))) > 2
    hits = [[r.id for r in index.search_fuzzy(spark, s, "red wigdets", limit=100).collect()] for s in (few, whole)]
    assert hits[0] == hits[1] and len(hits[0]) == 39 and "e07" not in hits[0]
    with pytest.raises(ValueError):
        index.build(stmt, str(tmp_path / "bad"), tables=("word",))


def test_small_rows_that_unfold_are_not_put_together(spark):
    """Adaptive execution has no say in how many partitions dealt rows have."""
    assert shared.dealt(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["people_statements", "ontology_extension", "assemble_entities"])
def test_statements_are_not_shuffled_after_they_are_unfolded(spark, name):
    """rows are dealt before that; aggregations need no shuffle of their own, whose partitions wouldn't grow with the input."""
    plan = __spark_entry__.queries()[name](spark, oracle.SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_specs_of_one_file_are_many_tasks(spark):
    """specs are dealt before they are parsed; of one id the last accepted one counts, also where a rejected one comes later."""
    row = lambda at, item: ("Company", "d", "s", "x-1", None, None, [item], at)
    specs = spark.createDataFrame([row(1, "name=A"), row(2, "name=B"), row(3, "colour=red"), row(4, "nothing")], writes.SPEC + ", position long").coalesce(1)
    built = writes.build_entities(specs)
    assert built.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert sorted((r.position, r.reject) for r in built.collect()) == [(1, None), (2, None), (3, "unknown property"), (4, "missing =")]
    stmt, actions = writes.upsert_entities(writes.entity_statements(built.limit(0)), built)
    assert [(r.entity_id, r.action) for r in actions.collect()] == [("x-1", "created")]
    assert [r.value for r in stmt.where("prop = 'name'").collect()] == ["B"]
