"""What lies on disk at a time, and what travels."""

import re
from collections import Counter
from pathlib import Path

from oracle import SMALL
from pyspark.sql import functions as F
from test_round3 import same_rows

from ledgerloom.functions.scalars import packed, unpacked
from ledgerloom.operators import edges as E
from ledgerloom.operators import ner
from ledgerloom.plans import shared
from ledgerloom.plans import views as V
from ledgerloom.plans.model import conform, statement_id


def shuffled(spark):
    """Bytes of shuffle files that are there."""
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for d in root for f in Path(d).rglob("shuffle_*.data"))


def test_ids_are_packed_and_back(spark):
    odd = ["cust-" + "0a" * 20, "Cust-é-" + "f" * 40, "f" * 40, "f" * 39, "x" + "F" * 40, "part-" + "0" * 39 + "g", "", "é", "\0", "\1" + "a" * 40, "a" * 40 + "\n", "Q7", None]
    rows = spark.createDataFrame([(v,) for v in odd], "v string").select("v", packed("v").alias("p"))
    got = rows.select("v", unpacked("p").alias("u"), "p").collect()
    assert [r.u for r in got] == odd and len({bytes(r.p) for r in got if r.p is not None}) == len(odd) - 1
    assert len(got[0].p) == 26


def test_shuffles_go_with_what_is_staged(spark):
    before = shuffled(spark)
    shared.staged(V.representation_statements(spark, SMALL).groupBy("value").count(), "counted").count()
    assert shuffled(spark) <= before + 10_000


def test_representations_are_dealt_as_numbers(spark):
    """One shuffle to the statements of an entity, of the line items' columns, and the grouping by entity needs none."""
    plan = E.edge_entities(V.representation_statements(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "props" not in plan[plan.index("Exchange hash") :]


def test_edge_dedupe_packs_what_travels(spark):
    """Rows as before with ids of any form, and no id's text in the chains' shuffle."""
    assert len(same_rows(spark, Path(SMALL), "edge_dedupe")) > 100
    ids = V.representations(spark, SMALL).withColumn("entity_id", F.when(F.crc32("entity_id") % 2 == 0, F.concat(F.lit("E"), F.crc32("entity_id"))).otherwise(F.col("entity_id")))
    rows = lambda hot: sorted(map(tuple, E.edge_chains(ids, hot_rows=hot).select("entity_id", "source", "target", "role", "chain_size", "chain_first").collect()), key=str)
    assert rows(1_000_000) == rows(0)
    plan = E.edge_chains(ids)._jdf.queryExecution().executedPlan().toString()
    assert "unhex" in plan[plan.index("Exchange hash") :]


def test_what_follows_from_a_row_is_not_staged(spark):
    """Statements come back as they were, odd ones too; of a marker only the entity's id is written."""
    rows = [("e1", "e1", "id", "e1", "d", None), ("e1", "c1", "name", "Acme", "d", None), ("e1", None, "name", None, None, "own"), ("e2", "e2", "alias", "e2", "d", "x"), ("e3", "e3", "id", "e4", "d", None), (None, None, "name", "v", "d", None)]
    stmt = conform(spark.createDataFrame(rows, "entity_id string, canonical_id string, prop string, value string, dataset string, id string"))
    stmt = stmt.withColumn("id", F.when(F.col("id").isNull(), statement_id()).otherwise(F.col("id")))
    out = ner.staged_statements(stmt)
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, stmt.collect())) and out.columns == stmt.columns
    held = spark.read.parquet(*out.inputFiles())
    assert [r.n for r in held.where("entity_id = 'e1' and prop = 'id'").selectExpr("id is null and canonical_id is null and value is null as n").collect()] == [True]
