"""Candidates of one name as blocks, and references at size."""

from collections import Counter
from datetime import datetime

from oracle import SMALL
from test_operators import props, statements
from test_round3 import same_rows

from ledgerloom.operators import blocks, resolver, xref
from ledgerloom.plans import catalog
from ledgerloom.plans.model import EDGES


def part_table(spark, folder, names):
    rows = [(i, n, f"Brand#{i % 2}" if n == "two" else "Brand#1", "SMALL", i % 50) for i, n in enumerate(names)]
    write(spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"), folder, "part")
    write(spark.createDataFrame([(0, 0, "Supplier")], "s_suppkey long, s_nationkey int, s_name string"), folder, "supplier")
    write(spark.createDataFrame([(0, "Customer", 0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"), folder, "customer")
    write(spark.createDataFrame([(0, "FRANCE")], "n_nationkey int, n_name string"), folder, "nation")


def write(df, folder, name):
    df.coalesce(1).write.parquet(str(folder / f"{name}-files"))
    next((folder / f"{name}-files").glob("*.parquet")).rename(folder / f"{name}.parquet")


def test_candidate_store_writes_no_pairs(spark, tmp_path, monkeypatch):
    """What is staged grows with the parts and the judged pairs, not with the pairs of one name."""
    part_table(spark, tmp_path, ["one"] * 150 + ["two"] * 30 + ["three"])
    sizes, inner = [], catalog.staged
    counted = lambda df, *a: sizes.append((out := inner(df, *a)).count()) or out
    for module in (catalog, xref, resolver, blocks):
        monkeypatch.setattr(module, "staged", counted)
    got = same_rows(spark, tmp_path, "candidate_store")
    assert len(got) == 150 * 149 // 2 + 2 * 15 * 14 // 2 and sum(r[0] == "negative" for r in got) == 15 * 14 // 2 + 3
    assert max(sizes) <= 4 * 181 + 200


def test_pairs_of_one_name_do_not_travel(spark, tmp_path):
    part_table(spark, tmp_path, ["one"] * 60)
    assert len(same_rows(spark, tmp_path, "xref_exact_names")) == 60 * 59 // 2
    df = catalog.QUERIES["xref_exact_names"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1]
    assert plan.index("Join") < plan.index("Exchange")  # from the top: all exchanges lie below the join that makes the pairs


def test_blocks_meet_in_chunks(spark):
    rows = [("n", f"i{k:02}", "no_judgement", 1.0, "u", datetime(2024, 1, 1)) for k in range(40)]
    edge = lambda s, t, j, gone=None: (s, t, j, None, "u", datetime(2024, 1, 1), gone)
    edges = spark.createDataFrame([edge("i07", "i03", "negative"), edge("i01", "i02", "unsure"), edge("i01", "i05", "negative", datetime(2024, 1, 2)), edge("i01", "else", "negative")], EDGES)
    got = Counter((r.source, r.target) for r in blocks.block_edges(spark.createDataFrame(rows, blocks.BLOCKS), edges, chunk_rows=3).collect())
    assert got == Counter((f"i{a:02}", f"i{b:02}") for b in range(40) for a in range(b) if (a, b) not in ((3, 7), (1, 2)))


def test_blocks_give_what_the_store_of_edges_does(spark):
    """Names that change between the runs, judged pairs, clusters, loose candidates, two schemata, and blocks that go or stay."""
    one = [("a1", "Acme"), ("a2", "ACME"), ("a3", "acme"), ("b1", "Bolt"), ("b2", "Bolt"), ("c1", "Cog"), ("c2", "Cog"), ("c3", "Cog"), ("d1", "Dam"), ("d2", "Dam"), ("e1", "Elm"), ("f1", "Fir"), ("f2", "Fir"), ("g1", "Gum"), ("g2", "Gum")]
    two = [*[r for r in one if r[0] not in ("b2", "d1", "d2", "f2")], ("b2", "Elm"), ("e2", "Elm"), ("a4", "Hay"), ("h1", "Hay"), ("f2", "Fir"), ("f3", "Fir")]
    stmt = lambda rows: statements(spark, [(i, "Person" if i == "c3" else "Organization" if i == "g2" else "LegalEntity" if i == "c2" else "Company", "d", props(name=n)) for i, n in rows])
    edge = lambda s, t, j, x=None: (s, t, j, x, "u", datetime(2024, 1, 1), None)
    first = spark.createDataFrame([edge("a4", "h1", "no_judgement", 0.2), edge("a1", "a2", "negative")], EDGES)
    later = spark.createDataFrame([edge("f1", "f2", "positive"), edge("a3", "a1", "unsure")], EDGES)
    runs = lambda step: step(step(step(first, stmt(one), 0.3), stmt(two), 0.6, later), stmt(two), 0.9)

    def without(store, judged):
        keyed = lambda df: df.withColumn("k", resolver.pair_key("source", "target"))
        return keyed(store).join(keyed(judged).select("k"), "k", "left_anti").drop("k").unionByName(judged)

    def pairs(store, stmt, score, judged=None):
        if judged is not None:
            store = without(store, judged)
        link = resolver.linker(store)
        every = xref.equal_names(xref.xref_rows(xref.assemble_entities(stmt)))
        found = resolver.prune_decided(every.selectExpr("left_id", "right_id", "1.0d as score"), store, link)
        return xref.staged(resolver.store_candidates(store, resolver.new_edges(found.selectExpr("left_id as source", "right_id as target", f"{score}d as score"), "no_judgement")), "store")

    def blocked(store, stmt, score, judged=None):
        edges, held = store if isinstance(store, tuple) else (store, spark.createDataFrame([], blocks.BLOCKS))
        if judged is not None:
            edges = without(edges, judged)
        found, others = xref.cross_names(stmt, edges)
        scored = lambda df: df.selectExpr(*[f"{score}d as score" if c == "score" else f"`{c}`" for c in df.columns])
        edges, held = blocks.store_blocks(edges, held, scored(found), scored(others))
        return xref.staged(edges, "edges"), xref.staged(held, "held")

    edges, held = runs(blocked)
    assert held.count() > 0
    rows = lambda df: sorted((r.source, r.target, r.judgement, r.score or 0) for r in df.collect())
    assert rows(edges.unionByName(blocks.block_edges(held, edges))) == rows(runs(pairs))


def test_references_meet_only_captions_pointed_at(spark):
    """Dates and roles are never unfolded, and the captions that are joined are those of what is pointed at."""
    df = catalog.QUERIES["enrich_references"](spark, SMALL)
    assert "l_shipdate" not in df._jdf.queryExecution().executedPlan().toString()
    held = [f for f in df.inputFiles() if "/captions-" in f]
    refs = df.select("ref", "ref_schema").distinct()
    assert held and spark.read.parquet(*held).count() == refs.where("ref_schema <> 'Entity'").count() < catalog.N.captions(catalog.V.actor_statements(spark, SMALL)).count()


def test_judgements_of_a_block_are_a_block(spark, tmp_path, monkeypatch):
    """Pairs told apart are written no more than others: 100 of 150 parts are, and what is staged doesn't grow with their 4,950 pairs."""
    part_table(spark, tmp_path, ["one"] * 10)
    p = spark.range(150).selectExpr("if(id < 100, id * 10, id * 10 + 1) as p_partkey", "'one' as p_name", "'Brand#1' as p_brand", "'SMALL' as p_type", "cast(1 as int) as p_size")
    p.coalesce(1).write.parquet(str(tmp_path / "parts"))
    next((tmp_path / "parts").glob("*.parquet")).replace(tmp_path / "part.parquet")
    sizes, inner = [], catalog.staged
    counted = lambda df, *a: sizes.append((out := inner(df, *a)).count()) or out
    for module in (catalog, xref, resolver, blocks):
        monkeypatch.setattr(module, "staged", counted)
    got = same_rows(spark, tmp_path, "candidate_store")
    assert sum(r[0] == "negative" for r in got) == 100 * 99 // 2 and len(got) == 150 * 149 // 2
    assert max(sizes) <= 4 * 150 + 200


def test_blocks_that_judge_do_as_edges_do(spark):
    """Also where names have clusters, two schemata or loose candidates."""
    rows = [("a1", "Acme"), ("a2", "Acme"), ("a3", "Acme"), ("b1", "Bolt"), ("b2", "Bolt"), ("b3", "Bolt"), ("c1", "Cog"), ("c2", "Cog"), ("c3", "Cog"), ("c4", "Cog")]
    stmt = statements(spark, [(i, "LegalEntity" if i == "c2" else "Company", "d", props(name=n)) for i, n in rows])
    edge = lambda s, t, j: (s, t, j, None, "u", datetime(2024, 1, 1), None)
    # b1 and x are one, so x apart from b2 is b1 apart from it; b3 isn't.
    edges = spark.createDataFrame([edge("b1", "x", "positive")], EDGES)
    groups = {"1": ("a1", "a2"), "2": ("c1", "c2", "c4"), "3": ("b2", "x")}
    judged = spark.createDataFrame([(k, i, "negative", None, "u", datetime(2024, 1, 1)) for k, ids in groups.items() for i in ids], blocks.BLOCKS)
    apart = spark.createDataFrame([edge(s, t, "negative") for ids in groups.values() for s in ids for t in ids if s < t], EDGES)

    def store(edges, judged=None):
        out, held = blocks.store_blocks(edges, spark.createDataFrame([], blocks.BLOCKS), *xref.cross_names(stmt, edges, judged=judged), judged)
        out, held = xref.staged(out, "edges"), xref.staged(held, "held")
        return sorted((r.source, r.target) for r in out.unionByName(blocks.block_edges(held, out, judged=judged)).collect() if r.judgement == "no_judgement")

    got = store(edges, judged)
    assert got == store(edges.unionByName(apart)) and ("a1", "a3") in got and ("b1", "b2") not in got and ("c1", "c3") in got and ("c1", "c2") not in got
