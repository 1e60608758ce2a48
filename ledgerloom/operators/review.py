"""Review of candidate pairs in clusters (J-10, J-11, A-07, G-07 to G-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.scalars import pair_key
from ledgerloom.operators.components import connected_components
from ledgerloom.operators.resolver import linker, new_edges
from ledgerloom.plans.model import JUDGEMENTS, ONTOLOGY, Ontology
from ledgerloom.plans.shared import staged


def open_edges(edges: DataFrame) -> DataFrame:
    return edges.where("deleted_at is null and judgement = 'no_judgement'")


def best_scores(pairs: DataFrame) -> DataFrame:
    """A-07: (pair_key, left_id, right_id, score): the greatest score of each pair; null loses."""
    return pairs.groupBy(pair_key("source", "target").alias("pair_key")).agg(F.min(F.least("source", "target")).alias("left_id"), F.max(F.greatest("source", "target")).alias("right_id"), F.max("score").alias("score"))


def member_scores(pairs: DataFrame) -> DataFrame:
    """A-07: the greatest score over the pairs of each member."""
    both = pairs.select(F.col("left_id").alias("member"), "score").unionByName(pairs.select(F.col("right_id").alias("member"), "score"))
    return both.groupBy("member").agg(F.max("score").alias("score"))


def pairs_in_clusters(edges: DataFrame, members: DataFrame, skips: DataFrame | None = None) -> DataFrame:
    """J-10: (cluster_id, pair_key, left_id, right_id, score): live unjudged edges with both ends in a cluster (cluster_id, member), best score of each pair, without skipped pair keys."""
    e = open_edges(edges).select("source", "target", "score")
    inside = e.join(members.select("cluster_id", F.col("member").alias("source")), "source").join(members.select("cluster_id", F.col("member").alias("target")), ["cluster_id", "target"])
    out = inside.groupBy("cluster_id", pair_key("source", "target").alias("pair_key")).agg(F.min(F.least("source", "target")).alias("left_id"), F.max(F.greatest("source", "target")).alias("right_id"), F.max("score").alias("score"))
    return out if skips is None else out.join(skips.select("pair_key").distinct(), "pair_key", "left_anti").select("cluster_id", "pair_key", "left_id", "right_id", "score")


def open_pairs(pairs: DataFrame, leases: DataFrame, skips: DataFrame, user_id: str, now: Column) -> DataFrame:
    """J-11: pairs that no other reviewer holds and this one hasn't skipped; an entry that ends at now or before has expired."""
    held = leases.where((F.col("expires_at") > now) & (F.col("user_id") != user_id)).select("pair_key")
    skipped = skips.where((F.col("expires_at") > now) & (F.col("user_id") == user_id)).select("pair_key")
    return pairs.join(held.unionByName(skipped).distinct(), "pair_key", "left_anti").select(*pairs.columns)


def review_clusters(pairs: DataFrame, max_members: int = 8) -> DataFrame:
    """G-07: (seed, member, step) for each pair (pair_key, left_id, right_id, score) as a seed.

    Each round adds, to every seed at once, the outside neighbour reached by the best-scoring edge (null counts 0; of
    equals the smaller id), until max_members members or no neighbour. Only the best max_members neighbours of each node are
    kept: the others can't be reached, since fewer than max_members are inside already. So a hub costs each seed a few rows.
    """
    both = pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b"), F.coalesce("score", F.lit(0.0)).alias("score"))
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"), "score")).groupBy("a", "b").agg(F.max("score").alias("score"))
    best = Window.partitionBy("a").orderBy(F.col("score").desc(), "b")
    both = staged(both.withColumn("n", F.row_number().over(best)).where(F.col("n") <= max_members).drop("n"), "neighbours")
    members = pairs.select(F.col("pair_key").alias("seed"), F.explode(F.array("left_id", "right_id")).alias("member")).distinct().withColumn("step", F.lit(0))
    for step in range(1, max_members - 1):
        reach = members.join(both, F.col("member") == F.col("a")).select("seed", F.col("b").alias("member"), "score")
        outside = reach.join(members.select("seed", "member"), ["seed", "member"], "left_anti")
        best = outside.groupBy("seed").agg(F.min(F.struct((-F.col("score")).alias("s"), "member")).alias("m")).select("seed", F.col("m.member").alias("member"), F.lit(step).alias("step"))
        members = staged(members.unionByName(best), "clusters")
    return members


def cluster_payload(clusters: DataFrame, entities: DataFrame, pairs: DataFrame) -> DataFrame:
    """G-08: (cluster_id, members, pairs) of clusters (cluster_id, member) with two members or more, a pair, and every member known.

    pairs: as pairs_in_clusters gives them.
    """
    known = entities.select(F.col("id").alias("member"), "caption", "schema")
    both = pairs.select("cluster_id", F.explode(F.array("left_id", "right_id")).alias("member"), "score").groupBy("cluster_id", "member").agg(F.max("score").alias("score"))
    rows = clusters.select("cluster_id", "member").distinct().join(known, "member", "left").join(both, ["cluster_id", "member"], "left")
    members = rows.groupBy("cluster_id").agg(F.count("*").alias("n"), F.count_if(F.col("caption").isNull()).alias("missing"), F.array_sort(F.collect_list(F.struct((-F.coalesce("score", F.lit(0.0))).alias("order"), "member", "caption", "schema", "score"))).alias("members"))
    listed = pairs.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("pair_key", "left_id", "right_id", "score"))).alias("pairs"))
    return members.where("n >= 2 and missing = 0").join(listed, "cluster_id").select("cluster_id", F.transform("members", lambda m: m.dropFields("order")).alias("members"), "pairs")


def validate_decisions(decisions: DataFrame, pairs: DataFrame) -> DataFrame:
    """G-09: decisions (decision_id, cluster_id, selected_ids, judgement, user_id) with reason; null: valid.

    pairs: (cluster_id, pair_key, left_id, right_id).  A positive one needs its selected ids in one connected group.
    """
    picked = decisions.select("decision_id", "cluster_id", F.array_distinct("selected_ids").alias("ids"))
    inside = picked.join(pairs, "cluster_id").where("array_contains(ids, left_id) and array_contains(ids, right_id)").select("decision_id", "left_id", "right_id")
    covered = inside.select("decision_id", F.explode(F.array("left_id", "right_id")).alias("id")).groupBy("decision_id").agg(F.count_distinct("id").alias("covered"))
    node = lambda c: F.concat_ws("|", F.col("decision_id").cast("string"), c)
    parts = connected_components(inside.select(node("left_id").alias("a"), node("right_id").alias("b")))
    groups = parts.groupBy(F.substring_index("id", "|", 1).alias("d")).agg(F.count_distinct("component").alias("groups"))
    rows = decisions.join(covered, "decision_id", "left").join(groups, F.col("decision_id").cast("string") == F.col("d"), "left")
    n = F.size(F.array_distinct("selected_ids"))
    reason = (
        F.when(~F.col("judgement").isin(*JUDGEMENTS) | F.col("judgement").isNull(), "unknown judgement")
        .when(n < 2, "fewer than two selected")
        .when(F.col("covered").isNull(), "no shared pair")
        .when(F.col("covered") < n, "an id without a pair")
        .when((F.col("judgement") == "positive") & (F.col("groups") > 1), "not connected")
    )
    return rows.select(*decisions.columns, reason.alias("reason"))


def _judgement() -> Column:
    """The column judgement; an unknown one is an error."""
    return F.when(F.col("judgement").isin(*JUDGEMENTS), F.col("judgement")).otherwise(F.raise_error(F.concat(F.lit("unknown judgement "), F.coalesce("judgement", F.lit("null")))))


def _apart(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The pairs (left_id, right_id, ...) that aren't in one cluster yet."""
    link = linker(edges)
    of = lambda name, out: link.select(F.col("entity_id").alias(name), F.col("canonical_id").alias(out))
    return pairs.join(of("left_id", "__a"), "left_id", "left").join(of("right_id", "__b"), "right_id", "left").where("coalesce(__a, left_id) <> coalesce(__b, right_id)").select(*pairs.columns)


def _decided(rows: DataFrame, now: Column | None, columns: list[str]) -> DataFrame:
    """Edges of (left_id, right_id, judgement, user_id), each once for a judgement, by the first of its users."""
    one = rows.groupBy(F.col("left_id").alias("source"), F.col("right_id").alias("target"), "judgement").agg(F.min("user_id").alias("user"))
    return new_edges(one, F.col("judgement"), now=now).drop("user").join(one, ["source", "target", "judgement"]).select(*columns)


def apply_decisions(edges: DataFrame, decisions: DataFrame, now: Column | None = None) -> DataFrame:
    """G-10: judgement edges for open pairs with both ends selected by a decision (selected_ids, judgement, user_id), except those already in one cluster.

    An unknown judgement is an error.
    """
    chosen = decisions.select("decision_id", _judgement().alias("judgement"), "user_id", F.explode(F.array_distinct("selected_ids")).alias("member"))
    e = best_scores(open_edges(edges)).select("left_id", "right_id")
    hits = e.join(chosen.withColumnRenamed("member", "left_id"), "left_id").join(chosen.select("decision_id", F.col("member").alias("right_id")), ["decision_id", "right_id"])
    return _decided(_apart(hits, edges), now, edges.columns)


def decide_pairs(edges: DataFrame, decisions: DataFrame, now: Column | None = None) -> DataFrame:
    """G-10 by pair (left_id, right_id, judgement, user_id): only pairs that are still undecided and not in one cluster. An unknown judgement is an error."""
    judged = edges.where("deleted_at is null and judgement <> 'no_judgement'").select(pair_key("source", "target").alias("k")).distinct()
    checked = decisions.select("left_id", "right_id", _judgement().alias("judgement"), "user_id")
    open_ = checked.join(judged, pair_key("left_id", "right_id") == F.col("k"), "left_anti")
    return _decided(_apart(open_, edges), now, edges.columns)


def pair_payload(pairs: DataFrame, entities: DataFrame, ontology: Ontology = ONTOLOGY) -> DataFrame:
    """G-11: both sides of each pair and the route of its page; pairs with an unknown side have no row."""
    side = lambda p: entities.select(F.col("id").alias(f"{p}_id"), F.col("caption").alias(f"{p}_caption"), F.col("schema").alias(f"{p}_schema"))
    rows = pairs.join(side("left"), "left_id").join(side("right"), "right_id")
    profile = ontology.is_a(F.col("left_schema"), "LegalEntity") & ontology.is_a(F.col("right_schema"), "LegalEntity")
    return rows.withColumn("route", F.when(profile, "profile").otherwise("entity"))


def lease_ends(events: DataFrame, minutes: int) -> DataFrame:
    """Leases or skips from events (pair_key, user_id, at): the last of each pair and user, with its end."""
    w = Window.partitionBy("pair_key", "user_id").orderBy(F.col("at").desc())
    return events.withColumn("n", F.row_number().over(w)).where("n = 1").select("pair_key", "user_id", (F.col("at") + F.expr(f"interval {minutes} minutes")).alias("expires_at"))
