"""Resolver edges: closure, whole or from changes, merging, undoing, pruning, the store of candidates (G-01, G-03 to G-05, J-14)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import id_weight, pair_key
from ledgerloom.operators.components import connected_components
from ledgerloom.plans.model import EDGES
from ledgerloom.plans.shared import staged
from ledgerloom.sources import commits
from ledgerloom.sources.snapshots import live_edges

LINKER = "entity_id string, canonical_id string"


def _positive(edges: DataFrame) -> DataFrame:
    return live_edges(edges).where("judgement = 'positive'").select(F.col("source").alias("a"), F.col("target").alias("b"))


def _represented(pairs: DataFrame) -> DataFrame:
    """(entity_id, canonical_id) over the components of pairs (a, b)."""
    parts = connected_components(pairs)
    best = parts.groupBy("component").agg(F.min(F.struct((-id_weight("id")).alias("w"), "id")).alias("best"))
    return parts.join(best, "component").select(F.col("id").alias("entity_id"), F.col("best.id").alias("canonical_id"))


def linker(edges: DataFrame) -> DataFrame:
    """G-01: (entity_id, canonical_id) over live positive edges; the representative has the greatest id weight, then the smallest id."""
    return _represented(_positive(edges))


def update_linker(link: DataFrame, edges: DataFrame, added: DataFrame, removed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """G-01 from changes: the linker over edges, from the one before them, and the ids that moved (entity_id, before, after).

    added: edges that are new (those not live and positive do nothing); removed: edges that were live and positive and no longer are;
    edges: all of them after the change. Components run over a small graph: a cluster that only grows is one node of it, its representative, which
    is the best of its members already; a cluster that lost an edge is taken apart into its members and their live edges. What doesn't touch a
    changed edge is neither searched nor named again. before or after is null where the id is in no cluster of two or more.
    """
    ends = lambda df: df.select(F.explode(F.array("source", "target")).alias("entity_id")).distinct()
    if removed is None:
        removed = edges.limit(0)
    lost = link.join(ends(removed), "entity_id", "left_semi").select("canonical_id").distinct()
    # Read again in each of the steps below; as large as the clusters that lost an edge.
    broken = staged(link.join(lost, "canonical_id", "left_semi").select("entity_id", "canonical_id"), "broken")
    inside = _positive(edges.join(broken.select(F.col("entity_id").alias("source")), "source", "left_semi"))
    rows = inside.unionByName(_positive(added)).distinct()
    whole = link.join(broken.select("entity_id"), "entity_id", "left_anti")
    known = staged(whole.join(rows.select(F.explode(F.array("a", "b")).alias("entity_id")).distinct(), "entity_id", "left_semi").select("entity_id", "canonical_id"), "known")
    node = lambda end: known.select(F.col("entity_id").alias(end), F.col("canonical_id").alias(f"__{end}"))
    small = rows.join(node("a"), "a", "left").join(node("b"), "b", "left").select(F.coalesce("__a", "a").alias("a"), F.coalesce("__b", "b").alias("b"))
    named = staged(_represented(small), "named")
    # Members of clusters that grew follow their representative; the others of the small graph are in it themselves.
    heads = known.select("canonical_id").distinct()
    grown = named.join(heads, named.entity_id == heads.canonical_id, "left_semi").where("entity_id <> canonical_id")
    follow = link.join(grown.select(F.col("entity_id").alias("canonical_id"), F.col("canonical_id").alias("after")), "canonical_id").select("entity_id", F.col("canonical_id").alias("before"), "after")
    single = named.join(heads, named.entity_id == heads.canonical_id, "left_anti").select("entity_id", F.col("canonical_id").alias("after"))
    apart = broken.withColumnRenamed("canonical_id", "before").join(single, "entity_id", "full").select("entity_id", "before", "after")
    moved = staged(follow.unionByName(apart).where("not before <=> after"), "moved")
    kept = link.join(moved.select("entity_id"), "entity_id", "left_anti").select("entity_id", "canonical_id")
    return kept.unionByName(moved.where("after is not null").select("entity_id", F.col("after").alias("canonical_id"))), moved


def write_linker(link: DataFrame, store: str, base: dict | None = None) -> dict:
    """A whole linker as the store's newest version; an error where the newest isn't base any more."""

    def change(now: dict | None) -> dict:
        if now != base:
            raise RuntimeError(f"another writer has changed {store}")
        return {"linker": path}

    path = f"{store}/versions/{uuid.uuid4().hex}"
    link.select("entity_id", "canonical_id").write.parquet(path)
    return commits.commit(link.sparkSession, store, change)


def read_linker(spark: SparkSession, store: str) -> DataFrame:
    """The newest whole linker; empty before the first."""
    now = commits.newest(spark, store)
    return spark.read.schema(LINKER).parquet(now["linker"]) if now else spark.createDataFrame([], LINKER)


def refresh_linker(spark: SparkSession, store: str, edges: DataFrame, added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """The stored linker brought up to the change; gives the ids that moved, as ``update_linker`` does."""
    base = commits.newest(spark, store)
    link, moved = update_linker(read_linker(spark, store), edges, added, removed)
    write_linker(link, store, base)
    return moved


def new_edges(pairs: DataFrame, judgement: str | Column, user: str | None = None, now: Column | None = None) -> DataFrame:
    """Edges of the resolver's shape from (source, target[, score])."""
    score = F.col("score").cast("double") if "score" in pairs.columns else F.lit(None).cast("double")
    mark = F.lit(judgement) if isinstance(judgement, str) else judgement
    return pairs.select("source", "target", mark.alias("judgement"), score.alias("score"), F.lit(user).cast("string").alias("user"), (F.current_timestamp() if now is None else now).alias("created_at"), F.lit(None).cast("timestamp").alias("deleted_at")).to(pairs.sparkSession.createDataFrame([], EDGES).schema)


def merge(edges: DataFrame, groups: DataFrame, user: str | None = None, now: Column | None = None, link: DataFrame | None = None) -> DataFrame:
    """G-03: positive edges for groups (group_id, position, id) of two ids or more: each to the first one's canonical id, those already joined left out.

    link: the linker of the edges, if there is one (``read_linker``); else it is worked out from all of them.
    """
    link = linker(edges) if link is None else link
    firsts = groups.groupBy("group_id").agg(F.min_by("id", "position").alias("first"), F.count_distinct("id").alias("n")).where("n >= 2")
    of = lambda name, out: link.select(F.col("entity_id").alias(name), F.col("canonical_id").alias(out))
    rows = groups.join(firsts, "group_id").join(of("first", "to"), "first", "left").join(of("id", "own"), "id", "left").withColumn("to", F.coalesce("to", "first")).withColumn("own", F.coalesce("own", "id"))
    return new_edges(rows.where("own <> to").select(F.col("to").alias("source"), F.col("id").alias("target")).distinct(), "positive", user, now)


def explode(edges: DataFrame, link: DataFrame, ids: DataFrame, now: Column | None = None) -> DataFrame:
    """G-04: the edges, those between members of the clusters that hold one of the ids (column id) marked as deleted."""
    clusters = link.join(ids.select(F.col("id").alias("entity_id")).distinct(), "entity_id", "left_semi").select("canonical_id").distinct()
    members = link.join(clusters, "canonical_id", "left_semi").select("entity_id")
    hit = lambda end: members.select(F.col("entity_id").alias(end), F.lit(True).alias(f"__{end}"))
    gone = F.coalesce(F.col("__source") & F.col("__target"), F.lit(False))
    out = edges.join(hit("source"), "source", "left").join(hit("target"), "target", "left")
    return out.withColumn("deleted_at", F.when(gone & F.col("deleted_at").isNull(), F.current_timestamp() if now is None else now).otherwise(F.col("deleted_at"))).select(*edges.columns)


def prune(edges: DataFrame) -> DataFrame:
    """G-05: without candidates nobody has judged."""
    return edges.where("judgement <> 'no_judgement'")


def prune_decided(pairs: DataFrame, edges: DataFrame, link: DataFrame) -> DataFrame:
    """J-14: pairs (left_id, right_id, ...) without a live judged edge, not in one cluster, and whose clusters hold no negative edge between them."""
    judged = live_edges(edges).where("judgement <> 'no_judgement'")
    out = pairs.join(judged.select(pair_key("source", "target").alias("__key")).distinct(), pair_key("left_id", "right_id") == F.col("__key"), "left_anti")
    of = lambda name, out: link.select(F.col("entity_id").alias(name), F.col("canonical_id").alias(out))
    out = out.join(of("left_id", "__a"), "left_id", "left").join(of("right_id", "__b"), "right_id", "left").withColumn("__a", F.coalesce("__a", "left_id")).withColumn("__b", F.coalesce("__b", "right_id")).where("__a <> __b")
    negative = judged.where("judgement = 'negative'").select("source", "target")
    apart = negative.join(of("source", "__s"), "source", "left").join(of("target", "__t"), "target", "left").select(pair_key(F.coalesce("__s", "source"), F.coalesce("__t", "target")).alias("__key")).distinct()
    return out.join(apart, pair_key("__a", "__b") == F.col("__key"), "left_anti").select(*pairs.columns)


def store_candidates(edges: DataFrame, found: DataFrame) -> DataFrame:
    """The edges after another xref: one live candidate a pair. A pair that was a candidate gets its new score, a new one is added, those that weren't found again stay, and judged pairs never come back."""
    key = pair_key("source", "target")
    live = F.col("deleted_at").isNull()
    open_ = live & (F.col("judgement") == "no_judgement")
    judged = edges.where(live & (F.col("judgement") != "no_judgement")).select(key.alias("__key")).distinct()
    new = found.withColumn("__key", key).join(judged, "__key", "left_anti")
    best = new.groupBy("__key").agg(F.max(F.struct("score", "source", "target", "judgement", "user", "created_at", "deleted_at")).alias("__new"))
    # Of several candidates for one pair the first made stays.
    first = edges.where(open_).groupBy(key.alias("__key")).agg(F.min(F.struct("created_at", "source", "target", "user", "score")).alias("__old"))
    both = first.join(best, "__key", "full")
    old = F.col("__old").isNotNull()
    pick = lambda c: F.when(old, F.col(f"__old.{c}")).otherwise(F.col(f"__new.{c}")).alias(c)
    judgement = F.coalesce("__new.judgement", F.lit("no_judgement")).alias("judgement")
    rows = both.select(pick("source"), pick("target"), judgement, F.coalesce("__new.score", "__old.score").alias("score"), pick("user"), pick("created_at"), F.lit(None).cast("timestamp").alias("deleted_at"))
    return edges.where(~open_).unionByName(rows.select(*edges.columns))
