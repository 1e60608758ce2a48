"""Document fingerprints with DataFrame functions only.

A term is a word with the word after it (the last word stands alone).  Each term's
64-bit hash votes on 64 bits, weighted by the term's length in code points up to
``MAX_WEIGHT``: short function words, which all texts of a language share, count less.
A bit is set if more than half of the weight votes for it.  The 64 sums of a document
are kept as 32 longs, two counters of 32 bits in each, so that one pass of the
aggregation serves all bits.

``block_counts`` counts for each fingerprint the others within a radius, and ``block_links``
lists these pairs, by permuted block
tables: the bits are cut into ``blocks`` blocks; a pair within the radius agrees on
at least blocks - radius of them, so a table for each choice of that many blocks, joined
on their bits, meets every pair, and only the first table in which a pair meets keeps it.
Fingerprints that share a key are dealt to chunks of about ``chunk_rows``, and each pair of
chunks is a group of the join, so a key that very many share (texts of one template) is
many small groups; the counts are added up before they are shuffled.

Defined cases: null text is empty; an empty text (or only white space) has
fingerprint 0; equal texts have equal fingerprints; repeated rows keep a row each; rows of one doc_id
come in the order of their texts' hashes; null doc_ids come first; the document after the last is the
first; a very long text is one row until it is cut into terms, whose votes are added up in parts;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_WEIGHT = 16
_LANES = 0x0000000100000001


def vote_sums(term_hash: Column, weight: Column) -> list[Column]:
    return [F.sum(F.shiftrightunsigned(term_hash, k).bitwiseAND(F.lit(_LANES)) * weight).alias(f"v{k}") for k in range(32)]


def voted(weight: str = "weight") -> Column:
    """The 64 bits as a long."""
    out = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"v{k}"), 32)
        for votes, bit in ((low, k), (high, k + 32)):
            out = out.bitwiseOR(F.when(votes * 2 > F.col(weight), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return out


def fingerprints(texts: DataFrame, keys: list[str], carried: list[str] | None = None) -> DataFrame:
    """keys, carried columns and fp of each text; keys identify a row of texts. A text without words has one term of no weight.

    Carried columns are grouped by too: first() of a string would make Spark sort all terms before it adds them up.
    """
    carried = carried or []
    words = F.array_remove(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), "")
    terms = texts.select(*keys, *carried, words.alias("words")).select(*keys, *carried, F.explode_outer(F.arrays_zip(F.col("words").alias("a"), F.expr("slice(words, 2, greatest(size(words), 1))").alias("b"))).alias("t"))
    weight = F.least(F.length("t.a") + F.coalesce(F.length("t.b"), F.lit(0)), F.lit(MAX_WEIGHT))
    terms = terms.select(*keys, *carried, F.xxhash64("t.a", "t.b").alias("h"), F.when(F.col("t.a").isNull(), 0).otherwise(weight).cast("long").alias("w"))
    sums = terms.groupBy(*keys, *carried).agg(*vote_sums(F.col("h"), F.col("w")), F.sum("w").alias("weight"))
    return sums.select(*keys, *carried, voted().alias("fp"))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """rows (doc_id, h, text) with salt and bucket, whose order is that of (doc_id, h, salt), nulls first, and which hold about as many rows each.

    A doc_id with a large share of the rows is cut by its hashes, and one hash of one doc_id (rows that are repeated) by a salt.
    """
    spread = rows.agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 10000).alias("cuts")).first()
    total = max(1, spread.n)
    # Repeated rows that fill a bucket: fewer than buckets.
    often = rows.groupBy("doc_id", "h").agg(F.count("*").alias("n")).where(F.col("n") * buckets > total)
    often = often.groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_list(F.struct("h", F.ceil(F.col("n") * buckets / total).cast("int").alias("salts"))).alias("__often"))
    rows = rows.join(F.broadcast(often), F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
    of = lambda f: F.coalesce(F.filter("__often", f), F.array().cast("array<struct<h:bigint,salts:int>>"))
    own = of(lambda x: x["h"] == F.col("h"))
    # Between them lie the hashes that aren't frequent.
    among = 2 * F.size(of(lambda x: x["h"] < F.col("h"))) + F.size(own)
    rows = rows.withColumn("among", among).withColumn("salt", F.when(F.size(own) > 0, F.pmod(F.monotonically_increasing_id(), own[0]["salts"])).otherwise(0).cast("int")).drop("__doc", "__often")
    cuts = sorted(spread.cuts or [])
    bounds = sorted(set(cuts))
    # Of the doc_ids below the first bound (nulls among them) and from each bound on: how many buckets the first id takes.
    widths = [max(1, -(-spread.nulls * buckets // total))] + [cuts.count(c) for c in bounds]
    before = [sum(widths[:i]) for i in range(len(widths))]
    at = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(F.lit(bounds), lambda c: c <= F.col("doc_id")))) if bounds else F.lit(0)
    width = F.lit(widths)[at]
    first = F.coalesce(F.col("doc_id").isNull() | (F.lit([None, *bounds]).cast("array<bigint>")[at] == F.col("doc_id")), F.lit(False))
    part = F.when(first, F.least(width - 1, F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * width))).otherwise(width - 1)
    number = (F.lit(before)[at] + part).cast("long")
    return rows.withColumn("bucket", F.shiftleft(number, 36) + F.when(first, F.lit(0)).otherwise(1 << 35) + F.shiftleft(F.col("among").cast("long"), 17) + F.col("salt")).drop("among")


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(bucket, number, doc_id, text, next_bucket, next_number, next_text): every row and the one after it in ascending doc_id.

    Rows are dealt to ranges of (doc_id, hash) and ordered inside each; the first row of a range also
    closes the range before it.  So no task orders more than a range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = _dealt(rows, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h", "salt")
    # A row for each range: a few times as many as buckets.
    firsts = rows.groupBy("bucket").agg(F.min(order).alias("least")).orderBy("bucket").collect()
    if not firsts:
        return rows.select("bucket", F.lit(1).alias("number"), "doc_id", "text", F.col("bucket").alias("next_bucket"), F.lit(1).alias("next_number"), F.col("text").alias("next_text"))
    used = [r.bucket for r in firsts]
    first = spark.createDataFrame([(r.bucket, r.least.doc_id, r.least.h, r.least.salt, p) for r, p in zip(firsts, [used[-1], *used[:-1]])], "home long, first_doc long, first_hash long, first_salt int, before long")
    same = (F.col("bucket") == F.col("home")) & F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("h") == F.col("first_hash")) & (F.col("salt") == F.col("first_salt"))
    closing = rows.join(F.broadcast(first), same).select("doc_id", "text", "h", "salt", F.col("before").alias("bucket"), "home").dropDuplicates(["home"])
    all_rows = rows.select("doc_id", "text", "h", "salt", "bucket", F.lit(None).cast("long").alias("home")).unionByName(closing)
    w = Window.partitionBy("bucket").orderBy(F.col("home").isNotNull(), F.col("doc_id").asc_nulls_first(), "h", "salt")
    after = all_rows.select("*", F.row_number().over(w).alias("number"), F.lead("text").over(w).alias("next_text"), F.lead("home").over(w).alias("next_home")).where("home is null")
    return after.select("bucket", "number", "doc_id", "text", F.coalesce("next_home", "bucket").alias("next_bucket"), F.when(F.col("next_home").isNull(), F.col("number") + 1).otherwise(1).alias("next_number"), "next_text")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text (its last half replaced by the beginning of the next document), and their likeness."""
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars as int) - half)"), F.expr("substring(next_text, 1, half)")))
    carried = ["doc_id", "n_chars", "next_bucket", "next_number", "sha"]
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("t")
    both = rows.withColumn("sha", F.unhex(F.sha2("edited", 256))).select("bucket", "number", *carried, kinds).select("bucket", "number", *carried, "t.kind", "t.text")
    prints = fingerprints(both, ["bucket", "number", "kind"], carried)
    of = lambda k: F.max(F.when(F.col("kind") == k, F.col("fp")))
    return prints.groupBy("bucket", "number", *carried).agg(of(0).alias("fp"), of(1).alias("edited_fp"))


def with_likeness(wide: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """The likeness of each row's fingerprint to its edited text's and the next row's, and how many other fingerprints are within the radius. wide is read several times: stage it before."""
    after = wide.select(F.col("bucket").alias("next_bucket"), F.col("number").alias("next_number"), F.col("fp").alias("next_fp"))
    near = block_counts(wide, radius, blocks)
    return wide.join(after, ["next_bucket", "next_number"], "left").join(near, "fp", "left").select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), hex_fingerprint(F.col("fp")).alias("fingerprint"), hex_fingerprint(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def _tables(radius: int, blocks: int) -> list[int]:
    """The bits of each table as a signed 64-bit mask."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("radius must be less than blocks")
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << (e - s)) - 1) << s for s, e in zip(edges, edges[1:])]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    return [signed(sum(masks[i] for i in chosen)) for chosen in itertools.combinations(range(blocks), blocks - radius)]


def block_links(prints: DataFrame, radius: int = 3, blocks: int = 6, chunk_rows: int = 512) -> DataFrame:
    """(a, b, differing) for all pairs a < b of distinct fingerprints (column fp) within the radius.

    One fingerprint stands for all its documents, so copies aren't expanded.  Keys have
    about 64 * (blocks - radius) / blocks bits; more blocks give longer keys and more tables.
    Of a dense group the pairs are many: ask for ``block_counts`` where numbers do.
    """
    tables = _tables(radius, blocks)
    fp = prints.select("fp").where("fp is not null").distinct()
    keyed = fp.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in tables])).alias("table", "key"))
    shared = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n >= 2").select("table", "key", F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks"))
    keyed = keyed.join(shared, ["table", "key"]).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    left = keyed.select("table", "key", F.col("c").alias("u"), F.explode(F.sequence("c", F.col("chunks") - 1)).alias("v"), F.col("fp").alias("a"))
    right = keyed.select("table", "key", F.explode(F.sequence(F.lit(0), "c")).alias("u"), F.col("c").alias("v"), F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    once = (F.col("u") < F.col("v")) | (F.col("a") < F.col("b"))
    met_before = F.exists(F.transform(F.array(*[F.lit(m) for m in tables]), lambda m, i: (i < F.col("table")) & (differ.bitwiseAND(m) == 0)), lambda x: x)
    pairs = left.join(right, ["table", "key", "u", "v"]).where(once & (F.bit_count(differ) <= radius) & ~met_before)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.bit_count(differ).alias("differing"))


def block_counts(prints: DataFrame, radius: int = 3, blocks: int = 6, chunk_rows: int = 512) -> DataFrame:
    """(fp, n_near) for each distinct fingerprint (column fp) that has others within the radius: how many."""
    pairs = block_links(prints, radius, blocks, chunk_rows)
    return pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_near"))
