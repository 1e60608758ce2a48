"""The queries of this package, each thin over its operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chat, doc_prints, embedding_dedup, filter_audit, html_extract, packing, quality, repair, simhash, token_files, toxicity, warc
from ledgerloom.llm.folds import fold
from ledgerloom.plans.shared import fresh_path, read_table, staged


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_token_files(read_table(spark, sf_dir, "documents"), fresh_path(spark, "tokens"))
    return token_files.read_token_files(spark, folder)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = staged(doc_prints.edited_fingerprints(read_table(spark, sf_dir, "documents")), "prints")
    return doc_prints.with_likeness(wide)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(fold(5) != 0).select("doc_id", F.col("toxic").alias("label")))
    return toxicity.score(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = quality.described(read_table(spark, sf_dir, "documents").select("doc_id", "text")), read_table(spark, sf_dir, "labels")
    docs = staged(docs.drop("text"), "described")
    model = quality.train(docs, labels.where(fold(4) != 2).select("doc_id", F.col("quality").alias("label")))
    return quality.score(docs, model).select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_turns(turns.unionByName(extra).withColumn("parts", chat.text_parts())))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(read_table(spark, sf_dir, "documents"), decode=True)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(read_table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", read_table(spark, sf_dir, "labels"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(read_table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_embedding_dedup, op2_token_files, op3_simhash, op4_fingerprints, op5_toxicity, op6_quality, op7_chat, op8_bpe, op9_packing, op10_html, op11_repair, op12_filter_audit, op13_warc)}


_SAID = "'</s>[INST] ok [/INST]'"

def _repair_sql() -> str:
    """A forward search with the audits and repaired rows of the best way to each state, held in f0 to f3."""

    def way(state: str, cost: str = "0", edit: str = "", line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {state}.r || {line}}}"

    best = lambda *ways: f"list_sort([{', '.join(ways)}])[1]"
    user, both, assistant = "chr(10) || 'user:'", "chr(10) || 'user:' || chr(10) || 'assistant:'", "chr(10) || 'assistant:'"
    g = {
        "g0": "f0", "g1": "f1", "g2": best("f2", *(way(x, "3", "I", user) for x in ("f0", "f1", "f3"))),
        "g3": best("f3", way("f2", "3", "I", assistant), *(way(x, "6", "II", both) for x in ("f0", "f1"))),
    }
    extra = "CASE WHEN fault IN (1, 2) THEN 1000000 WHEN fault = 3 THEN 3 ELSE 0 END"
    keep = lambda state, initial: way(state, f"{extra} + CASE WHEN initial = '{initial}' THEN 0 ELSE 1000000 END", "K", "chr(10) || role || ':' || text")
    rerole = lambda state, role: way(state, f"{extra} + 3", "R", f"chr(10) || '{role}:' || text")
    drop = lambda state: way(state, "4", "D")
    f = {
        "f0": drop("g0"), "f1": best(drop("g1"), keep("g0", "s")), "f2": best(drop("g2"), *(way_ for x in ("g0", "g1", "g3") for way_ in (keep(x, "u"), rerole(x, "user")))),
        "f3": best(drop("g3"), keep("g2", "a"), rerole("g2", "assistant")),
    }
    none = "{'c': 1000000::BIGINT, 'a': '', 'r': ''}"
    columns = lambda d: ", ".join(f"{x} AS {n}" for n, x in d.items())
    return rf"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
  h AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(key, '.'), lambda x: ord(x)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 20 AS fate FROM k),
  d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE fate <> 0),
  n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last, left(role, 1) AS initial FROM d),
  o AS (SELECT *, CASE WHEN last = '' THEN 1 WHEN seen > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM n),
  r AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS f0, {none} AS f1, {none} AS f2, {none} AS f3 FROM conversations
    UNION ALL SELECT conv_id, i, {columns(f)} FROM (SELECT conv_id, i, fault, initial, role, text, {columns(g)} FROM (SELECT r.conv_id, o.i, fault, initial, role, text, f0, f1, f2, f3 FROM r JOIN o ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND o.i = r.i + 1))),
  e AS (SELECT conv_id, {best("f0", g["g3"])} AS done FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM r) WHERE back = 1),
  s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM o GROUP BY 1)
  SELECT e.conv_id, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))}, done.c AS cost, done.a AS audit, sha256(done.r[2:]) AS repaired_sha256 FROM e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""


#: The other operators rest on hashes, tokenizers or fitted models that SQL lacks.
SQL = {
    "op1_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
  good AS (SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
  near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
  reach AS (SELECT vec_id AS start, vec_id AS node FROM v UNION SELECT start, near.b FROM reach JOIN near ON near.a = reach.node),
  n AS (SELECT a AS vec_id, count(*) AS n_links FROM near GROUP BY 1), c AS (SELECT start AS vec_id, min(node) AS component_id FROM reach GROUP BY 1)
  SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)""",
    "op7_chat": f"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', {_SAID} UNION ALL SELECT -7, 1, 'assistant', {_SAID}),
  e AS (SELECT *, length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text, '\\\\')) + len(regexp_extract_all(text, '{chat.CONTROL_SQL}')) + len(regexp_extract_all(role, '{chat.CONTROL_SQL}')) + {len(chat.OPEN + chat.SAYS + chat.CLOSE)} AS size FROM r)
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars FROM e GROUP BY 1""",
    "op10_html": r"""WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1) AS inside FROM pages),
  b AS (SELECT page_id, url, list_transform(regexp_split_to_array(replace(inside, '<br>', ' '), '</?(?:p|h1)>'), lambda x: trim(regexp_replace(regexp_replace(replace(regexp_replace(x, '<[^>]+>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM a),
  t AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM b)
  SELECT page_id, url, text, length(text) AS n_chars FROM t""",
    "op11_repair": _repair_sql(),
    "op12_filter_audit": r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents), w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
  l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
  m AS (SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
  c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
  f AS (SELECT 'A' AS x, 1 AS bit UNION ALL SELECT 'B', 2 UNION ALL SELECT 'C', 4 UNION ALL SELECT 'D', 8 UNION ALL SELECT 'E', 16),
  o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit <> b.bit AND a.bit <> c.bit AND a.bit <> d.bit AND a.bit <> e.bit AND b.bit <> c.bit AND b.bit <> d.bit AND b.bit <> e.bit AND c.bit <> d.bit AND c.bit <> e.bit AND d.bit <> e.bit),
  s AS (SELECT filter_order, step::INT AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
  r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & own <> 0 AND mask & earlier <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost FROM c, s GROUP BY 1, 2, 3, 4)
  SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM r""",
    "op13_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), h AS (SELECT page_id, strlen(html) AS payload_bytes, upper(sha1(html)) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || hex[5 * i + 1 : 5 * i + 5])::BIGINT >> (15 - 5 * j)) & 31) + 1)::INT]), '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM h""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
