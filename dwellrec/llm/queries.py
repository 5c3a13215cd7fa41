"""Registered queries of the corpus operators and their DuckDB oracle SQL.

Each query applies its operator with production parameters to the whole table
and derives the digest columns of its contract.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dwellrec.llm import (
    crf_quality,
    decontam,
    digest_merge,
    ecoc_langid,
    external_shuffle,
    fixity,
    length_buckets,
    line_chunks,
    ns_kmeans,
    permutation_index,
    phrases,
    simhash,
    tool_chat,
)
from dwellrec.llm.common import as_text, table


def op1_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_fixity(spark, sf_dir):
    """The pages as one replica against a copy of them that has rotted."""
    pages = table(spark, sf_dir, "pages")
    found = fixity.audit(fixity.records(pages),
                         fixity.cut_short(fixity.records(fixity.damaged(pages))))
    return found.withColumn("found", F.coalesce("found", F.lit("")))


def op3_packing(spark, sf_dir):
    return length_buckets.pack(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark, sf_dir):
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents"))


def line_dedup_passages(spark, sf_dir):
    """op4's whole job, every repeated run of lines; op4 itself is held to its SQL."""
    return line_chunks.dedup_passages(table(spark, sf_dir, "documents"))


def _fold(n: int, k: int):
    """Whether crc32 of doc_id as text is k modulo n (false for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == k, F.lit(False))


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = crf_quality.learnable(table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = crf_quality.score(docs, crf_quality.fit(docs, labels))
    return scored.select("doc_id", _fold(5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"), "good_lines")


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = ecoc_langid.fit(ecoc_langid.learnable(docs))
    found, (lang, score, ambiguous, _) = ecoc_langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _fold(4, 2).alias("held_out"), F.col(lang).alias("lang_pred"),
                        F.col(score).alias("score"), F.col(ambiguous).alias("ambiguous"))


def op7_tool_chat(spark, sf_dir):
    log = tool_chat.tool_log(table(spark, sf_dir, "conversations"))
    lines = tool_chat.format_log(log, tool_chat.reply_tools(spark))
    return lines.withColumn("call_id", F.coalesce("call_id", F.lit("")))


def op8_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark, sf_dir):
    return digest_merge.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op10_sharding(spark, sf_dir):
    placed = external_shuffle.shard(table(spark, sf_dir, "documents"), n_shards=16)
    t = as_text("text")
    return placed.select(
        "doc_id", (F.octet_length(t) + 1).cast("bigint").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_nearest(spark, sf_dir):
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op13_clusters(spark, sf_dir):
    return ns_kmeans.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_fixity": op2_fixity,
    "op3_packing": op3_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality": op5_quality,
    "op6_language_id": op6_language_id,
    "op7_tool_chat": op7_tool_chat,
    "op8_simhash": op8_simhash,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_phrases": op11_phrases,
    "op12_nearest": op12_nearest,
    "op13_clusters": op13_clusters,
    "line_dedup_passages": line_dedup_passages,
}

OP1_SQL = """
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM benchmark),
widths AS (SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE side = 'i' AND len(w) > 0),
every AS (
  SELECT side, id, unnest(list_transform(
    range(1, len(w) - k + 2), lambda x: array_to_string(w[x:x + k - 1], ' '))) AS g
  FROM words JOIN widths ON len(w) >= k AND (side = 'd' OR k = least(len(w), 5))),
wanted AS (SELECT DISTINCT g FROM every WHERE side = 'i'),
grams AS (SELECT DISTINCT side, id, g FROM every SEMI JOIN wanted USING (g)),
n AS (SELECT id, count(*) AS n FROM grams WHERE side = 'i' GROUP BY id),
m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS matched
      FROM grams d JOIN grams i ON d.side = 'd' AND i.side = 'i' AND d.g = i.g GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS item_shingles, CAST(matched AS INTEGER) AS matched,
       matched / n AS containment
FROM m JOIN n ON n.id = item_id WHERE matched >= (0.8 - 1e-9) * n
"""

OP9_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

ORACLE = {
    "op1_decontamination": OP1_SQL,
    "op2_fixity": fixity.audit_sql(),
    "op3_packing": length_buckets.pack_sql(),
    "op4_line_dedup": line_chunks.dedup_lines_sql(),
    "op7_tool_chat": tool_chat.tool_log_sql(),
    "op9_exact_dedup": OP9_SQL,
    "op11_phrases": phrases.collocations_sql(),
    "op13_clusters": ns_kmeans.cluster_sql(),
    "line_dedup_passages": line_chunks.dedup_passages_sql(),
}
