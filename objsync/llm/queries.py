"""The operators applied to the test tables: one query each, and the SQL that it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm import conversations, decontaminate, jaccard, language, packing, secret_scan, shards, suffix_dedup, topk, toxicity, urls, warc, whitening
from objsync.llm.common import bounded_batches
from objsync.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SHARDS = 40
# The rules of the url filter.
RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf: function(bounded_batches(spark), sf)
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(folds: int):
    """The remainder of the id's CRC-32 by which labelled rows are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


@query
def op1_threshold_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)


@query
def op2_interleaved_shards(spark: SparkSession, sf: str) -> DataFrame:
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    docs = table(spark, sf, "documents").select(
        "doc_id", "source", (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    dealt = shards.interleave(docs, SHARDS, ties=("text_crc32", "size"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_cross_parsing_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    models = language.train(docs.filter(fold(4) != 2).select("text", "lang"))
    held = F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")
    return language.predict(docs.select("doc_id", held, "text"), models).select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_markov_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


@query
def op5_url_segmentation(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    counts = urls.word_counts(pages, "html")
    return urls.judge(pages.select("page_id", "url"), RULES, counts).select("page_id", "host", "path", "rule", "verdict")


@query
def op6_shortest_pack_first(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(table(spark, sf, "documents"), path, with_ids=False))


@query
def op7_log_ratio_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "toxic").filter(fold(5) != 0)
    drawn = docs.withColumn("draw", F.xxhash64("text"))
    model = toxicity.train(drawn.join(labels, "doc_id").select("text", "toxic", "draw"), draw="draw")
    held = F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out")
    return toxicity.predict(docs.select("doc_id", held, "text"), model).select("doc_id", "held_out", "score", "predicted")


@query
def op8_token_combination_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op9_segmented_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), folder)
    return warc.read_archives(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_benchmark_passages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op11_prefix_doubling(spark: SparkSession, sf: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_qd_whitening(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", whitening.integers(F.col("embedding")).alias("vector"))
    return whitening.whiten(vectors, *whitening.fit(vectors))


@query
def op13_lr_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    turns = conversations.ordered(conversations.damaged(rows))
    repairs, segments = conversations.repair(turns)
    lines = conversations.digests(conversations.repaired(turns, segments, together=True))
    named = rows.select("conv_id").distinct()
    found = named.join(repairs.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    found = found.join(lines.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


ORACLE["op1_threshold_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
"""

ORACLE["op2_interleaved_shards"] = f"""
WITH rule AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
texts AS (
  SELECT doc_id, coalesce('1' || source, '0') AS stratum, hex(encode(coalesce(text, ''))) AS code FROM documents),
sized AS (
  SELECT doc_id, stratum, length(code) // 2 + 16 AS size, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS draw,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(code) // 2),
      lambda i: ('0x' || substr(code, (2 * i + 1)::BIGINT, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM texts, rule),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY draw, doc_id, text_crc32, size) - 0.5::DOUBLE)
    / count(*) OVER (PARTITION BY stratum) AS place FROM sized),
placed AS (
  SELECT *, row_number() OVER (ORDER BY place, stratum, draw, doc_id, text_crc32, size) - 1 AS pos, count(*) OVER () AS n
  FROM ranked),
cut AS (SELECT *, (pos * {SHARDS} // n)::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, pos - (shard * n + {SHARDS - 1}) // {SHARDS} AS slot,
  NULL::INTEGER AS grown_shard FROM cut
"""

ORACLE["op9_segmented_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM k
"""

# The separators spelt for DuckDB's regular expressions.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)

ORACLE["op10_benchmark_passages"] = f"""
WITH items AS (
  SELECT item_id, {_WORDS.format("text")} AS words FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT item_id, least(len(words), 10) AS size,
    array_to_string(words[i + 1:i + least(len(words), 10)], ' ') AS window
  FROM (SELECT item_id, words, unnest(range(greatest(len(words) - 9, 1))) AS i FROM items WHERE len(words) > 0)),
docs AS (
  SELECT row_number() OVER () AS uid, doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
places AS (
  SELECT uid, i, size, array_to_string(words[i + 1:i + size], ' ') AS window
  FROM (SELECT uid, words, unnest(range(len(words))) AS i FROM docs), (SELECT DISTINCT size FROM windows)
  WHERE i + size <= len(words)),
hits AS (SELECT uid, i, p.size, item_id FROM places p JOIN windows w ON p.window = w.window AND p.size = w.size),
marked AS (SELECT uid, count(DISTINCT j) AS n_hit FROM (SELECT uid, unnest(range(i, i + size)) AS j FROM hits) GROUP BY uid),
held AS (
  SELECT uid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY uid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (uid) LEFT JOIN held USING (uid)
"""
