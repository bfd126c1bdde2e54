"""The registered queries of these operators: each applies one, with production parameters, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import huffman, packing, pii, quality, rules, sentencepiece, sharding, simhash, topk, warc
from .common import table


def vocabulary(name: str) -> str:
    from public_tokenizers import path

    return path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = sentencepiece.encode(docs, vocabulary("piece_bpe_32k.model"), decoded=True)
    return out.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.crc32(F.array_join(F.col("ends").cast("array<string>"), ",").cast("binary")).alias("ends_crc32"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op3_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    back = huffman.round_trip(docs, vocabulary("word_bpe_49k.json"), end_id=1)
    rows = huffman.written(back.select("file", "doc_id", "at", "n_tokens", F.crc32("ids").alias("ids_crc32")))
    return huffman.with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), payloads=False)
    return out.select("page_id", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), F.col("refers_to_page").alias("refers_to"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.spans(table(spark, sf_dir, "documents", "doc_id", "text"))
    listed = lambda found: F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = F.filter("found", lambda s: s.base)
    counts = [F.size(F.filter(base.kind, lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]  # noqa: B023
    added = F.size(F.filter("found", lambda s: ~s.base)).cast("long").alias("n_added")
    return out.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), added)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=5, every=50, scale=256)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = sharding.deal(docs, 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = simhash.near_duplicates(docs, shingle=3, distance=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = rules.judge(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")




QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_packing, op3_huffman, op4_quality, op5_warc, op6_pii, op7_topk, op8_sharding, op9_simhash, op10_rules)}
#: Where SQL can express an operator's results.
ORACLES: dict[str, str] = {
    "op5_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, cast(strlen(h) AS bigint) AS payload_bytes, sha1(h) AS payload_digest FROM p),
        m AS (SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT d.*, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN top <> page_id THEN top END AS refers_to
        FROM d LEFT JOIN m ON m.payload_digest = d.payload_digest AND d.payload_bytes >= 1000""",
    "op7_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * cast(x AS double))) AS v FROM embeddings),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.v, c.v) AS bigint) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank FROM s) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op10_rules": rules.SQL,
}
