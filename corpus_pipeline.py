"""A training corpus from raw documents, in five stages over Parquet tables.

Quality classifier: documents scored below its threshold go. Quality rules: lines that fail are
removed and documents that fail, or lose too much, go. Near copies: the least id of each group of
texts similar in their five-word shingles stays. Personal data: spans are replaced by their kind. Packing: every document becomes
pieces in sequences of 2048 tokens; this last result has a row a piece.

All but the last take and return the columns of documents, whatever their order; n_chars follows a
changed text. Each stage handles what its operator's module says of nulls, empty texts and tables,
and repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path

from tessera.llm import packing, pii, quality, rules, similar
from tessera.llm.common import discard, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """changed in the columns of docs, with n_chars counted anew where the table has it."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(docs, rules.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the least id (none comes last).

    Groups are what a Jaccard similarity of 0.8 or more of five-word shingles connects. A row is known
    by its id and its text, so rows that share an id (or have none) and no group all stay; of rows equal
    in both, the one with the least other columns does.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = docs.withColumn("_node", similar.node_of(F.col("text"))).withColumn("_id", name)
    nodes = written(keyed.groupBy("_node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_id")).alias("least")))
    found = similar.groups(keyed.select(F.col("_node").alias("node"), "text")).withColumnRenamed("node", "_node")
    least = F.min(F.struct("least", "_node")).alias("own")
    own = nodes.join(found, "_node", "left").groupBy(F.coalesce("root", "_node").alias("root")).agg(least)
    own = written(own.select("own._node", F.col("own.least._id").alias("_id")))
    # Texts move once, rows equal in id and text merged before. Kept rows grow with the corpus: they
    # are merged, never broadcast, at every size.
    rows = keyed.groupBy("_node", "_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return rows.join(own.hint("merge"), ["_node", "_id"], "left_semi").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(docs, pii.redacted(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", best_fit_packing),
]

#: A trained model, fingerprints and a tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir; a stage's table goes once the next is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return docs
