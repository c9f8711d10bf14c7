"""A corpus pipeline of the operators: each stage works on what the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medledger.llm import packing, secrets, simhash, toxicity
from medledger.llm.common import read_table, shared_folder


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.7. The model learns from the labelled documents among docs."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, 3 bits): of the smallest doc_id, the least fingerprint.

    Rows that repeat a doc_id and its text are one document, of which one row stays; rows that share a doc_id alone are
    documents of their own. Rows without a doc_id belong to no group and all stay. Null and empty texts are one group. No
    rows: none. The groups come from narrow rows; each text is shuffled once, repeats of a row folded before that.
    """
    named = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # no name of the caller's can clash
    doc_id, text = (named[f"c{docs.columns.index(c)}"] for c in ("doc_id", "text"))
    text_hash = F.xxhash64(F.coalesce(text, F.lit("")))
    found = simhash.near_duplicates(named.select(doc_id.alias("doc_id"), text.alias("text"), text_hash.alias("h")), tag=F.col("h"))
    first = (
        found.filter("doc_id = component_id")
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "fp", "tag")).alias("least"))
        .select(F.col("least.doc_id").alias("keep_id"), F.col("least.tag").alias("keep_hash"))
    )
    with_id = named.filter(doc_id.isNotNull()).withColumns({"h": text_hash, "d": doc_id.cast("long")})
    one_row = F.row_number().over(Window.partitionBy("d", "h").orderBy(F.lit(0)))
    kept = (
        with_id.withColumn("row", one_row)
        .filter("row = 1")
        .join(first, (F.col("d") == F.col("keep_id")) & (F.col("h") == F.col("keep_hash")), "left_semi")
        .select(named.columns)
    )
    return kept.union(named.filter(doc_id.isNull())).toDF(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what looks like a secret replaced by a mark."""
    return secrets.redact(docs, secrets.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token windows that hold the documents."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", keep_one_of_each_group),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: Compression distances, automata and packing have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents; what a stage returns is a written table, read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{k}")
    return docs
