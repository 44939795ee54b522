"""Corpus pipeline: quality rules, SimHash near-dedup, decontamination, secret scans, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. ``run`` writes every
stage's result to the shared scratch folder and reads it back as the next one's docs. All stages but the
last return the columns of ``documents`` (extra columns travel along); the last returns the packed pieces.

Defined results: null, empty and word-less texts fail the quality rules; of a group of near copies the row
with the smallest doc_id stays (one row, also among repeated rows; null ids come last); an empty table gives
an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import best_fit, quality_llr, secret_scan, simhash_mih, winnow
from tidemark.llm.common import read_table, stage, with_row_id


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    while name in docs.columns:
        name += "_"
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and the log-likelihood ratio threshold."""
    judged = quality_llr.quality_rules(docs.select(F.struct("*").alias("__doc"), "doc_id", "text"),
                                       read_table(spark, sf_dir, "labels"))
    return judged.where("kept").select("__doc.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of fingerprints linked at 3 or fewer differing bits."""
    row = free_name(docs, "__row")
    rows = with_row_id(docs, row, "dedup-docs")
    found = simhash_mih.near_duplicates(rows, key=row)
    ids = found.join(rows.select(row, "doc_id"), row)
    first = ids.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("m"))
    # the dropped rows are the smaller side: whole texts are only shuffled when those are too many to broadcast
    others = stage(ids.select(row).join(first.select(F.col(f"m.{row}").alias(row)), row, "left_anti"), "dedup-others")
    return rows.join(others, row, "left_anti").drop(row)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    row = free_name(docs, "__row")
    rows = with_row_id(docs, row, "decontaminate-docs")
    found = winnow.contamination(rows, read_table(spark, sf_dir, "benchmark"), key=row)
    hit = stage(found.where("n_hit > 0").select(row), "decontaminate-hits")
    return rows.join(hit, row, "left_anti").drop(row)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; secrets in its text are replaced and n_chars follows."""
    return secret_scan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and offset."""
    return best_fit.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("best_fit_packing", best_fit_packing),
]

#: Hashed scores, components and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
