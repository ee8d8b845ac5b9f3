"""A corpus for training from `documents`: quality rules, line dedup, near-duplicate join, decontamination and mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs, whatever else
these may hold.  Rows that are equal in all columns are treated alike; null texts fail the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kaigi.llm import decontaminate, jaccard_join, line_dedup, mixing, quality
from kaigi.llm.exchange import settled, sized


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that base rules and adaptive thresholds keep."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that 10 documents or more hold, only the first occurrence stays; documents left without a word go."""
    kept = line_dedup.dedup_lines(docs, keep_first=True)
    return kept.where(F.col("text").rlike(quality.WORD))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles, the smallest doc_id stays;
    of equal ids, all rows do.  Rows without a doc_id stay."""
    name = line_dedup.free_name(docs, "near")
    found = settled(jaccard_join.similar_components(docs, k=5, percent=80).where("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct())
    return docs.join(sized(found), docs["doc_id"] == found[name], "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with substitutions or without, go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time that a document is taken: its columns and epoch, n_tokens and n_taken.  Where a leaf's prefix ends
    inside a document, its text is cut to the n_taken words."""
    taken = mixing.mix(docs, mixing.domain_of(docs), mixing.WEIGHTS, mixing.SHARE, mixing.EPOCHS, mixing.ORDER_SEED)
    # equal rows are taken each for itself, so each is met by one row of the plan only
    taken = taken.groupBy("doc_id", "row", "epoch", "tokens").agg(F.max("n_taken").alias("n_taken"))
    name = line_dedup.free_name(docs, "mix")
    plan = taken.select(F.col("doc_id").alias(f"{name}_id"), F.col("row").alias(f"{name}_row"), F.struct("epoch", F.col("tokens").alias("n_tokens"), "n_taken").alias(name))
    joined = docs.join(plan, docs["doc_id"].eqNullSafe(plan[f"{name}_id"]) & (F.xxhash64(docs["text"]) == plan[f"{name}_row"]))
    text = F.when(F.col(f"{name}.n_taken") < F.col(f"{name}.n_tokens"), mixing.cut(F.col("text"), F.col(f"{name}.n_taken"))).otherwise(F.col("text")).alias("text")
    columns = [text if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, *(F.col(f"{name}.{c}").alias(line_dedup.free_name(docs, c)) for c in ("epoch", "n_tokens", "n_taken")))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: No SQL: verification of overlaps and components in one statement over all stages; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settled(docs)
    return docs
