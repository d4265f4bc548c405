"""Training-data pipeline over ``documents``: toxicity, line dedup, near-duplicates,
decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it
kept. All but the last return the columns of ``documents``. :func:`run` writes each stage's
rows as Parquet to the shared folder and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontam, toxicity
from cadenza.llm.line_dedup import dedup_lines
from cadenza.llm.packing import pack
from cadenza.llm.setsketch import near_duplicates
from cadenza.sources.sinks import land_table
from cadenza.sources.tables import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose learned toxicity score is below one half."""
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.drop_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of three-line windows. Documents of which no
    visible character is left go; ``n_chars`` follows the text."""
    clean = dedup_lines(docs)
    gone = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    return clean.filter(~gone).select(*[
        F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        .cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else F.col(c)
        for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of every near-duplicate component, on
    5-word shingles at similarity 0.8."""
    verdict = near_duplicates(docs, shingle=5, pct=80)
    ids = verdict.filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["kept_id"]), "left_semi")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified test item."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 token ids, in curve order."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the learned model nor the tokenizer; tests use plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
