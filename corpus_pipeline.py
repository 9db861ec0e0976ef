"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. The
result is written as Parquet in the shared folder and read again, so a lost executor costs no
earlier stage. All but the last return the columns of ``documents``.

In every stage a null text counts as empty, and stays null where the row stays; empty texts are
near duplicates of each other, and have no hit, no span and a score like any other text. Texts of
any length are read whole. Repeated rows and ids are rows of their own; ties of near duplicates
go to the least id, then to the first row. An empty table stays empty. Columns beyond those of
``documents``, of any name, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.llm import decontaminate, packing, pii, simhash, toxicity
from plenum.llm.common import discard, free_name, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at the threshold or above go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "toxic_score")
    return toxicity.score_documents(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the least id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a hit of a benchmark window go. Rows are told apart by place, not by id."""
    row = free_name(docs, "row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    judged = decontaminate.decontaminate(rows.select(F.col(row).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = judged.where("contaminated").select(F.col("doc_id").alias(row))
    return rows.join(hit, row, "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are masked; every document stays, ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.coalesce(n_chars, F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, packed; one row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: The stages hash, score and decode in ways SQL does not express; tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
