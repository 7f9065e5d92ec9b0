"""Corpus pipeline over ``documents``: quality rules, line dedup, near-duplicate
removal, mixing to source weights, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet under the session's shared folder and reads back as the next stage's ``docs``. All
but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pharmaflow.llm.common import saved_alone, table
from pharmaflow.llm.line_dedup import line_dedup
from pharmaflow.llm.minhash import without_near_duplicates
from pharmaflow.llm.mixing import mixed_rows
from pharmaflow.llm.quality_rules import passing
from pharmaflow.llm.sentencepiece_scan import encode


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; ``n_chars`` follows the text."""
    out = line_dedup(docs)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_rows(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row."""
    return encode(docs).select("row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality_rules), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("sentencepiece", pieces)]

#: Near-duplicate classes and byte-pair pieces are not expressible in SQL;
#: tests/llm/test_pipeline.py holds the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What a stage has written on its way is deleted once its
    rows are there."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
