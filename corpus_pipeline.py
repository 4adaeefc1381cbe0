"""A training-data pipeline of five operators over the whole of ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. ``run`` writes each stage's rows to the shared folder as Parquet and
rereads them, so a lost executor costs at most one stage's tasks.

Defined results of all stages: an empty table gives an empty one, extra columns stay as
they are whatever their names, very long texts are worked on whole, and rows are told
apart as the operators' docstrings say. Repeated rows are judged alike; of those with
one id and text the near-duplicate stage keeps one. Rows without an id stay where a
decision needs one (near duplicates, decontamination). A null or empty text fails the
quality rules and so goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, quality, tokens, toxicity
from tidemark.llm.shared import drop, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, with digests that show that decoding gives the text back."""
    return tokens.round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("round_trips"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", clean),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop(before)
        before = docs
    return docs


#: Toxicity, templates and token ids can't be expressed in SQL; tests/llm runs the pipeline against a brute-force version.
ORACLE_SQL = None
