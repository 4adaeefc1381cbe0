"""Transactional writes to a table of files: rows first, then one manifest entry that makes them visible.

A transaction is written under its own folder, so repeating it (a task or a
whole batch that runs again) replaces its rows instead of adding to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _mark(spark: SparkSession, path: str, txn_id: str, state: str) -> None:
    spark.range(1).select(F.lit(state).alias("txn_state")).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/txn_id={txn_id}")


def begin(rows: DataFrame, path: str, txn_id: str, flush: int = 0) -> None:
    """Write the rows of a transaction, a file for every ``flush`` of them; nobody who reads committed rows sees them yet."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", flush).parquet(f"{path}/data/txn_id={txn_id}")


def commit(spark: SparkSession, path: str, txn_id: str) -> None:
    _mark(spark, path, txn_id, "committed")


def abort(spark: SparkSession, path: str, txn_id: str) -> None:
    _mark(spark, path, txn_id, "aborted")


def write(rows: DataFrame, path: str, txn_id: str) -> None:
    begin(rows, path, txn_id)
    commit(rows.sparkSession, path, txn_id)


def write_each(rows: DataFrame, path: str, txn: str) -> None:
    """Write many transactions in one pass, each row into the one that its column ``txn`` names."""
    named = rows.withColumnRenamed(txn, "txn_id")
    kept = {"partitionOverwriteMode": "dynamic"}
    named.write.mode("overwrite").options(**kept).partitionBy("txn_id").parquet(f"{path}/data")
    ends = named.select("txn_id").distinct().select(F.lit("committed").alias("txn_state"), "txn_id")
    ends.write.mode("overwrite").options(**kept).partitionBy("txn_id").parquet(f"{path}/manifest")


def states(spark: SparkSession, path: str) -> DataFrame:
    """(txn_id, txn_state) of all transactions that have ended."""
    return spark.read.schema("txn_state string, txn_id string").parquet(f"{path}/manifest")


def read(spark: SparkSession, path: str, isolation: str = "read_committed") -> DataFrame:
    """The rows with ``txn_id`` and ``txn_state`` (open without an entry); committed ones only unless asked for all."""
    data = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data").withColumn("txn_id", F.col("txn_id").cast("string"))
    out = data.join(states(spark, path), "txn_id", "left").withColumn("txn_state", F.coalesce("txn_state", F.lit("open")))
    return out if isolation == "read_uncommitted" else out.where("txn_state = 'committed'")
