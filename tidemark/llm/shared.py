"""Tables and names that several operators of this subpackage need.

Intermediate results are Parquet tables in the folder that the cluster names
in ``spark.checkpoint.dir``: every executor sees them, they cut lineage, and a
lost executor loses nothing.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, a temporary one of a local session; a cluster has to name one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` once to the shared folder, in one folder for each value of the columns ``by``, and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing will read again."""
    for df in tables:
        delete_path(df.sparkSession, df._tidemark_path)


def delete_path(spark: SparkSession, where: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made different from every column of ``df`` (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Give the memory that this process has freed back to the system, where the C library can. Else a driver keeps what a fit took once."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(ctypes.c_size_t(0))
