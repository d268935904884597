"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset a temporary folder, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master")
        if master != "local" and not master.startswith("local["):
            raise ValueError("a cluster needs spark.checkpoint.dir: a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _local_roots.setdefault(app, "file://" + tempfile.mkdtemp(prefix="spark-"))
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: lineage ends here, and a lost executor costs a reread."""
    spark, path = df.sparkSession, f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_file(uri: str) -> pa.Table:
    """One file of a stored table, for workers."""
    files, path = pa.fs.FileSystem.from_uri(uri)
    return pa.parquet.ParquetFile(files.open_input_file(path)).read()
