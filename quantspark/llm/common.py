"""Helpers that the operators share: shared scratch tables and column guards."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}
#: Where the C library can give freed memory back; None elsewhere.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where that is unset a temporary one, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master")
        if master != "local" and not master.startswith("local["):
            raise ValueError("a cluster needs spark.checkpoint.dir: a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _local_roots.setdefault(app, "file://" + tempfile.mkdtemp(prefix="spark-"))
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """A batch's rows in order, in slices of at most about so many bytes (one row at least), so that a worker's memory
    follows neither the batch nor its longest texts."""
    step = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
    for a in range(0, batch.num_rows, step):
        yield batch.slice(a, step)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its tasks, and what one stage freed would stay its size for the next."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def small_batches(spark: SparkSession, most: int = 1000) -> None:
    """Let Arrow batches hold at most so many rows: texts are long, and both sides of a worker's pipe hold whole batches.

    A setting of the session, as batches are cut when a query runs; a smaller one that is set already stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > most:
        spark.conf.set(name, str(most))


def mounted(path: str) -> str:
    """The same folder as a path that ``numpy.memmap`` can open; only file systems mounted on every worker have one."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {path}")
    return parts.path


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def meet(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of equal names, where null is a value like any other; each name is kept once, from ``a``."""
    b = b.select(*[col(c).alias(f"_other_{c}") if c in on else col(c) for c in b.columns])
    same = functools.reduce(lambda x, y: x & y, [col(c).eqNullSafe(col(f"_other_{c}")) for c in on])
    return a.join(b, same, how).drop(*[f"_other_{c}" for c in on])
