"""A store of result tables: sorted over all files, described by a manifest that is written last, opened again as tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Columns that order a table, as far as it has them.
ORDER = ("contrast", "INDEX", "PEPTIDE_ID", "PREC_ID", "Sample", "CONDITION", "a", "b")
MANIFEST = "manifest"


def write_store(tables: dict[str, DataFrame], folder: str) -> None:
    """Write each table range-partitioned and sorted by ``ORDER``, then the manifest: name, order, rows and schema of each.

    Files hold ranges of keys that don't overlap, sorted inside, so that a reader of one feature or contrast skips all
    others by the statistics of the files. Rows are counted while they are written. A store is complete once its
    manifest is there; an older one in the same folder loses its manifest first.
    """
    if not tables:
        raise ValueError("no tables to store")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([], "name string, keys array<string>, rows long, schema string").write.mode("overwrite").json(f"{folder}/{MANIFEST}")
    lines = []
    for name, df in tables.items():
        keys = [c for c in ORDER if c in df.columns]
        seen = Observation()
        ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
        ordered.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{folder}/{name}")
        lines.append((name, keys, seen.get["rows"], df.schema.json()))
    # one row a table
    spark.createDataFrame(lines, "name string, keys array<string>, rows long, schema string").coalesce(1).write.mode("overwrite").json(f"{folder}/{MANIFEST}")


def open_store(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored tables by name; raises where there is no finished store. Nothing is read until a table is used."""
    lines = spark.read.schema("name string, keys array<string>, rows long, schema string").json(f"{folder}/{MANIFEST}").collect()  # one row a table
    if not lines:
        raise ValueError(f"{folder} holds no finished store")
    return {r["name"]: spark.read.schema(StructType.fromJson(json.loads(r["schema"]))).parquet(f"{folder}/{r['name']}") for r in lines}


def check_store(spark: SparkSession, folder: str) -> None:
    """Raise where a table has other rows than the manifest says."""
    lines = spark.read.schema("name string, keys array<string>, rows long, schema string").json(f"{folder}/{MANIFEST}").collect()
    wrong = {r["name"]: (r["rows"], n) for r in lines if (n := open_store(spark, folder)[r["name"]].count()) != r["rows"]}
    if wrong:
        raise ValueError(f"rows that should be there and that are: {wrong}")
