"""Readers of tables, annotations and contaminant lists."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.functions.sequence import strip_extension
from quantspark.operators.annotate import infer_replicates
from quantspark.schema import NULL_TOKENS, nan_to_null

#: Headers whose columns are numbers whatever they hold.
NUMERIC_HEADERS = re.compile(r"Qvalue|Pvalue|\.PEP$|^PEP$")
#: Columns that may name the run in an annotation, in order of preference.
RUN_COLUMNS = ("FILENAME", "File Name", "File name", "filename", "Filename", "Channel")


def read_table(spark: SparkSession, path: str, numeric: list[str] | None = None) -> DataFrame:
    """Parquet, CSV or TSV by suffix; in delimited files NA, NaN, N/A and blanks are null, and q-value, p-value and PEP columns numbers.

    Delimited columns are read as text and ``numeric`` ones cast, so that no inference pass reads the file twice.
    """
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix in ("parquet", "pq"):
        return nan_to_null(spark.read.parquet(path))
    if suffix not in ("csv", "tsv", "txt"):
        raise ValueError(f"unknown suffix of {path}; parquet, pq, csv, tsv or txt")
    raw = spark.read.csv(path, sep="," if suffix == "csv" else "\t", header=True, inferSchema=False)
    known = {c: F.when(~F.trim(F.col(f"`{c}`")).isin(*NULL_TOKENS), F.col(f"`{c}`")) for c in raw.columns}
    as_number = {c for c in raw.columns if NUMERIC_HEADERS.search(c)} | set(numeric or [])
    return raw.select(*((x.try_cast("double") if c in as_number else x).alias(c) for c, x in known.items()))


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """FILENAME, CONDITION, REPLICATE of each run; replicates that are absent are counted by file name in each condition."""
    raw = read_table(spark, path)
    run = next((c for c in RUN_COLUMNS if c in raw.columns), None)
    if run is None or "Condition" not in raw.columns:
        raise ValueError("an annotation needs Condition and one of " + ", ".join(RUN_COLUMNS))
    replicate = F.col("Replicate") if "Replicate" in raw.columns else F.lit(None).cast("string")
    rows = raw.select(strip_extension(F.col(f"`{run}`")).alias("FILENAME"), F.trim("Condition").alias("CONDITION"), replicate.alias("REPLICATE"))
    return infer_replicates(rows.filter("FILENAME IS NOT NULL"))


def read_contaminants(spark: SparkSession, paths: list[str]) -> DataFrame:
    """accession of every FASTA header: the second |-field, or the first word where there are no bars."""
    head = F.substring("value", F.lit(2), F.length("value"))
    named = F.split(head, r"\|")
    accession = F.when(F.size(named) > 1, F.get(named, F.lit(1))).otherwise(F.get(F.split(head, r"\s+"), F.lit(0)))
    return spark.read.text(paths).filter(F.startswith("value", F.lit(">"))).select(F.trim(accession).alias("accession")).distinct()
