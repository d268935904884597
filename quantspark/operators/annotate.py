"""Run annotation, data contracts and the sample table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.functions.sequence import clean_label
from quantspark.operators.reshape import difference
from quantspark.schema import require


def infer_replicates(annotation: DataFrame) -> DataFrame:
    """Null replicates become 1..N by file name in each condition."""
    number = F.row_number().over(Window.partitionBy("CONDITION").orderBy("FILENAME"))
    return annotation.withColumn("REPLICATE", F.coalesce(F.col("REPLICATE").try_cast("long"), number.cast("long")))


def annotate(df: DataFrame, annotation: DataFrame) -> DataFrame:
    """Left join on FILENAME; the annotation's condition and replicate override. One row a run: small, so it is broadcast unless Spark sees it is large."""
    own = df.drop(*(c for c in ("CONDITION", "REPLICATE") if c in df.columns))
    return own.join(annotation.select("FILENAME", "CONDITION", "REPLICATE"), "FILENAME", "left")


def check_runs(df: DataFrame, annotation: DataFrame) -> None:
    """Runs of data and annotation must be the same."""
    extra, lacking = (x.limit(20).toPandas()["FILENAME"].tolist() for x in difference(df, annotation, "FILENAME"))
    if extra or lacking:
        raise ValueError(f"runs without annotation: {extra}; annotated runs without data: {lacking}")


def check_headers(columns: list[str], runs: list[str], signal: str = "Intensity") -> None:
    """The same for wide headers, <run> or <run> <signal>."""
    there = {c.removesuffix(f" {signal}") for c in columns}
    if lacking := [r for r in runs if r not in there]:
        raise ValueError(f"annotated runs without a column: {lacking[:20]}")


def check_complete(df: DataFrame, *columns: str) -> DataFrame:
    """Raise where a column holds nulls."""
    counts = require(df, *columns).agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns)).first().asDict()
    if bad := {c: n for c, n in counts.items() if n}:
        raise ValueError(f"null values: {bad}")
    return df


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """column, nulls: what ``check_complete`` looks at."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "column", "nulls")


def replicate_mismatch(main: DataFrame, covariate: DataFrame) -> DataFrame:
    """Conditions whose numbers of replicates differ between the main and the covariate samples (0 where absent)."""
    a = main.groupBy("CONDITION").agg(F.count_distinct("Sample").alias("n_main"))
    b = covariate.groupBy("CONDITION").agg(F.count_distinct("Sample").alias("n_covariate"))
    both = a.join(b, "CONDITION", "full_outer").select("CONDITION", F.coalesce("n_main", F.lit(0)).alias("n_main"), F.coalesce("n_covariate", F.lit(0)).alias("n_covariate"))
    return both.filter("n_main <> n_covariate")


def sample_table(df: DataFrame) -> DataFrame:
    """One row a sample: cleaned condition, its original, replicate, covariate flag and the key that aligns main with covariate runs."""
    first = lambda c: F.min(c).alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
    flag = F.max(F.coalesce("IS_COVARIATE", F.lit(False))) if "IS_COVARIATE" in df.columns else F.lit(False)
    rows = df.groupBy(F.col("FILENAME").alias("Sample")).agg(first("CONDITION"), first("REPLICATE"), first("ASSAY"), flag.alias("IS_COVARIATE"))
    rows = rows.withColumn("CONDITION_ORIG", F.col("CONDITION")).withColumn("CONDITION", clean_label(F.col("CONDITION")))
    return rows.withColumn("ALIGN_KEY", F.concat("CONDITION", F.lit("#R"), F.col("REPLICATE").cast("string")))


def covariate_assays(df: DataFrame) -> DataFrame:
    """Assays that flagged rows belong to."""
    return df.filter(F.coalesce("IS_COVARIATE", F.lit(False))).select(F.lower("ASSAY").alias("ASSAY")).dropna().distinct()
