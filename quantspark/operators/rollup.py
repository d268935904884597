"""Roll-ups of the long table to feature x sample cells, and feature metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.functions.sequence import array_mean, doubles, peptide_index
from quantspark.schema import require
from quantspark.sources.scratch import stored

Aggregate = Callable[[str], Column]
#: Null where a cell has no value; count then counts all rows, those without a value included.
AGGREGATES: dict[str, Aggregate] = {
    "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "median": F.median,
    "count": lambda c: F.when(F.count(c) > 0, F.count(F.lit(1))).cast("double"),
}
#: Names a configuration may use for the protein roll-up.
METHODS = (*AGGREGATES, "top3", "topn", "directlfq", "lfq")


def aggregate_of(method: str | None) -> Aggregate:
    name = (method or "sum").lower()
    if name not in AGGREGATES:
        raise ValueError(f"unknown roll-up {method!r}; one of {', '.join(METHODS)}")
    return AGGREGATES[name]


def roll_up(df: DataFrame, method: str = "sum", value: str = "SIGNAL", key: str = "INDEX", out: str = "raw") -> DataFrame:
    """INDEX, Sample and one aggregate of all rows of a cell."""
    require(df, key, "FILENAME", value)
    return df.groupBy(F.col(key).alias("INDEX"), F.col("FILENAME").alias("Sample")).agg(aggregate_of(method)(value).alias(out))


def top_n(df: DataFrame, n: int = 3, peptide: str = "PEPTIDE_LSEQ", out: str = "raw") -> DataFrame:
    """Sum of the n largest peptide sums of a cell by dense rank: ties at the nth keep all of them."""
    sums = df.groupBy("INDEX", F.col("FILENAME").alias("Sample"), peptide_index(F.col(peptide)).alias("_pep")).agg(F.sum("SIGNAL").alias("_s")).filter("_s IS NOT NULL")
    rank = F.dense_rank().over(Window.partitionBy("INDEX", "Sample").orderBy(F.desc("_s")))
    return sums.withColumn("_r", rank).filter(F.col("_r") <= n).groupBy("INDEX", "Sample").agg(F.sum("_s").alias(out))


def evidence_cells(df: DataFrame, phospho: bool = False) -> DataFrame:
    """All evidence layers of a cell in one aggregation: mean q-value, PEP and precursors (largest for phospho), largest spectral count and localization, mean iBAQ."""
    layers: list[Column] = []
    for source, name in (("QVALUE", "qvalue"), ("PEP", "pep")):
        if source in df.columns:
            layers.append(F.avg(source).alias(name))
    if "PRECURSORS_EXP" in df.columns:
        layers.append((F.max if phospho else F.avg)(F.col("PRECURSORS_EXP").cast("double")).alias("precursors"))
    if "SPECTRAL_COUNTS" in df.columns:
        layers.append(F.max("SPECTRAL_COUNTS").alias("spectral_counts"))
    if "LOC_PROB" in df.columns:
        layers.append(F.max("LOC_PROB").alias("LOC_PROB"))
    if "IBAQ" in df.columns:
        layers.append(F.avg(array_mean(doubles(F.col("IBAQ").cast("string")))).alias("ibaq"))
    cells = df.groupBy("INDEX", F.col("FILENAME").alias("Sample"))
    return cells.agg(*layers) if layers else cells.agg(F.lit(None).alias("_none")).drop("_none")


def site_counts(df: DataFrame) -> DataFrame:
    """Distinct peptide/charge pairs of a cell."""
    return df.groupBy("INDEX", F.col("FILENAME").alias("Sample")).agg(F.count_distinct(F.concat("PEPTIDE_LSEQ", F.lit("/"), F.col("CHARGE").cast("string"))).alias("spectral_counts"))


def features(df: DataFrame, columns: list[str], order: list[str], peptide: str = "PEPTIDE_LSEQ") -> DataFrame:
    """One row a feature: each column's first non-null value by ``order`` (the least of those at the first place), filled gene names, precursors used, mean iBAQ."""
    there = [c for c in columns if c in df.columns]
    out = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_value")))).alias(c) for c in there]
    if peptide in df.columns and "CHARGE" in df.columns:
        out.append(F.count_distinct(peptide, "CHARGE").alias("PRECURSORS_USED"))
    if "IBAQ" in df.columns:
        out.append(F.avg(array_mean(doubles(F.col("IBAQ").cast("string")))).alias("IBAQ_MEAN"))
    table = df.filter("INDEX IS NOT NULL").groupBy("INDEX").agg(*out)
    if "GENE_NAMES" in there:
        blank = F.trim("GENE_NAMES").isin("", "NA", "NaN", "nan") | F.col("GENE_NAMES").isNull()
        table = table.withColumn("GENE_NAMES", F.when(blank, F.col("INDEX")).otherwise(F.col("GENE_NAMES")))
    return table


def peptide_cells(df: DataFrame, method: str = "sum", sequence: str = "PEPTIDE_LSEQ") -> DataFrame:
    """PEPTIDE_ID (feature|sequence), INDEX, Sample, raw and raw divided by the peptide's mean over samples."""
    rows = df.withColumn("_seq", peptide_index(F.col(sequence))).filter("INDEX IS NOT NULL AND _seq IS NOT NULL")
    cells = rows.groupBy("INDEX", F.col("_seq").alias("PEPTIDE_SEQ"), F.col("FILENAME").alias("Sample")).agg(aggregate_of(method)("SIGNAL").alias("raw"))
    return centred(cells.withColumn("PEPTIDE_ID", F.concat("INDEX", F.lit("|"), "PEPTIDE_SEQ")), "PEPTIDE_ID")


def precursor_cells(df: DataFrame, method: str = "sum", sequence: str = "PEPTIDE_LSEQ") -> DataFrame:
    """PREC_ID (feature|sequence/+charge), INDEX, Sample, raw and centred."""
    rows = df.withColumn("_seq", peptide_index(F.col(sequence))).filter("INDEX IS NOT NULL AND _seq IS NOT NULL AND CHARGE IS NOT NULL")
    cells = rows.groupBy("INDEX", "_seq", "CHARGE", F.col("FILENAME").alias("Sample")).agg(aggregate_of(method)("SIGNAL").alias("raw"))
    key = F.concat("INDEX", F.lit("|"), "_seq", F.lit("/+"), F.col("CHARGE").cast("string"))
    return centred(cells.withColumn("PREC_ID", key).withColumnRenamed("_seq", "PEPTIDE_SEQ"), "PREC_ID")


def centred(cells: DataFrame, key: str, value: str = "raw", out: str = "centred") -> DataFrame:
    """Divide by the row mean, nulls ignored."""
    return cells.withColumn(out, F.col(value) / F.avg(value).over(Window.partitionBy(key)))


def covariate_cells(df: DataFrame, method: str = "mean", key: str = "PARENT_PROTEIN") -> DataFrame:
    """Roll-up of covariate rows by parent protein; rows without a parent go."""
    return roll_up(df.filter(F.col(key).isNotNull()), method, key=key, out="covariate").withColumnRenamed("INDEX", key)


def with_covariate(cells: DataFrame, parents: DataFrame, covariate: DataFrame, key: str = "PARENT_PROTEIN") -> DataFrame:
    """Each feature gets its parent's covariate cell of the aligned sample.

    The covariate is written first, so that Spark sees its size: few parents are broadcast, and no key of theirs gathers the cells.
    """
    return cells.join(parents.select("INDEX", key), "INDEX", "left").join(stored(covariate, "covariate"), [key, "Sample"], "left")
