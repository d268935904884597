"""Quality tables: distributions, consistency, missed cleavages, missingness, spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.functions.sequence import missed_cleavage, peptide_index


def distributions(df: DataFrame, peptide: str = "PEPTIDE_LSEQ") -> DataFrame:
    """kind, key, n: precursors per peptide, peptides per protein, precursors per protein."""
    rows = df.select("INDEX", peptide_index(F.col(peptide)).alias("pep"), "CHARGE").dropna().distinct()
    of = lambda kind, key, n: rows.groupBy(F.col(key).alias("key")).agg(F.count_distinct(*n).alias("n")).select(F.lit(kind).alias("kind"), "key", "n")
    return of("precursors_per_peptide", "pep", ["CHARGE"]).union(of("peptides_per_protein", "INDEX", ["pep"])).union(of("precursors_per_protein", "INDEX", ["pep", "CHARGE"]))


def consistent(cells: DataFrame, samples: DataFrame, key: str) -> DataFrame:
    """INDEX, CONDITION, n: keys (peptides or precursors) of a feature with a value in every run of the condition."""
    runs = samples.groupBy("CONDITION").agg(F.count(F.lit(1)).alias("runs"))
    seen = cells.join(samples.select("Sample", "CONDITION"), "Sample").groupBy("INDEX", key, "CONDITION").agg(F.count("raw").alias("seen"))
    full = seen.join(runs, "CONDITION").withColumn("full", F.col("seen") == F.col("runs"))
    return full.groupBy("INDEX", "CONDITION").agg(F.count_if("full").alias("n"))


def missed_cleavages(df: DataFrame, sequence: str = "PEPTIDE_LSEQ", positive_only: bool = False) -> DataFrame:
    """Sample, fraction of peptides with a missed cleavage, and the same weighted by intensity; each peptide once a sample."""
    rows = df.filter("SIGNAL > 0") if positive_only else df
    peptides = rows.groupBy(F.col("FILENAME").alias("Sample"), F.col(sequence).alias("seq")).agg(F.sum("SIGNAL").alias("w"))
    flagged = peptides.withColumn("m", missed_cleavage(F.col("seq")).cast("double")).filter("m IS NOT NULL")
    return flagged.groupBy("Sample").agg(F.avg("m").alias("fraction"), (F.sum(F.col("w") * F.col("m")) / F.sum("w")).alias("weighted"))


def missing_counts(grid: DataFrame, samples: DataFrame, value: str = "raw") -> DataFrame:
    """INDEX, CONDITION, n_missing, n_observed over the complete grid."""
    at = grid.join(F.broadcast(samples.select("Sample", "CONDITION")), "Sample")  # a row a sample
    return at.groupBy("INDEX", "CONDITION").agg(F.count_if(F.col(value).isNull()).alias("n_missing"), F.count(value).alias("n_observed"))


def observed(counts: DataFrame, contrasts: DataFrame) -> DataFrame:
    """INDEX, contrast, max_observed: the larger number of observed values of a contrast's two sides."""
    a = counts.select("INDEX", F.col("CONDITION").alias("A"), F.col("n_observed").alias("n_a"))
    b = counts.select("INDEX", F.col("CONDITION").alias("B"), F.col("n_observed").alias("n_b"))
    return a.join(contrasts, "A").join(b, ["INDEX", "B"]).select("INDEX", "contrast", F.greatest("n_a", "n_b").alias("max_observed"))


def unique_peptides(df: DataFrame, peptide: str = "PEPTIDE_LSEQ") -> DataFrame:
    return df.groupBy("INDEX").agg(F.count_distinct(peptide_index(F.col(peptide))).alias("num_unique_peptides"))


def max_consistent(counts: DataFrame) -> DataFrame:
    return counts.groupBy("INDEX").agg(F.max("n").alias("max_consistent"))


def ids_per_sample(cells: DataFrame, value: str = "raw") -> DataFrame:
    return cells.groupBy("Sample").agg(F.count(value).alias("n_ids"))


def spread(cells: DataFrame, samples: DataFrame, value: str = "lognorm") -> DataFrame:
    """INDEX, grp, cv, rmad, mean, median, sd: over all samples ("Total") and for each condition; cv and rmad are
    percentages in linear scale, the rest is in log scale."""
    at = cells.filter(F.col(value).isNotNull()).join(samples.select("Sample", "CONDITION"), "Sample")
    both = at.select("INDEX", F.explode(F.array(F.lit("Total"), F.col("CONDITION"))).alias("grp"), F.col(value).alias("v"), F.pow(F.lit(2.0), value).alias("x"))
    med = both.withColumn("mx", F.median("x").over(Window.partitionBy("INDEX", "grp")))
    floor = F.lit(1e-6)
    return med.groupBy("INDEX", "grp").agg(
        (100 * F.stddev_pop("x") / F.greatest(F.avg("x"), floor)).alias("cv"),
        (100 * F.median(F.abs(F.col("x") - F.col("mx"))) / F.greatest(F.first("mx"), floor)).alias("rmad"),
        F.avg("v").alias("mean"), F.median("v").alias("median"), F.stddev_samp("v").alias("sd"),
    )


def feature_profile(cells: DataFrame, samples: DataFrame, index: str, values: list[str]) -> DataFrame:
    """Per-condition means of one feature's layers; the filter reaches the scan."""
    return cells.filter(F.col("INDEX") == index).join(samples.select("Sample", "CONDITION"), "Sample").groupBy("INDEX", "CONDITION").agg(*(F.avg(v).alias(v) for v in values))


def missing_flags(grid: DataFrame, value: str = "raw") -> DataFrame:
    """INDEX, Sample, missing (1 where null)."""
    return grid.select("INDEX", "Sample", F.col(value).isNull().cast("int").alias("missing"))
