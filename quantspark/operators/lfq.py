"""Ratio-based protein intensities: ions of a protein are shifted onto a common trace, whose median is the protein's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.functions.sequence import peptide_index

ION = "_ion"


def ions(df: DataFrame, most: int = 100) -> DataFrame:
    """INDEX, ion, Sample, v: log2 of an ion's positive signal, at most ``most`` ions a protein, the most complete and then strongest."""
    key = F.concat_ws("/", peptide_index(F.col("PEPTIDE_LSEQ")), F.col("CHARGE").cast("string")) if "CHARGE" in df.columns else peptide_index(F.col("PEPTIDE_LSEQ"))
    cells = df.groupBy("INDEX", key.alias(ION), F.col("FILENAME").alias("Sample")).agg(F.sum(F.when(F.col("SIGNAL") > 0, F.col("SIGNAL"))).alias("s")).filter("s IS NOT NULL")
    cells = cells.withColumn("v", F.log2("s")).drop("s")
    own = cells.groupBy("INDEX", ION).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("t"))
    rank = F.row_number().over(Window.partitionBy("INDEX").orderBy(F.desc("n"), F.desc("t"), ION))
    return cells.join(own.withColumn("rank", rank).filter(F.col("rank") <= most).select("INDEX", ION, "rank"), ["INDEX", ION])


def shifted(cells: DataFrame) -> DataFrame:
    """Shift every ion by the median of (reference trace - ion) over shared samples.

    The reference trace of a protein is the mean of its two most complete ions, the second moved onto the first by the
    median of their differences; without shared samples an ion stays where it is.
    """
    first = cells.filter("rank = 1").select("INDEX", "Sample", F.col("v").alias("a"))
    second = cells.filter("rank = 2").select("INDEX", "Sample", F.col("v").alias("b"))
    both = first.join(second, ["INDEX", "Sample"], "full_outer")
    move = F.coalesce(F.median(F.col("a") - F.col("b")).over(Window.partitionBy("INDEX")), F.lit(0.0))
    trace = both.withColumn("b", F.col("b") + move).select("INDEX", "Sample", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), (F.col("a") + F.col("b")) / 2).otherwise(F.coalesce("a", "b")).alias("ref"))
    joined = cells.join(trace, ["INDEX", "Sample"], "left")
    shift = F.coalesce(F.median(F.col("ref") - F.col("v")).over(Window.partitionBy("INDEX", ION)), F.lit(0.0))
    return joined.withColumn("shifted", F.col("v") + shift)


def lfq(df: DataFrame, min_nonan: int = 1, most_ions: int = 100, out: str = "raw") -> DataFrame:
    """Protein value of a sample: median of shifted ions where at least ``min_nonan`` are there, scaled so that a protein's
    total equals that of its ions, in linear scale; cells without signal have no row."""
    moved = shifted(ions(df, most_ions))
    cell = moved.groupBy("INDEX", "Sample").agg(F.when(F.count("shifted") >= min_nonan, F.median("shifted")).alias("p"), F.sum(F.pow(F.lit(2.0), "v")).alias("ion_total"))
    whole = Window.partitionBy("INDEX")
    scale = F.sum("ion_total").over(whole) / F.sum(F.pow(F.lit(2.0), "p")).over(whole)
    return cell.withColumn(out, F.pow(F.lit(2.0), "p") * scale).filter(f"{out} IS NOT NULL AND {out} > 0").select("INDEX", "Sample", out)
