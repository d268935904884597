"""Writers of results and assembly of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.functions.sequence import first_part
from quantspark.operators.reshape import pivot_cells


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One dataset a table; statistics are partitioned by contrast, so that a reader of one contrast skips the rest."""
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt is parquet or csv")
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if "contrast" in df.columns and fmt == "parquet":
            writer = writer.partitionBy("contrast")
        writer.save(f"{folder}/{name}", format=fmt, **({"header": True} if fmt == "csv" else {}))


def identification_tables(cells: DataFrame, samples: list[str], layers: tuple[str, ...] = ("qvalue", "pep", "spectral_counts", "ibaq")) -> dict[str, DataFrame]:
    """Feature x sample tables of the evidence layers that are there."""
    return {x: pivot_cells(cells, x, samples) for x in layers if x in cells.columns}


def consistency_table(features: DataFrame, consistent: DataFrame, conditions: list[str], prefix: str = "CONSISTENT_PEPTIDE_") -> DataFrame:
    """Feature metadata with one count column for each condition, 0 where nothing is consistent."""
    wide = consistent.groupBy("INDEX").pivot("CONDITION", conditions).agg(F.first("n")).withColumnsRenamed({c: prefix + c for c in conditions})
    return features.join(wide, "INDEX", "left").fillna(0, [prefix + c for c in conditions])


def annotated_table(cells: DataFrame, features: DataFrame, key: str, samples: list[str], value: str = "raw") -> DataFrame:
    """Peptides or precursors x samples, with what is known of the protein that their key names before the first bar.

    A site's feature is itself "protein|site"; there the protein's own row is missed and the feature's is taken.
    One aggregation makes all columns: a pivot takes two, whose tables a task holds at once.
    """
    wide = cells.groupBy("INDEX", key).agg(*(F.max(F.when(F.col("Sample") == s, F.col(value))).alias(s) for s in samples))
    return wide.withColumn("PROTEIN", first_part(F.col(key))).join(features, "INDEX", "left")


def summary_table(features: DataFrame, stats: DataFrame, contrasts: list[str], values: tuple[str, ...] = ("log2fc", "p", "q")) -> DataFrame:
    """One row a feature: metadata, then <VALUE>_<contrast> columns."""
    wide = stats.groupBy("INDEX").pivot("contrast", contrasts).agg(*(F.first(v).alias(v) for v in values))
    named = {f"{c}_{v}": f"{v.upper()}_{c}" for c in contrasts for v in values}
    order = [f"{v.upper()}_{c}" for v in values for c in contrasts]
    return features.join(wide.withColumnsRenamed(named).select("INDEX", *order), "INDEX", "left")
