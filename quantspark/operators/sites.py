"""Peptide and modification-site indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.functions.sequence import aligned, doubles, first_long, longs, peptide_index, sites, strip_modifications
from quantspark.schema import require

POLICIES = {"explode": "explode", "duplicate": "explode", "retain": "retain"}


def peptido_index(df: DataFrame, collapse_oxidation: bool = True, collapse_all: bool = False) -> DataFrame:
    """INDEX is the normalized peptide; also its bare sequence and its parents."""
    require(df, "PEPTIDE_LSEQ")
    index = peptide_index(F.col("PEPTIDE_LSEQ"), collapse_oxidation, collapse_all)
    out = df.withColumns({"STRIPPED_SEQ": strip_modifications(F.col("PEPTIDE_LSEQ")), "INDEX": index, "PARENT_PEPTIDE_ID": index})
    out = out.withColumn("PARENT_PROTEIN", F.col("UNIPROT") if "UNIPROT" in df.columns else F.lit(None).cast("string"))
    return out if "ASSAY" in df.columns else out.withColumn("ASSAY", F.lit("FLOWTHROUGH"))


def gate_sites(df: DataFrame) -> DataFrame:
    """Only rows that declare a site."""
    return df.filter(F.trim("PTM_SITES_STR") != "")


def _parsed(df: DataFrame) -> DataFrame:
    require(df, "UNIPROT", "PEP_SEQUENCE", "PEPTIDE_START", "PTM_PROTEINLOCATIONS", "PTM_POSITIONS_STR", "PTM_SITES_STR", "PTM_PROBS_STR")
    given = F.when(F.trim("PTM_PROBS_STR") != "", doubles(F.col("PTM_PROBS_STR"))).otherwise(F.array().cast("array<double>"))
    out = gate_sites(df).withColumns({"_positions": longs(F.col("PTM_POSITIONS_STR")), "_given": given})
    return out.withColumn("_probs", aligned(F.col("_given"), F.col("_positions"))).withColumn("_sites", sites(F.col("PTM_PROTEINLOCATIONS"))).drop("_given")


def _named(df: DataFrame, position: str, site: str) -> DataFrame:
    """INDEX and parents; temporary columns go."""
    out = df.withColumns({
        "PEPTIDE_INDEX": F.concat("PEP_SEQUENCE", F.lit("|p"), F.col(position).cast("string")),
        "INDEX": F.concat("UNIPROT", F.lit("|"), F.col(site)),
        "PARENT_PROTEIN": F.col("UNIPROT"), "PARENT_PEPTIDE_ID": F.col("PEP_SEQUENCE"), "ASSAY": F.lit("PHOSPHO"),
    })
    return out.drop(*(c for c in out.columns if c.startswith("_")))


def site_index(df: DataFrame, policy: str = "explode", pairing: str = "cross") -> DataFrame:
    """INDEX is protein|site.

    explode: one row for each candidate position and each protein site whose place in the peptide is a candidate.
    pairing "cross" pairs each candidate with each site (so n candidates give each site n rows, each with the
    candidate's probability); "aligned" pairs a site with its own candidate alone, and reads starts like "471;471".
    retain: one row for each peptide row, its sites joined, with the best probability.
    Probabilities over 1 are percentages; explicit zeros go (explode).
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; one of {', '.join(POLICIES)}")
    if pairing not in ("cross", "aligned"):
        raise ValueError("pairing is cross or aligned")
    parsed = _parsed(df)
    number = lambda s: F.substring(s, F.lit(2), F.length(s)).cast("long")
    if POLICIES[policy] == "retain":
        start = first_long(F.col("PEPTIDE_START"))
        there = parsed.withColumn("_kept", F.filter("_sites", lambda s: F.coalesce(F.array_contains("_positions", number(s) - start + 1), F.lit(False))))
        there = there.filter(F.size("_kept") > 0).withColumns({
            "_joined": F.array_join("_kept", ","), "_places": F.array_join(F.transform("_kept", lambda s: (number(s) - start + 1).cast("string")), ","), "LOC_PROB": F.array_max("_probs"),
        })
        return _named(there, "_places", "_joined")
    start = F.col("PEPTIDE_START").try_cast("long") if pairing == "cross" else first_long(F.col("PEPTIDE_START"))
    rows = parsed.withColumn("_candidate", F.explode(F.arrays_zip(F.col("_positions").alias("pos"), F.col("_probs").alias("prob"))))
    percent = F.col("_candidate.prob")
    rows = rows.withColumn("LOC_PROB", F.when(percent > 1, percent / 100).otherwise(percent)).filter("LOC_PROB IS NULL OR LOC_PROB > 0")
    rows = rows.withColumn("_site", F.explode("_sites")).withColumn("SITE_POS", number(F.col("_site")) - start + 1)
    rows = rows.filter((F.col("SITE_POS") >= 1) & F.array_contains("_positions", F.col("SITE_POS")))
    if pairing == "aligned":
        rows = rows.filter(F.col("_candidate.pos") == F.col("SITE_POS"))
    return _named(rows, "SITE_POS", "_site")


def check_index(df: DataFrame) -> DataFrame:
    """Raise where indexing left a null INDEX."""
    bad = df.filter(F.col("INDEX").isNull()).limit(20).toPandas()
    if len(bad):
        raise ValueError(f"null INDEX after indexing:\n{bad}")
    return df
