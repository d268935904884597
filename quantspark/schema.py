"""Canonical names and types of the long table, and column guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Canonical column -> type after harmonization.
CANONICAL: dict[str, T.DataType] = {
    "INDEX": T.StringType(), "SIGNAL": T.DoubleType(), "QVALUE": T.DoubleType(), "PEP": T.DoubleType(), "CONDITION": T.StringType(), "REPLICATE": T.LongType(),
    "FILENAME": T.StringType(), "SPECTRAL_COUNTS": T.DoubleType(), "FASTA_HEADERS": T.StringType(), "GENE_NAMES": T.StringType(), "PROTEIN_DESCRIPTIONS": T.StringType(),
    "PROTEIN_WEIGHT": T.DoubleType(), "IBAQ": T.StringType(), "PRECURSORS_EXP": T.LongType(), "PEPTIDE_LSEQ": T.StringType(), "PEP_SEQUENCE": T.StringType(),
    "UNIPROT": T.StringType(), "CHARGE": T.IntegerType(), "PEPTIDE_START": T.StringType(), "PTM_PROTEINLOCATIONS": T.StringType(), "PTM_SITES_STR": T.StringType(),
    "PTM_POSITIONS_STR": T.StringType(), "PTM_PROBS_STR": T.StringType(),
}

#: Configuration key -> canonical column.
CONFIG_COLUMNS: dict[str, str] = {
    "index_column": "INDEX", "signal_column": "SIGNAL", "qvalue_column": "QVALUE", "pep_column": "PEP", "condition_column": "CONDITION", "replicate_column": "REPLICATE",
    "filename_column": "FILENAME", "spectral_counts_column": "SPECTRAL_COUNTS", "fasta_column": "FASTA_HEADERS", "gene_names_column": "GENE_NAMES",
    "protein_descriptions_column": "PROTEIN_DESCRIPTIONS", "protein_weight_column": "PROTEIN_WEIGHT", "protein_weight": "PROTEIN_WEIGHT", "ibaq_column": "IBAQ",
    "precursors_exp_column": "PRECURSORS_EXP", "peptide_seq_column": "PEPTIDE_LSEQ", "stripped_seq_column": "PEP_SEQUENCE", "uniprot_column": "UNIPROT",
    "charge_column": "CHARGE", "peptide_start_column": "PEPTIDE_START", "ptm_proteinlocations_column": "PTM_PROTEINLOCATIONS", "ptm_sites_column": "PTM_SITES_STR",
    "ptm_positions_column": "PTM_POSITIONS_STR", "ptm_probabilities_column": "PTM_PROBS_STR",
}

#: Texts that stand for a missing value in delimited files.
NULL_TOKENS = ("NA", "NaN", "N/A", "")

ANALYSIS_TYPES = ("proteomics", "peptidomics", "phospho")
_ALIASES = {"proteo": "proteomics", "protein": "proteomics", "proteins": "proteomics", "peptido": "peptidomics", "phosphoproteomics": "phospho"}


def analysis_type(raw: str | None) -> str:
    """Normalize an analysis type; blank means proteomics."""
    name = (raw or "").strip().lower() or "proteomics"
    name = _ALIASES.get(name, name)
    if name not in ANALYSIS_TYPES:
        raise ValueError(f"unknown analysis type {raw!r}; one of {', '.join(ANALYSIS_TYPES)}")
    return name


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Raise if a column is missing; no job runs."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column, once at ingestion: Spark sorts NaN above all numbers and aggregates return it."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def canonical_types(df: DataFrame) -> DataFrame:
    """Cast canonical columns to their types; what can't be cast is null."""
    return nan_to_null(df.withColumns({c: F.col(c).try_cast(t) for c, t in CANONICAL.items() if c in df.columns and df.schema[c].dataType != t}))
