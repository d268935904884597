"""Row filters, their fixed chain, and diagnostics of what each kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.schema import require


def exclude_runs(df: DataFrame, runs: list[str] | str | None) -> DataFrame:
    """Drop rows of the named runs; unknown names don't matter."""
    names = [runs] if isinstance(runs, str) else list(runs or [])
    return df.filter(F.col("FILENAME").isNull() | ~F.col("FILENAME").isin(names)) if names else df


def contaminants(df: DataFrame, accessions: DataFrame) -> DataFrame:
    """Drop features any member of whose ;-group is a known accession; a null INDEX goes too.

    Groups are exploded by distinct INDEX and matched by join, so that the list may be long.
    """
    members = df.select("INDEX").distinct().select("INDEX", F.explode(F.split("INDEX", ";")).alias("m"))
    bad = members.join(accessions.select(F.col("accession").alias("a")), F.trim("m") == F.col("a"), "left_semi").select("INDEX").distinct()
    return df.filter(F.col("INDEX").isNotNull()).join(bad, "INDEX", "left_anti")


def score_filter(df: DataFrame, column: str, threshold: float, direction: str = "lower") -> DataFrame:
    """Keep rows at or below the threshold (or at or above); null scores go. Without the column nothing happens."""
    if column not in df.columns:
        return df
    return df.filter(_score(column, threshold, direction))


def _score(column: str, threshold: float, direction: str) -> Column:
    if direction not in ("lower", "higher"):
        raise ValueError("direction is lower or higher")
    return F.col(column) <= threshold if direction == "lower" else F.col(column) >= threshold


def evidence_filter(df: DataFrame, least: int | None) -> DataFrame:
    """Keep PRECURSORS_EXP >= ``least``; skipped without a positive threshold, without the column, or if it holds nothing."""
    if not least or least <= 0 or "PRECURSORS_EXP" not in df.columns or df.filter("PRECURSORS_EXP IS NOT NULL").isEmpty():
        return df
    return df.filter(F.col("PRECURSORS_EXP") >= least)


def censor(df: DataFrame, threshold: float | None) -> DataFrame:
    """SIGNAL below the threshold becomes null; the row stays."""
    return df.withColumn("SIGNAL", F.when(F.col("SIGNAL") >= threshold, F.col("SIGNAL"))) if threshold is not None else df


def split_covariate(df: DataFrame, assays: list[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Main and covariate rows: by flag (null: main), else by assay, else no split."""
    if "IS_COVARIATE" in df.columns:
        flag = F.coalesce("IS_COVARIATE", F.lit(False))
    elif assays and "ASSAY" in df.columns:
        flag = F.coalesce(F.lower("ASSAY").isin([a.lower() for a in assays]), F.lit(False))
    else:
        return df, None
    return df.filter(~flag), df.filter(flag)


@dataclass(frozen=True)
class FilterSettings:
    qvalue: float | None = 0.01
    pep: float | None = 0.2
    pep_direction: str = "lower"
    min_precursors: int | None = None
    min_linear_intensity: float | None = None


def filter_chain(df: DataFrame, settings: FilterSettings, accessions: DataFrame | None = None) -> DataFrame:
    """Contaminants, q-value, PEP, run evidence, censoring, in this order."""
    if accessions is not None:
        df = contaminants(df, accessions)
    if settings.qvalue is not None:
        df = score_filter(df, "QVALUE", settings.qvalue)
    if settings.pep is not None:
        df = score_filter(df, "PEP", settings.pep, settings.pep_direction)
    return censor(evidence_filter(df, settings.min_precursors), settings.min_linear_intensity)


def filter_blocks(df: DataFrame, settings: FilterSettings, accessions: DataFrame | None = None, assays: list[str] | None = None) -> DataFrame:
    """The chain on main and covariate rows separately, united again."""
    main, covariate = split_covariate(df, assays)
    out = filter_chain(main, settings, accessions)
    return out if covariate is None else out.unionByName(filter_chain(covariate, settings, accessions))


def filter_steps(df: DataFrame, settings: FilterSettings) -> list[tuple[str, float, Column, Column]]:
    """(column, threshold, rows kept, rows dropped) of the score filters and the censor, each on what the steps before
    kept, as aggregates. Null scores are in neither count."""
    steps: list[tuple[str, float, Column, Column]] = []
    before = F.lit(True)
    for name, threshold, direction in (("QVALUE", settings.qvalue, "lower"), ("PEP", settings.pep, settings.pep_direction), ("PRECURSORS_EXP", settings.min_precursors, "higher")):
        if threshold and name in df.columns:
            keep = _score(name, threshold, direction)
            steps.append((name, float(threshold), F.count_if(before & keep), F.count_if(before & ~keep)))
            before = before & F.coalesce(keep, F.lit(False))
    if settings.min_linear_intensity is not None:
        low = F.col("SIGNAL") < settings.min_linear_intensity
        steps.append(("SIGNAL", float(settings.min_linear_intensity), F.count_if(before & ~low), F.count_if(before & low)))
    return steps


def diagnostics(df: DataFrame, settings: FilterSettings) -> DataFrame:
    """step, threshold, n_kept, n_dropped of ``filter_steps``, in one pass."""
    steps = filter_steps(df, settings)
    counts = df.agg(*(F.struct(k.alias("n_kept"), d.alias("n_dropped")).alias(name) for name, _, k, d in steps))
    rows = F.array(*(F.struct(F.lit(name).alias("step"), F.lit(t).alias("threshold"), F.col(f"{name}.n_kept"), F.col(f"{name}.n_dropped")) for name, t, _, _ in steps))
    return counts.select(F.inline(rows))


def localization_filter(cells: DataFrame, threshold: float, mode: str = "soft") -> DataFrame:
    """Keep features whose best (soft) or worst (strict) LOC_PROB over samples reaches the threshold, in every layer."""
    if mode not in ("soft", "strict"):
        raise ValueError("mode is soft or strict")
    best = (F.max if mode == "soft" else F.min)("LOC_PROB").over(Window.partitionBy("INDEX"))
    return require(cells, "LOC_PROB").filter("INDEX IS NOT NULL").withColumn("_p", best).filter(F.col("_p") >= threshold).drop("_p")
