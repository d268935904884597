"""The configured chain: read, harmonize, filter, roll up, normalize, impute, test, embed, export."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quantspark.functions.sequence import name_numeric_modifications, strip_extension
from quantspark.operators import annotate, covariate, differential, embed, filters, impute, lfq, normalize, quality, reshape, rollup, sites
from quantspark.plans.config import PRESETS, Settings, preset
from quantspark.schema import CONFIG_COLUMNS, analysis_type, canonical_types
from quantspark.sources import readers, sinks, store
from quantspark.sources.scratch import stored

__all__ = ["PRESETS", "Results", "add_statistics", "embed_samples", "inject", "load", "prepare", "preprocess", "preset", "run_pipeline", "validate"]


@dataclass
class Results:
    """Keyed tables: cells (INDEX, Sample, layers), samples, features, stats, and further named ones."""

    cells: DataFrame
    samples: DataFrame
    features: DataFrame
    contrasts: DataFrame | None = None
    stats: DataFrame | None = None
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        named = {"cells": self.cells, "samples": self.samples, "features": self.features, "contrasts": self.contrasts, "stats": self.stats, **self.extra}
        return {k: v for k, v in named.items() if v is not None}

    def save(self, folder: str) -> None:
        """Store all tables, sorted, to be opened by ``Results.open``."""
        store.write_store(self.tables(), folder)

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Results:
        """What ``save`` stored."""
        tables = store.open_store(spark, folder)
        own = {k: tables.pop(k, None) for k in ("cells", "samples", "features", "contrasts", "stats")}
        return cls(**own, extra=tables)

    def feature(self, index: str) -> dict[str, DataFrame]:
        """One feature's rows of every table that has features; of opened tables only the files of its range are read."""
        return {k: df.filter(F.col("INDEX") == index) for k, df in self.tables().items() if "INDEX" in df.columns}


def validate(config: dict[str, Any]) -> Settings:
    """Raise on unknown keys, names and types before any plan is built."""
    return Settings(config)


def load(spark: SparkSession, dataset: dict[str, Any]) -> DataFrame:
    """One run's table, harmonized: renamed, unpivoted if wide, annotated, indexed, excluded runs dropped."""
    df = dataset["frame"] if dataset.get("frame") is not None else readers.read_table(spark, dataset["input_file"], [dataset[k] for k in ("signal_column",) if dataset.get(k)])
    note = _annotation(spark, dataset)
    if dataset.get("input_layout") == "wide":
        signal, counts = dataset.get("signal_column") or "Intensity", dataset.get("spectral_counts_column")
        if note is not None:
            runs = [r[0] for r in note.select("FILENAME").distinct().collect()]  # runs of an experiment
            annotate.check_headers(df.columns, runs, signal)
            df = reshape.unpivot_runs(reshape.precursors_alias(df), runs, signal, counts)
        else:
            df = reshape.unpivot_labels(df, signal, counts)
        dataset = {k: v for k, v in dataset.items() if k not in ("signal_column", "spectral_counts_column", "filename_column")}
    df = canonical_types(reshape.rename(df, {k: v for k, v in dataset.items() if k in CONFIG_COLUMNS}))
    df = filters.exclude_runs(df.withColumn("FILENAME", strip_extension(F.col("FILENAME"))), dataset.get("exclude_runs"))
    if note is not None:
        df = annotate.annotate(df, note)
    if dataset.get("convert_numeric_ptms", True) and "PEPTIDE_LSEQ" in df.columns:
        df = df.withColumn("PEPTIDE_LSEQ", name_numeric_modifications(F.col("PEPTIDE_LSEQ")))
    kind = analysis_type(dataset.get("indexing_type") or dataset.get("analysis_type"))
    if kind == "phospho":
        return sites.site_index(df, dataset.get("phospho_multisite_collapse_policy") or "explode")
    return sites.peptido_index(df, dataset.get("collapse_met_oxidation", True), dataset.get("collapse_all_ptms", False)) if kind == "peptidomics" else reshape.index_from_uniprot(df)


def _annotation(spark: SparkSession, dataset: dict[str, Any]) -> DataFrame | None:
    note = readers.read_annotation(spark, dataset["annotation_file"]) if dataset.get("annotation_file") else dataset.get("annotation")
    return None if note is None else filters.exclude_runs(note, dataset.get("exclude_runs"))


def inject(spark: SparkSession, main: DataFrame, runs: dict[str, dict[str, Any]] | None) -> DataFrame:
    """Union with injected runs, each with its own configuration and tags."""
    if not runs:
        return main
    frames = [main.withColumns({"IS_COVARIATE": F.lit(False)} | {n: F.lit(False) for n in runs if n not in main.columns})]
    for name, own in runs.items():
        frames.append(reshape.with_tags(load(spark, own), IS_COVARIATE=bool(own.get("is_covariate")), ASSAY=own.get("assay") or name, **{name: True}))
    return reshape.relaxed_union(frames)


def prepare(spark: SparkSession, config: dict[str, Any]) -> Results:
    settings = validate(config)
    main, runs = settings.dataset(), settings.injected()
    annotated = {r[0]: cov for own, cov in ((main, False), *((r, bool(r.get("is_covariate"))) for r in runs.values())) if (note := _annotation(spark, own)) is not None for r in note.select("FILENAME").distinct().collect()}  # runs of an experiment
    return preprocess(inject(spark, load(spark, main), runs), config, annotated)


def _contracts(df: DataFrame, settings: filters.FilterSettings, annotated: dict[str, bool] | None, kind: str) -> tuple[DataFrame, list[Row]]:
    """(diagnostics, runs): one pass over the whole input counts what each filter keeps and every null that may not be,
    run by run. Raises on runs without condition or replicate, annotated runs without data, null site indexes, and
    covariate runs that don't match the main ones."""
    steps = filters.filter_steps(df, settings)
    flag = F.coalesce("IS_COVARIATE", F.lit(False)) if "IS_COVARIATE" in df.columns else F.lit(False)
    own = lambda c: F.min(c).alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
    nulls = {c: F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("CONDITION", "REPLICATE", "INDEX") if c in df.columns}
    runs = df.groupBy("FILENAME", flag.alias("IS_COVARIATE")).agg(own("CONDITION"), own("REPLICATE"), own("ASSAY"), *nulls.values(), *(x.alias(f"{n}_{i}") for i, (_, _, *both) in enumerate(steps) for n, x in zip(("kept", "dropped"), both, strict=True))).collect()  # runs of an experiment
    if bare := sorted(str(r["FILENAME"]) for r in runs if any(r[f"null_{c}"] for c in ("CONDITION", "REPLICATE") if c in nulls) or "CONDITION" not in nulls or "REPLICATE" not in nulls):
        raise ValueError(f"runs without condition or replicate (annotation): {', '.join(bare[:20])}")
    if lacking := sorted(set(annotated or {}) - {r["FILENAME"] for r in runs}):
        raise ValueError(f"annotated runs without data: {', '.join(lacking[:20])}")
    if kind == "phospho" and (bad := sum(r["null_INDEX"] for r in runs)):
        raise ValueError(f"{bad} rows have no site index")
    sizes = [{c: sum(r["CONDITION"] == c and r["IS_COVARIATE"] == cov for r in runs) for c in {r["CONDITION"] for r in runs}} for cov in (False, True)]
    if any(sizes[1].values()) and sizes[0] != sizes[1]:
        raise ValueError(f"replicates differ between main and covariate runs: {sizes[0]} and {sizes[1]}")
    total = lambda n, i: sum(r[f"{n}_{i}"] for r in runs)
    counts = [(name, threshold, total("kept", i), total("dropped", i)) for i, (name, threshold, *_) in enumerate(steps)]
    return df.sparkSession.createDataFrame(counts, "step string, threshold double, n_kept long, n_dropped long"), runs


def _quantities(kept: DataFrame, method: str, least: int) -> DataFrame:
    if method in ("directlfq", "lfq"):
        return lfq.lfq(kept, least)
    return rollup.top_n(kept) if method in ("top3", "topn") else rollup.roll_up(kept, method)


def preprocess(df: DataFrame, config: dict[str, Any], annotated: dict[str, bool] | None = None) -> Results:
    """Filter, roll up, complete the grid, normalize, impute, for the main and the covariate block. The filtered table feeds several steps and is persisted; cells are written between steps."""
    s = Settings(config)
    kind = analysis_type(s["dataset.analysis_type"])
    f = {k: s[f"preprocessing.filtering.{k}"] for k in ("qvalue", "pep", "pep_direction", "min_precursors", "min_linear_intensity")}
    settings = filters.FilterSettings(**f)
    files = s.names("preprocessing.filtering.contaminants_files")
    accessions = readers.read_contaminants(df.sparkSession, files) if files else None
    diagnostics, runs = _contracts(df, settings, annotated, kind)
    main, other = filters.split_covariate(df, s.names("preprocessing.covariates.assays")) if s.has_covariate() else (df, None)
    if s.has_covariate() and not any(r["IS_COVARIATE"] for r in runs) and other is None:
        raise ValueError("covariates are enabled, but there are no covariate rows")
    kept = filters.filter_chain(main, settings, accessions).persist()
    samples = stored(annotate.sample_table(kept), "samples")  # a row a run
    least = int(s["preprocessing.directlfq_min_nonan"])
    raw = _quantities(kept, s["preprocessing.protein_rollup_method"], least)
    evidence = rollup.evidence_cells(kept, phospho=kind == "phospho")
    if kind == "phospho" and {"PEPTIDE_LSEQ", "CHARGE"} <= set(kept.columns):
        evidence = evidence.drop("spectral_counts").join(rollup.site_counts(kept), ["INDEX", "Sample"], "left")
    cells = reshape.complete_grid(raw.join(evidence, ["INDEX", "Sample"], "left"), samples)
    if "LOC_PROB" in cells.columns:
        cells = filters.localization_filter(cells, s["preprocessing.phospho.localization_filter_threshold"], s["preprocessing.phospho.localization_filter_mode"])
    cells = stored(cells, "cells")  # from here on the long table isn't read for them again
    features = rollup.features(kept, ["FASTA_HEADERS", "GENE_NAMES", "PROTEIN_DESCRIPTIONS", "PROTEIN_WEIGHT", "PARENT_PROTEIN"], ["FILENAME", "SIGNAL"])
    work = stored(_normalized(cells.withColumn("v", F.col("raw")), samples, features, s).withColumn("normalized", F.col("v")), "normalized")
    method, params = s.imputation()
    done = impute.impute(work.select("INDEX", "Sample", "v"), samples, method, **params).withColumnRenamed("v", "processed")
    out = work.drop("v").join(done, ["INDEX", "Sample"])
    extra = {"diagnostics": diagnostics}
    if "PEPTIDE_LSEQ" in kept.columns:
        extra["peptides"] = rollup.peptide_cells(kept, s["preprocessing.peptide_rollup_method"])
        if "CHARGE" in kept.columns:
            extra["precursors"] = rollup.precursor_cells(kept, s["preprocessing.peptide_rollup_method"])
    if other is not None:
        block = _covariate_block(filters.filter_chain(other, settings, accessions), out, samples, features, s)
        out = out.join(block, ["INDEX", "Sample"], "left")
        extra["covariate"] = block
    return Results(stored(out, "processed"), samples, features, extra=extra)


def _normalized(cells: DataFrame, samples: DataFrame, features: DataFrame, s: Settings) -> DataFrame:
    return normalize.normalize(cells, s.names("preprocessing.normalization.method"), samples, features, s.names("preprocessing.normalization.reference_tag"), s["preprocessing.normalization.loess_span"])


def _covariate_block(rows: DataFrame, cells: DataFrame, samples: DataFrame, features: DataFrame, s: Settings) -> DataFrame:
    """INDEX, Sample, raw_covariate, normalized_covariate, covariate: the covariate's own chain, for every main cell.

    Covariate runs stand for the main run of equal condition and replicate. Rolled up by parent protein, given to all
    its features, normalized like the main block over these, imputed once a parent, less each feature's median.
    """
    method, least = s["preprocessing.phospho.covariate_protein_rollup_method"], int(s["preprocessing.directlfq_min_nonan"])
    by_parent = rows.filter("PARENT_PROTEIN IS NOT NULL").withColumn("INDEX", F.col("PARENT_PROTEIN"))
    pairs = samples.select("Sample", "ALIGN_KEY").join(annotate.sample_table(rows).select(F.col("Sample").alias("_own"), "ALIGN_KEY"), "ALIGN_KEY").drop("ALIGN_KEY")
    own = _quantities(by_parent, method, least).withColumnRenamed("Sample", "_own").join(F.broadcast(pairs), "_own").select(F.col("INDEX").alias("PARENT_PROTEIN"), "Sample", F.col("raw").alias("covariate"))  # a row a run
    parents = features.select("INDEX", "PARENT_PROTEIN").filter("PARENT_PROTEIN IS NOT NULL").join(cells.select("INDEX").distinct(), "INDEX", "left_semi")
    fanned = rollup.with_covariate(cells.select("INDEX", "Sample"), parents, own).withColumn("v", F.col("covariate"))
    work = stored(_normalized(stored(fanned, "covariate"), samples, features, s), "covariate-normalized")
    by_key = work.filter("PARENT_PROTEIN IS NOT NULL").groupBy("PARENT_PROTEIN", "Sample").agg(F.any_value("v").alias("covariate"))
    seen = by_key.groupBy("PARENT_PROTEIN").agg(F.count("covariate").alias("_n")).filter("_n > 0").select("PARENT_PROTEIN")
    imputer, params = s.imputation()
    filled = impute.covariate_imputed(by_key.join(seen, "PARENT_PROTEIN", "left_semi"), lambda c: impute.impute(c, samples, imputer, **params), parents)
    return work.select("INDEX", "Sample", F.col("covariate").alias("raw_covariate"), F.col("v").alias("normalized_covariate")).join(filled.select("INDEX", "Sample", F.col("c").alias("covariate")), ["INDEX", "Sample"], "left")


def add_statistics(results: Results, config: dict[str, Any] | None = None) -> Results:
    """Add contrasts and statistics; with a covariate block those of the adjusted, the raw and the covariate fit."""
    s = Settings(config or {})
    levels = [r[0] for r in results.samples.select("CONDITION").distinct().collect()]
    pairs = differential.contrast_pairs(levels, s.names("analysis.only_contrasts"), s["analysis.only_against"])
    results.contrasts = results.cells.sparkSession.createDataFrame(pairs, "contrast string, A string, B string")
    counts = quality.missing_counts(results.cells, results.samples)
    if "covariate" in results.cells.columns:
        results.stats, results.extra["slopes"] = covariate.covariate_differential(results.cells, results.samples, results.contrasts, "processed", "covariate", "raw", "raw_covariate", s["ancova.beta_mode"], s["ancova.ridge_lambda"])
    else:
        results.stats = differential.differential(results.cells, results.samples, results.contrasts, counts, "processed")
    results.extra["missing"] = counts
    return results


def embed_samples(results: Results, config: dict[str, Any] | None = None) -> Results:
    """Add component scores, sample distances and their neighbours."""
    most = int(Settings(config or {})["analysis.clustering_max"])
    centred = embed.feature_centred(results.cells, embed.top_variance(results.cells, most, "processed"), "processed").persist()
    results.extra["pca"], _ = embed.pca(centred)
    results.extra["distances"] = embed.euclidean(centred, "processed")
    results.extra["correlations"] = embed.correlation_distance(centred, "processed")
    return results


def assemble(results: Results, config: dict[str, Any] | None = None) -> Results:
    """Add the tables that people read: summary, one identification table a layer, consistent peptides and precursors, hits."""
    names = sorted(r[0] for r in results.samples.select("Sample").collect())  # samples, conditions and contrasts of an experiment
    conditions = sorted({r[0] for r in results.samples.select("CONDITION").collect()})
    for layer, table in sinks.identification_tables(results.cells, names).items():
        results.extra[f"identification_{layer}"] = table
    for kind, key in (("peptides", "PEPTIDE_ID"), ("precursors", "PREC_ID")):
        if kind in results.extra:
            counts = quality.consistent(results.extra[kind], results.samples, key)
            results.extra[f"consistent_{kind}"] = sinks.consistency_table(results.features, counts, conditions, f"CONSISTENT_{kind[:-1].upper()}_")
            results.extra[f"{kind}_table"] = sinks.annotated_table(results.extra[kind], results.features, key, names)
    if results.stats is not None:
        contrasts = [r[0] for r in results.contrasts.select("contrast").collect()]
        values = tuple(c for c in results.stats.columns if c not in ("INDEX", "contrast", "masked", "informed", "s2", "df", "factor", "df_total"))
        results.extra["summary"] = sinks.summary_table(results.features, results.stats, contrasts, values)
        if "q_mod" in results.stats.columns:
            mask = differential.missing_mask(results.extra["missing"], results.contrasts)
            results.extra["hits"] = differential.top_hits(results.stats, mask, q="q_mod", below=Settings(config or {})["analysis.sign_threshold"])
    return results


def run_pipeline(spark: SparkSession, config: dict[str, Any]) -> Results:
    """Everything, and the export where one is configured."""
    settings = validate(config)
    results = assemble(embed_samples(add_statistics(prepare(spark, config), config), config), config)
    if path := settings["exports.path_table"]:
        sinks.write_tables(results.tables(), path, settings["exports.format"])
    return results
