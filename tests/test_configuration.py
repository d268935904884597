"""The configuration as a table: unknown keys, aliases, presets, contracts, and what each key changes in a run."""

import math

import pytest
from pyspark.sql import functions as F

from quantspark.operators import impute
from quantspark.plans import config, pipeline

#: The shape of vendor configurations, with small tables in place of the files.
PROTEOMICS = {
    "dataset": {
        "input_file": None, "input_layout": "long", "analysis_type": "proteomics", "annotation_file": None, "exclude_runs": None, "index_column": "PG.ProteinGroups", "signal_column": "FG.MS2RawQuantity", "qvalue_column": "PG.Qvalue",
        "pep_column": "PG.PEP", "charge_column": "FG.Charge", "condition_column": "R.Condition", "replicate_column": "R.Replicate", "filename_column": "R.FileName", "spectral_counts_column": "PG.RunEvidenceCount",
        "precursors_exp_column": "PG.NrOfPrecursorsIdentified (Experiment-wide)", "ibaq_column": "PG.IBAQ", "fasta_column": "PG.FastaHeaders", "protein_weight_column": "PG.MolecularWeight",
        "protein_descriptions_column": "PG.ProteinDescriptions", "gene_names_column": "PG.Genes", "peptide_seq_column": "FG.LabeledSequence",
    },
    "preprocessing": {
        "protein_rollup_method": "directlfq", "peptide_rollup_method": "sum", "directlfq_cores": 8, "directlfq_min_nonan": 1,
        "filtering": {"qvalue": 0.01, "pep": 0.01, "min_precursors": 1, "min_linear_intensity": 2, "contaminants_files": None},
        "normalization": {"method": ["log2", "median_equalization_by_tag"], "reference_tag": ["HUMAN"]}, "imputation": {"method": "lc_conmed", "lc_conmed_lod_k": 10, "random_state": 42},
    },
    "analysis": {"only_against": None, "only_contrasts": None},
    "exports": {"path_h5ad": None, "path_table": None, "path_pdf_report": None, "pdf_report": {"title": "Report"}},
}


def merged(base, extra):
    out = dict(base)
    for k, v in extra.items():
        out[k] = merged(out.get(k) or {}, v) if isinstance(v, dict) and k != "inject_runs" else v
    return out


def proteins(spark):
    rows = [
        (f"P{i}", float(90 * (i % 7 + 2) * (1.6 if r > 2 and i % 3 == 0 else 1.0) + 11 * r + 3 * k), 0.001 if (i + k) % 11 else 0.5, 0.001 if i % 9 else 0.008, f"run{r}.raw", "AB"[r > 2], r % 3 + 1, float(k), 0 if i == 4 else 5, "1.0;2.0", "HUMAN" if i % 2 else "YEAST", "10;20", "d", "NA", f"_M[Oxidation (M)]PEP{k}K_", 2 + k % 2)
        for i in range(14) for r in range(6) for k in range(3) if (5 * i + 3 * r + k) % 8 and (i + 2 * r) % 7
    ]
    names = ["PG.ProteinGroups", "FG.MS2RawQuantity", "PG.Qvalue", "PG.PEP", "R.FileName", "R.Condition", "R.Replicate", "PG.RunEvidenceCount", "PG.NrOfPrecursorsIdentified (Experiment-wide)", "PG.IBAQ", "PG.FastaHeaders", "PG.MolecularWeight", "PG.ProteinDescriptions", "PG.Genes", "FG.LabeledSequence", "FG.Charge"]
    return spark.createDataFrame(rows, names).persist()


def with_frame(spark, extra=None, method="sum"):
    return merged(merged(PROTEOMICS, {"dataset": {"frame": proteins(spark)}, "preprocessing": {"protein_rollup_method": method}}), extra or {})


def cells(results, *columns):
    return {(r.INDEX, r.Sample): tuple(None if r[c] is None else round(r[c], 9) for c in columns) for r in results.cells.collect()}


@pytest.fixture(scope="module")
def plain(spark):
    return cells(pipeline.prepare(spark, with_frame(spark)), "raw", "processed")


CHANGES = [
    {"preprocessing": {"protein_rollup_method": "max"}}, {"preprocessing": {"filtering": {"qvalue": 0.9}}}, {"preprocessing": {"filtering": {"pep": 0.005}}}, {"preprocessing": {"filtering": {"pep": 0.002, "pep_direction": "higher"}}},
    {"preprocessing": {"filtering": {"min_precursors": None}}}, {"preprocessing": {"filtering": {"min_linear_intensity": 300}}}, {"preprocessing": {"normalization": {"method": "log2"}}}, {"preprocessing": {"normalization": {"reference_tag": "YEAST"}}},
    {"preprocessing": {"imputation": {"method": "mindet"}}}, {"preprocessing": {"imputation": {"random_state": 7}}}, {"preprocessing": {"imputation": {"lc_conmed_in_min_obs": 3}}}, {"preprocessing": {"imputation": {"lc_conmed_jitter_frac": 0.5}}},
    {"dataset": {"exclude_runs": "run0"}},
]


@pytest.mark.parametrize("change", CHANGES, ids=str)
def test_each_key_changes_the_cells(spark, plain, change):
    assert cells(pipeline.prepare(spark, with_frame(spark, change)), "raw", "processed") != plain


def test_lfq_keys(spark, plain):
    one, three = (cells(pipeline.prepare(spark, with_frame(spark, {"preprocessing": {"directlfq_min_nonan": n, "imputation": {"method": None}}}, "directlfq")), "raw") for n in (1, 3))
    assert one != three and {k: v[:1] for k, v in plain.items()} != one


@pytest.mark.parametrize(("path", "value"), [("preprocessing.filterin.qvalue", 1), ("preprocessing.imputation.knn", 3), ("dataset.signal", "x"), ("exports.path_tabel", "x"), ("nothing", 1)])
def test_unknown_keys_raise(path, value):
    own = {}
    at = own
    *sections, last = path.split(".")
    for s in sections:
        at = at.setdefault(s, {})
    at[last] = value
    with pytest.raises(ValueError, match="unknown configuration keys"):
        pipeline.validate(own)


@pytest.mark.parametrize("own", [
    {"preprocessing": {"filtering": {"pep_direction": "up"}}}, {"preprocessing": {"filtering": {"qvalue": "low"}}}, {"preprocessing": {"peptide_rollup_method": "max"}}, {"preprocessing": {"phospho": {"localization_filter_mode": "hard"}}}, {"dataset": {"input_layout": "tall"}},
    {"dataset": {"phospho_multisite_collapse_policy": "drop"}}, {"preprocessing": {"pivot_signal_method": "sum", "protein_rollup_method": "mean"}}, {"dataset": {"inject_runs": {"x": {"frame": 1, "file": 2}}}}, {"dataset": {"inject_runs": {"x": {"column_overrides": {"condition_column": "c"}}}}}, {"ancova": {"beta_mode": "some"}},
])
def test_wrong_values_raise(own):
    with pytest.raises(ValueError):
        pipeline.validate(own)


def test_aliases_and_nulls():
    s = config.Settings({"preprocessing": {"pivot_signal_method": "MEAN", "filtering": {"qvalue": None, "localization_threshold": 0.5}}, "exports": {"path_tables": "x"}})
    assert (s["preprocessing.protein_rollup_method"], s["preprocessing.filtering.qvalue"], s["preprocessing.filtering.pep"], s["preprocessing.phospho.localization_filter_threshold"], s["exports.path_table"]) == ("mean", None, 0.2, 0.5, "x")
    assert config.Settings({"preprocessing": {"imputation": None}}).imputation() == (None, {})
    assert config.Settings({"preprocessing": {"imputation": {"method": "minprob", "lc_clip": False, "lc_mu_shift": 2, "knn_k": 3}}}).imputation() == ("minprob", {"clip": False, "mu_shift": 2})


def test_every_imputation_parameter_exists():
    import inspect

    functions = {"lc_conmed": impute.condition_median, "knn": impute.knn_features, "nsknn": impute.knn_samples, "tnknn": impute.knn_correlated, "randomforest": impute.boosted, "mindet": impute.min_det, "minprob": impute.min_prob}
    for method, f in functions.items():
        assert set(config.IMPUTATION[method].values()) <= set(inspect.signature(f).parameters), method
    defaults = inspect.signature(impute.boosted).parameters
    assert (defaults["rounds"].default, defaults["trees"].default, defaults["nearest_samples"].default) == (20, 100, 50)


@pytest.mark.parametrize("name", config.PRESETS)
def test_presets_are_whole_configurations(name):
    s = config.Settings(config.preset(name, input_file="report.tsv"))
    assert s["dataset.signal_column"] and s.imputation()[0] == "lc_conmed" and s["preprocessing.filtering.min_linear_intensity"] == 2
    assert (s["preprocessing.filtering.qvalue"] is None) == name.startswith("fragpipe")
    with pytest.raises(ValueError):
        config.preset("other")


def test_contracts_raise_in_the_pass_that_counts(spark):
    frame = proteins(spark)
    with pytest.raises(ValueError, match="without condition"):
        pipeline.prepare(spark, with_frame(spark, {"dataset": {"frame": frame.withColumn("R.Replicate", F.when(F.col("`R.FileName`") != "run1.raw", F.col("`R.Replicate`")))}}))
    runs = [(f"run{r}", "AB"[r > 2], r % 3 + 1) for r in range(6)]
    note = lambda rows: spark.createDataFrame(rows, "FILENAME string, CONDITION string, REPLICATE long")
    with pytest.raises(ValueError, match="run5"):
        pipeline.prepare(spark, with_frame(spark, {"dataset": {"annotation": note(runs[:5])}}))
    with pytest.raises(ValueError, match="run9"):
        pipeline.prepare(spark, with_frame(spark, {"dataset": {"annotation": note([*runs, ("run9", "A", 4)])}}))
    done = pipeline.prepare(spark, with_frame(spark, {"dataset": {"annotation": note(runs)}}))
    steps = {r.step: (r.n_kept, r.n_dropped) for r in done.extra["diagnostics"].collect()}
    kept = frame.filter("`PG.Qvalue` <= 0.01").count()
    assert steps["QVALUE"] == (kept, frame.count() - kept)


def phospho(spark):
    """Sites of four proteins in six runs, and the flow-through of the same proteins in six other runs."""
    rows = [
        (f"run{r}.raw", "AB"[r > 2], r % 3 + 1, f"Q{p}", f"PEP{p}SAT", f"_PEP{p}S[Phospho (STY)]AT_", str(10 * p + 1), f"(S{10 * p + 5})", "5", "S5", "0.99" if p else "0.3", float(1000 * (p + 1) * (2.0 if r > 2 and p == 1 else 1.0) + 17 * r + 5 * z), 2 + z, 0.001, 0.001)
        for p in range(6) for r in range(6) for z in range(2) if (p + r + z) % 7
    ]
    names = ["R.FileName", "R.Condition", "R.Replicate", "PG.ProteinGroups", "PEP.StrippedSequence", "EG.ModifiedSequence", "PEP.PeptidePosition", "EG.ProteinPTMLocations", "EG.PTMPositions [Phospho (STY)]", "EG.PTMSites [Phospho (STY)]", "EG.PTMProbabilities [Phospho (STY)]", "FG.MS2RawQuantity", "FG.Charge", "FG.Qvalue", "EG.PEP"]
    through = [(f"ft{r}.raw", "AB"[r > 2], r % 3 + 1, f"Q{p}", f"PEP{p}K", f"_PEP{p}K_", float(5000 * (p + 1) * (2.0 if r > 2 and p == 1 else 1.0) + 13 * r), 2, 0.001, 0.001) for p in range(5) for r in range(6) if (2 * p + r) % 5]
    return spark.createDataFrame(rows, names), spark.createDataFrame(through, [*names[:6], "FG.MS2RawQuantity", "FG.Charge", "PG.Qvalue", "PG.PEP"])


def phospho_config(spark, **preprocessing):
    main, through = phospho(spark)
    own = config.preset("spectronaut-phosphoproteomics", frame=main, spectral_counts_column=None, inject_runs={"flowthrough": {"frame": through}})
    own["preprocessing"] |= preprocessing
    return own


def test_covariate_runs_make_a_second_chain(spark, tmp_path):
    own = phospho_config(spark, phospho={"covariate_protein_rollup_method": "sum"})
    own["exports"] = {"path_table": str(tmp_path / "out")}
    got = pipeline.run_pipeline(spark, own)
    assert {r.Sample for r in got.samples.collect()} == {f"run{r}" for r in range(6)}
    at = {(r.INDEX, r.Sample): r for r in got.cells.collect()}
    assert {k[0] for k in at} == {f"Q{p}|S{10 * p + 5}" for p in range(1, 6)}  # the badly localized site is gone
    assert at["Q1|S15", "run1"].raw_covariate == 5000 * 2 + 13 and at["Q5|S55", "run1"].covariate is None
    for p in range(1, 5):
        line = sorted(at[f"Q{p}|S{10 * p + 5}", f"run{r}"].covariate for r in range(6))
        assert abs((line[2] + line[3]) / 2) < 1e-9  # centred by the median
    stats = {r.INDEX: r for r in got.stats.collect()}
    x = stats["Q1|S15"]
    assert x.informed and x.raw_log2fc < -0.4 and x.covariate_log2fc < -0.4 and abs(x.log2fc) < 0.3 and math.isclose(x.log2fc + x.covariate_part, x.raw_log2fc, abs_tol=1e-9)
    assert not stats["Q5|S55"].informed and stats["Q5|S55"].log2fc == stats["Q5|S55"].raw_log2fc
    assert {"adjusted", "raw", "covariate"} == {"adjusted", *(c.split("_")[0] for c in got.stats.columns if c.startswith(("raw_", "covariate_")))}
    written = spark.read.parquet(str(tmp_path / "out/summary"))
    assert written.count() == 6  # all features that were kept, the badly localized one without statistics
    assert "COVARIATE_LOG2FC_A_vs_B" in written.columns
    counts = {(r.INDEX, r.Sample): r.spectral_counts for r in got.cells.collect() if r.spectral_counts}
    assert set(counts.values()) <= {1, 2}


def test_covariate_contracts(spark):
    own = phospho_config(spark)
    through = own["dataset"]["inject_runs"]["flowthrough"]["frame"]
    own["dataset"]["inject_runs"]["flowthrough"]["frame"] = through.filter("`R.FileName` <> 'ft0.raw'")
    with pytest.raises(ValueError, match="replicates differ"):
        pipeline.prepare(spark, own)
    own["dataset"]["inject_runs"] = None
    own["preprocessing"]["covariates"] = {"enabled": True}
    with pytest.raises(ValueError, match="no covariate rows"):
        pipeline.prepare(spark, own)


def test_localization_and_policy_keys(spark):
    loose = pipeline.prepare(spark, phospho_config(spark, phospho={"localization_filter_threshold": 0.1, "covariate_protein_rollup_method": "sum"}))
    assert loose.cells.select("INDEX").distinct().count() == 6
    kept = pipeline.prepare(spark, phospho_config(spark, phospho={"multisite_collapse_policy": "retain", "covariate_protein_rollup_method": "mean"}))
    assert kept.cells.select("INDEX").distinct().count() == 5


def test_peptide_keys(spark):
    rows = [(f"r{r}", "AB"[r > 1], r % 2 + 1, "Q1", f"_M[15.9949]K{p}C[57.0215]_", float(100 + r + p), 2) for r in range(4) for p in range(3)]
    frame = spark.createDataFrame(rows, ["run", "cond", "rep", "uni", "seq", "sig", "z"])
    own = {"dataset": {"frame": frame, "analysis_type": "peptidomics", "filename_column": "run", "condition_column": "cond", "replicate_column": "rep", "uniprot_column": "uni", "peptide_seq_column": "seq", "signal_column": "sig", "charge_column": "z"}, "preprocessing": {"normalization": {"method": ["log2"]}}}
    names = lambda extra: {r.INDEX for r in pipeline.prepare(spark, merged(own, extra)).cells.collect()}
    assert "MK0C[Carbamidomethyl (C)]" in names({})
    assert "M[15.9949]K0C[57.0215]" in names({"dataset": {"convert_numeric_ptms": False}}) and "M[Oxidation (M)]K0C[Carbamidomethyl (C)]" in names({"preprocessing": {"collapse_met_oxidation": False}}) and "MK0C" in names({"preprocessing": {"collapse_all_ptms": True}})


def test_iterated_regression_goes_on_while_fills_move(spark):
    rows = [(f"f{i}", f"s{j}", None if (i + 2 * j) % 9 == 0 else float(10 + i / 4 + j * (i % 3))) for i in range(40) for j in range(3)]
    c = spark.createDataFrame(rows, "INDEX string, Sample string, v double").coalesce(1).persist()
    run = lambda **p: {(r.INDEX, r.Sample): r.v for r in impute.boosted(c, depth=2, trees=2, **p).collect()}
    one, three = run(rounds=1), run(rounds=3, tolerance=0.0)
    assert one != three and all(v is not None for v in three.values())  # later rounds still change fills
    assert run(rounds=3, tolerance=10.0) == one  # a wide tolerance stops after the first
    assert run(rounds=1, nearest_samples=1) != one
    assert impute.correlated_samples(c, 2).keys() == {f"s{j}" for j in range(3)}
