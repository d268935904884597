"""The configuration as a table: every key with its type, default, allowed values and reader. Validation, aliases,
defaults, presets and the parameters of each step follow from it."""

from __future__ import annotations

import copy
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from quantspark.operators import normalize, rollup
from quantspark.operators.covariate import MODES
from quantspark.operators.sites import POLICIES
from quantspark.schema import CONFIG_COLUMNS, analysis_type


@dataclass(frozen=True)
class Key:
    """A configuration key. ``step`` reads it as ``parameter``; step "none" is for keys without data work here."""

    path: str
    step: str
    kind: str = "text"
    default: Any = None
    allowed: tuple[str, ...] = ()
    parameter: str = ""


def _steps(section: str, step: str, *rows: tuple) -> list[Key]:
    return [Key(f"{section}.{name}", step, *rest) for name, *rest in rows]


#: What may be read for each key; imputation keys name the method that reads them as their step.
KEYS: list[Key] = [
    *_steps(
        "dataset", "load", ("input_file",), ("frame", "any"), ("input_layout", "text", "long", ("long", "wide")), ("annotation_file",), ("annotation", "any"), ("exclude_runs", "list"), ("analysis_type",), ("indexing_type",),
        ("convert_numeric_ptms", "flag", True), ("collapse_met_oxidation", "flag", True), ("collapse_all_ptms", "flag", False), ("phospho_multisite_collapse_policy", "text", None, tuple(POLICIES)), ("inject_runs", "map"), ("is_covariate", "flag"), ("assay",), ("column_overrides", "map"),
        *((name,) for name in CONFIG_COLUMNS),
    ),
    *_steps("preprocessing", "load", ("convert_numeric_ptms", "flag"), ("collapse_met_oxidation", "flag"), ("collapse_all_ptms", "flag"), ("phospho.multisite_collapse_policy", "text", None, tuple(POLICIES))),
    *_steps("preprocessing", "rollup", ("protein_rollup_method", "text", "sum", rollup.METHODS), ("peptide_rollup_method", "text", "sum", ("sum", "mean", "median")), ("directlfq_min_nonan", "number", 1), ("phospho.covariate_protein_rollup_method", "text", "directlfq", rollup.METHODS)),
    *_steps("preprocessing.filtering", "filter", ("qvalue", "number", 0.01), ("pep", "number", 0.2), ("pep_direction", "text", "lower", ("lower", "higher")), ("min_precursors", "number", 1), ("min_linear_intensity", "number"), ("contaminants_files", "list")),
    *_steps("preprocessing.phospho", "filter", ("localization_filter_mode", "text", "soft", ("soft", "strict")), ("localization_filter_threshold", "number", 0.75)),
    *_steps("preprocessing.covariates", "filter", ("enabled", "flag", False), ("assays", "list")),
    *_steps("preprocessing.normalization", "normalize", ("method", "list", None, normalize.METHODS), ("reference_tag", "list"), ("loess_span", "number", 0.9)),
    *_steps("preprocessing.imputation", "impute", ("method", "text", None, ("mean", "median", "lc_conmed", "knn", "nsknn", "tnknn", "randomforest", "rf", "mindet", "minprob", "colmean"))),
    *_steps("preprocessing.imputation", "none", ("group_column", "text", "CONDITION", ("CONDITION", "condition")), ("knn_tn_perc", "number")),
    *_steps("analysis", "statistics", ("only_contrasts", "list"), ("only_against",)),
    *_steps("analysis", "embed", ("clustering_max", "number", 8000)),
    *_steps("analysis", "export", ("sign_threshold", "number", 0.05)),
    *_steps("ancova", "statistics", ("beta_mode", "text", "fixed1", MODES, "mode"), ("ridge_lambda", "number", 1e-6, (), "ridge")),
    *_steps("exports", "export", ("path_table",), ("format", "text", "parquet", ("parquet", "csv"))),
    *_steps("preprocessing", "none", ("directlfq_cores", "number")),
    *_steps("exports", "none", ("path_h5ad",), ("path_pdf_report",), ("pdf_report", "map")),
]

#: Method -> its keys, and what its function calls them; defaults are the function's.
IMPUTATION: dict[str, dict[str, str]] = {
    "lc_conmed": {"lc_conmed_lod_k": "lod_k", "lc_conmed_jitter_frac": "jitter", "lc_conmed_lc_shift": "lod_shift", "lc_conmed_lc_sd_width": "lod_sd", "lc_conmed_q_lower": "q_lower", "lc_conmed_q_upper": "q_upper", "lc_conmed_in_min_obs": "least", "random_state": "seed"},
    "knn": {"knn_k": "k"}, "nsknn": {"knn_k": "k"}, "tnknn": {"knn_k": "k"},
    "randomforest": {"rf_max_depth": "depth", "rf_learning_rate": "rate", "rf_n_estimators": "trees", "rf_max_iter": "rounds", "rf_tol": "tolerance", "rf_nearest_features": "nearest_samples", "random_state": "seed"},
    "mindet": {"lc_quantile": "quantile", "lc_shift": "shift"}, "minprob": {"lc_quantile": "quantile", "lc_mu_shift": "mu_shift", "lc_sd_width": "sd_width", "lc_clip": "clip", "random_state": "seed"},
    "mean": {}, "median": {}, "colmean": {},
}
IMPUTATION["rf"] = IMPUTATION["randomforest"]
KEYS += [Key(f"preprocessing.imputation.{k}", "impute", "flag" if k == "lc_clip" else "number") for k in sorted({k for of in IMPUTATION.values() for k in of})]

#: Other names: what is read under the second name if given under the first; both at once is an error.
ALIASES = {
    "preprocessing.pivot_signal_method": "preprocessing.protein_rollup_method", "preprocessing.filtering.localization_threshold": "preprocessing.phospho.localization_filter_threshold",
    "exports.path_tables": "exports.path_table", "dataset.phospho_multisite_policy": "dataset.phospho_multisite_collapse_policy", "dataset.protein_descriptions": "dataset.protein_descriptions_column", "dataset.protein_weight": "dataset.protein_weight_column",
}
#: What an injected run may map otherwise than the main table.
OVERRIDES = tuple(sorted(set(CONFIG_COLUMNS) - {"condition_column", "replicate_column", "filename_column", "stripped_seq_column"} - {k for k in CONFIG_COLUMNS if k.startswith("ptm_")}))
#: Keys of an injected run; the rest comes from the main table.
INJECTED = ("input_file", "frame", "input_layout", "annotation_file", "annotation", "analysis_type", "indexing_type", "is_covariate", "assay", "column_overrides")

BY_PATH = {k.path: k for k in KEYS if k.path not in ALIASES}
_SECTIONS = {p.rsplit(".", i)[0] for p in [*BY_PATH, *ALIASES] for i in range(1, p.count(".") + 1)}
_CHECKS: dict[str, Callable[[Any], bool]] = {
    "text": lambda v: isinstance(v, str), "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool), "flag": lambda v: isinstance(v, bool),
    "list": lambda v: isinstance(v, str | list | tuple | set), "map": lambda v: isinstance(v, dict), "any": lambda v: True,
}


def _flat(config: dict[str, Any], at: str = "") -> dict[str, Any]:
    out: dict[str, Any] = {}
    for name, value in (config or {}).items():
        path = f"{at}{name}"
        if path in _SECTIONS and (value is None or isinstance(value, dict)):
            out |= _flat(value or {}, f"{path}.")
        else:
            out[path] = value
    return out


class Settings:
    """A checked configuration: ``settings["preprocessing.filtering.pep"]`` is what was given, else the default.

    A key given as null has no value where it may be switched off (a filter's limit) and its default elsewhere.
    """

    def __init__(self, config: dict[str, Any]):
        given = _flat(config)
        if unknown := sorted(p for p in given if p not in BY_PATH and p not in ALIASES):
            near = {p: [k for k in BY_PATH if k.rsplit(".", 1)[-1] == p.rsplit(".", 1)[-1]] for p in unknown}
            raise ValueError("unknown configuration keys: " + ", ".join(p + (f" (did you mean {', '.join(near[p])}?)" if near[p] else "") for p in unknown))
        for old, new in ALIASES.items():
            if old in given:
                if given[old] is not None and given.get(new) is not None:
                    raise ValueError(f"{old} is another name for {new}; give one")
                value = given.pop(old)
                if given.get(new) is None:
                    given[new] = value
        for path, value in given.items():
            self._check(BY_PATH[path], value)
        self.given = given
        analysis_type(self["dataset.analysis_type"])
        for name, run in (self["dataset.inject_runs"] or {}).items():
            if bad := sorted(set(run or {}) - set(INJECTED)):
                raise ValueError(f"unknown keys of injected run {name}: {', '.join(bad)}; known: {', '.join(INJECTED)}")
            overrides = (run or {}).get("column_overrides") or {}
            if not isinstance(overrides, dict) or (bad := sorted(set(overrides) - set(OVERRIDES))):
                raise ValueError(f"column_overrides of injected run {name} map {', '.join(OVERRIDES)}, not {overrides if not isinstance(overrides, dict) else ', '.join(bad)}")

    @staticmethod
    def _check(key: Key, value: Any) -> None:
        if value is None:
            return
        if not _CHECKS[key.kind](value):
            raise ValueError(f"{key.path} is a {key.kind}, not {value!r}")
        if key.allowed:
            for v in [value] if isinstance(value, str) else value:
                if (v.lower() if isinstance(v, str) else v) not in key.allowed:
                    raise ValueError(f"unknown {key.path} {v!r}; one of {', '.join(key.allowed)}")

    def __getitem__(self, path: str) -> Any:
        key = BY_PATH[path]
        value = self.given.get(path)
        if value is None and not (path in self.given and path.startswith("preprocessing.filtering.") and path != "preprocessing.filtering.pep_direction"):
            value = key.default
        return value.lower() if isinstance(value, str) and key.allowed and value.lower() in key.allowed else value

    def names(self, path: str) -> list[str]:
        """A list's entries; one name stands for itself."""
        value = self[path]
        return [value.strip()] if isinstance(value, str) and value.strip() else [str(v) for v in value or [] if str(v).strip()]

    def dataset(self) -> dict[str, Any]:
        """The main table's settings; preprocessing's peptide and site rules count where the dataset has none."""
        own = {p.split(".", 1)[1]: self[p] for p in BY_PATH if p.startswith("dataset.")}
        for name in ("convert_numeric_ptms", "collapse_met_oxidation", "collapse_all_ptms"):
            if self.given.get(f"dataset.{name}") is None and self.given.get(f"preprocessing.{name}") is not None:
                own[name] = self.given[f"preprocessing.{name}"]
        own["phospho_multisite_collapse_policy"] = self["dataset.phospho_multisite_collapse_policy"] or self["preprocessing.phospho.multisite_collapse_policy"] or "explode"
        return own

    def injected(self) -> dict[str, dict[str, Any]]:
        """Settings of each injected run: the main table's, the run's own, and its column overrides. Runs without input are left out."""
        out = {}
        for name, run in (self["dataset.inject_runs"] or {}).items():
            if not run or not (run.get("input_file") or run.get("frame") is not None):
                continue
            own = {k: v for k, v in self.dataset().items() if k not in ("input_file", "frame", "annotation_file", "annotation", "inject_runs", "indexing_type")}
            own |= {k: v for k, v in run.items() if k != "column_overrides"} | dict(run.get("column_overrides") or {})
            out[name] = own
        return out

    def imputation(self) -> tuple[str | None, dict[str, Any]]:
        """The method and its function's parameters; keys of other methods don't matter."""
        method = self["preprocessing.imputation.method"]
        given = {k: self[f"preprocessing.imputation.{k}"] for k in IMPUTATION.get(method or "mean", {})}
        return method, {IMPUTATION[method][k]: v for k, v in given.items() if v is not None} if method else {}

    def has_covariate(self) -> bool:
        return self["preprocessing.covariates.enabled"] or any((r or {}).get("is_covariate") for r in (self["dataset.inject_runs"] or {}).values())


# Presets ----------------------------------------------------------------------------------------

#: Column names of common vendor reports.
_SPECTRONAUT = {"signal_column": "FG.MS2RawQuantity", "charge_column": "FG.Charge", "condition_column": "R.Condition", "replicate_column": "R.Replicate", "filename_column": "R.FileName", "fasta_column": "PG.FastaHeaders", "protein_descriptions_column": "PG.ProteinDescriptions", "gene_names_column": "PG.Genes"}
_FRAGPIPE = {"input_layout": "wide", "charge_column": "Charge", "signal_column": "Intensity", "peptide_seq_column": "Modified Sequence", "peptide_start_column": "Start", "uniprot_column": "Protein ID", "gene_names_column": "Gene", "protein_descriptions_column": "Protein Description", "spectral_counts_column": "Spectral Count"}
_DATASETS: dict[str, dict[str, Any]] = {
    "spectronaut-proteomics": _SPECTRONAUT | {"analysis_type": "proteomics", "index_column": "PG.ProteinGroups", "qvalue_column": "PG.Qvalue", "pep_column": "PG.PEP", "spectral_counts_column": "PG.RunEvidenceCount", "precursors_exp_column": "PG.NrOfPrecursorsIdentified (Experiment-wide)", "ibaq_column": "PG.IBAQ", "protein_weight_column": "PG.MolecularWeight", "peptide_seq_column": "FG.LabeledSequence"},
    "spectronaut-peptidomics": _SPECTRONAUT | {"analysis_type": "peptidomics", "qvalue_column": "FG.Qvalue", "pep_column": "EG.PEP", "uniprot_column": "PG.ProteinGroups", "peptide_seq_column": "FG.LabeledSequence"},
    "spectronaut-phosphoproteomics": _SPECTRONAUT | {"analysis_type": "phosphoproteomics", "qvalue_column": "FG.Qvalue", "pep_column": "EG.PEP", "spectral_counts_column": "PEP.RunEvidenceCount", "uniprot_column": "PG.ProteinGroups", "stripped_seq_column": "PEP.StrippedSequence", "peptide_seq_column": "EG.ModifiedSequence", "peptide_start_column": "PEP.PeptidePosition", "ptm_proteinlocations_column": "EG.ProteinPTMLocations", "ptm_positions_column": "EG.PTMPositions [Phospho (STY)]", "ptm_sites_column": "EG.PTMSites [Phospho (STY)]", "ptm_probabilities_column": "EG.PTMProbabilities [Phospho (STY)]"},
    "diann-proteomics": {"analysis_type": "proteomics", "filename_column": "Run", "index_column": "Protein.Group", "signal_column": "Precursor.Quantity", "qvalue_column": "PG.Q.Value", "charge_column": "Precursor.Charge", "pep_column": "PEP", "fasta_column": "Protein.Names", "gene_names_column": "Genes", "peptide_seq_column": "Modified.Sequence"},
    "fragpipe-proteomics": _FRAGPIPE | {"analysis_type": "proteomics"},
    "fragpipe-peptidomics": _FRAGPIPE | {"analysis_type": "peptidomics"},
}


def preset(name: str, **dataset: Any) -> dict[str, Any]:
    """A whole configuration for a vendor's report; further dataset keys (input_file, annotation_file, ...) go on top.

    Reports with scores are filtered at q 0.01 and PEP 0.05; ion tables without any are not. Injected runs of a
    phospho preset read their scores from the protein columns of the same vendor.
    """
    if name not in _DATASETS:
        raise ValueError(f"unknown preset {name!r}; one of {', '.join(_DATASETS)}")
    own = copy.deepcopy(_DATASETS[name]) | dataset
    scored, proteins = "qvalue_column" in own, own["analysis_type"] == "proteomics"
    if own["analysis_type"] == "phosphoproteomics" and own.get("inject_runs"):
        scores = {"qvalue_column": "PG.Qvalue", "pep_column": "PG.PEP", "precursors_exp_column": "PG.NrOfPrecursorsIdentified (Experiment-wide)"}
        own["inject_runs"] = {k: {"indexing_type": "peptidomics", "is_covariate": True, "column_overrides": scores} | v for k, v in own["inject_runs"].items()}
    return {
        "dataset": own,
        "preprocessing": {
            "protein_rollup_method": "directlfq" if scored and proteins else None, "peptide_rollup_method": "sum",
            "filtering": {"qvalue": 0.01 if scored else None, "pep": 0.05 if scored else None, "min_precursors": 1 if scored and proteins else None, "min_linear_intensity": 2},
            "normalization": {"method": ["log2", "median_equalization"]}, "imputation": {"method": "lc_conmed", "lc_conmed_lod_k": 10, "lc_conmed_in_min_obs": 1, "random_state": 42},
        },
    }


PRESETS = tuple(_DATASETS)
