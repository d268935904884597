"""Renaming, unpivoting, pivoting and relaxed unions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.schema import CONFIG_COLUMNS, require


def rename(df: DataFrame, config: dict[str, str | None]) -> DataFrame:
    """Rename configured source columns to canonical names; a target that is there already is an error, a missing source is left out."""
    wanted = {source: CONFIG_COLUMNS[key] for key, source in config.items() if key in CONFIG_COLUMNS and source and source in df.columns}
    if clash := [t for s, t in wanted.items() if t != s and t in df.columns]:
        raise ValueError(f"columns {', '.join(clash)} are there already")
    return df.withColumnsRenamed(wanted)


def index_from_uniprot(df: DataFrame) -> DataFrame:
    """INDEX falls back to UNIPROT."""
    return df if "INDEX" in df.columns else require(df, "UNIPROT").withColumn("INDEX", F.col("UNIPROT").cast("string"))


def precursors_alias(df: DataFrame) -> DataFrame:
    """"Spectrum Number" serves as PRECURSORS_EXP."""
    return df.withColumnRenamed("Spectrum Number", "PRECURSORS_EXP") if "PRECURSORS_EXP" not in df.columns else df


def unpivot_runs(df: DataFrame, runs: list[str], signal: str = "Intensity", counts: str | None = None) -> DataFrame:
    """Wide to long for named runs: columns are <run> or <run> <signal>; spectral counts ride along in the same pass."""
    columns = {r: next((c for c in (f"{r} {signal}", r) if c in df.columns), None) for r in runs}
    if missing := [r for r, c in columns.items() if c is None]:
        raise ValueError(f"no column for runs {', '.join(missing)}")
    return _stack(df, columns, {r: f"{r} {counts}" for r in runs} if counts else {})


def _stack(df: DataFrame, signals: dict[str, str], counts: dict[str, str]) -> DataFrame:
    used = set(signals.values()) | set(counts.values())
    ids = [c for c in df.columns if c not in used]
    cell = lambda r: F.struct(F.lit(r).alias("FILENAME"), F.col(f"`{signals[r]}`").try_cast("double").alias("SIGNAL"), *([F.col(f"`{counts[r]}`").try_cast("double").alias("SPECTRAL_COUNTS")] if counts else []))
    return df.select(*(F.col(f"`{c}`") for c in ids), F.inline(F.array(*(cell(r) for r in signals))))


def unpivot_labels(df: DataFrame, signal: str = "Intensity", counts: str | None = None) -> DataFrame:
    """Wide to long without an annotation: headers are "<label> <signal>", labels "<condition>_<number>".

    Replicates are renumbered 1..N in each condition by number; if any label doesn't fit, all are condition NA, replicate 1.
    """
    labels = [m[1] for c in df.columns if (m := re.match(rf"^(.+?)\s+{re.escape(signal)}$", c))]
    if not labels:
        raise ValueError(f"no column ends with {signal!r}")
    if counts and {m[1] for c in df.columns if (m := re.match(rf"^(.+?)\s+{re.escape(counts)}$", c))} != set(labels):
        raise ValueError("signal and count columns have different labels")
    parsed = {x: re.match(r"^([A-Za-z]+)_(\d+)$", x) for x in labels}
    if all(parsed.values()):
        by = {}
        for x, m in sorted(parsed.items(), key=lambda p: int(p[1][2])):
            by.setdefault(m[1], []).append(x)
        channel = {x: (cond, i + 1) for cond, of in by.items() for i, x in enumerate(of)}
    else:
        channel = {x: ("NA", 1) for x in labels}
    long = _stack(df, {x: f"{x} {signal}" for x in labels}, {x: f"{x} {counts}" for x in labels} if counts else {})
    # as many rows as the header has labels
    table = df.sparkSession.createDataFrame([(x, *channel[x]) for x in labels], "FILENAME string, CONDITION string, REPLICATE long")
    return long.join(F.broadcast(table), "FILENAME", "left")


def pivot_cells(cells: DataFrame, value: str, samples: list[str], prefix: str = "") -> DataFrame:
    """Feature x sample table of one layer, for export: the list of samples is given, so that no job looks for them."""
    wide = cells.groupBy("INDEX").pivot("Sample", samples).agg(F.first(value))
    return wide.withColumnsRenamed({s: prefix + s for s in samples}) if prefix else wide


def complete_grid(cells: DataFrame, samples: DataFrame) -> DataFrame:
    """Every feature with every sample; absent cells are null. Samples are a small dimension, each feature meets all of them.

    A feature's cells meet in one row, the samples it lacks are added there: one shuffle by INDEX, by which the rows stay
    partitioned, so that what goes on by feature moves none of them again. A null INDEX equals no other: its cells are null.
    """
    values = [c for c in cells.columns if c not in ("INDEX", "Sample")]
    every = samples.agg(F.collect_set("Sample").alias("_every"))  # one row, as many names as samples
    own = F.struct("Sample", *(F.col(c) for c in values))
    held = cells.groupBy("INDEX").agg(F.collect_list(F.when(F.col("INDEX").isNotNull(), own)).alias("_have")).join(F.broadcast(every), how="cross")
    kinds = {x.name: x.dataType for x in cells.schema}
    none = lambda s: F.struct(s.alias("Sample"), *(F.lit(None).cast(kinds[c]).alias(c) for c in values))
    known = F.filter("_have", lambda x: F.array_contains("_every", x["Sample"]))
    return held.select("INDEX", F.inline(F.concat(known, F.transform(F.array_except("_every", F.col("_have")["Sample"]), none))))


def with_row_id(df: DataFrame, name: str = "_ROW_ID") -> DataFrame:
    """A unique number for each row, good for identity alone."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_tags(df: DataFrame, **tags: str | bool) -> DataFrame:
    """Literal columns, as layout, assay or covariate flags."""
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def relaxed_union(frames: list[DataFrame]) -> DataFrame:
    """Union of all columns in order of discovery; the first frame that has a column decides its type, absent ones are null."""
    kinds: dict = {}
    for f in frames:
        for x in f.schema:
            kinds.setdefault(x.name, x.dataType)
    same = [f.select(*(F.col(f"`{x.name}`").try_cast(kinds[x.name]).alias(x.name) if x.dataType != kinds[x.name] else F.col(f"`{x.name}`") for x in f.schema)) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same).select(*(F.col(f"`{c}`") for c in kinds))


def keep_first(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """One row for each key, the first by ``order``."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def difference(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Keys of a that b lacks, and the other way round."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti"), y.join(x, key, "left_anti")
