"""Normalization of cells; each method works on the column that the one before left."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.functions.sequence import contains_any
from quantspark.operators.local_fits import whole_loess
from quantspark.operators.quantiles import quantile_table, quantiles
from quantspark.sources.scratch import stored

METHODS = ("log2", "log10", "median_equalization", "median_equalization_by_tag", "quantile", "global_linear", "local_linear", "global_loess", "local_loess", "none")
#: Points that one sorted part holds.
PART = 250_000


def log_transform(cells: DataFrame, base: int = 2, value: str = "v") -> DataFrame:
    """Logarithm, values clipped at 1e-10; nulls stay."""
    log = {2: F.log2, 10: F.log10}[base]
    return cells.withColumn(value, F.when(F.col(value).isNotNull(), log(F.greatest(F.col(value), F.lit(1e-10)))))


def unlog(cells: DataFrame, value: str = "v", out: str = "raw") -> DataFrame:
    """Input that is log2 already: the raw layer is 2 ** v."""
    return cells.withColumn(out, F.pow(F.lit(2.0), value))


def _by_sample(cells: DataFrame, factors: DataFrame, value: str) -> DataFrame:
    """Multiply by a sample's factor (1 where it has none). Factors are a row a sample: found once, then broadcast."""
    return cells.join(F.broadcast(stored(factors, "factors")), "Sample", "left").withColumn(value, F.col(value) * F.coalesce("_factor", F.lit(1.0))).drop("_factor")


def _median_factors(cells: DataFrame, value: str) -> DataFrame:
    own, whole = quantiles(cells, ["Sample"], value, _m=0.5), quantiles(cells, [], value, _g=0.5)
    return own.join(whole, how="cross").select("Sample", (F.col("_g") / F.when(F.col("_m") != 0, F.col("_m"))).alias("_factor"))


def median_equalization(cells: DataFrame, value: str = "v") -> DataFrame:
    """v * (global median / sample median), multiplicative on logarithms too."""
    return _by_sample(cells, _median_factors(cells, value), value)


def median_equalization_by_tag(cells: DataFrame, features: DataFrame, tags: list[str], column: str = "FASTA_HEADERS", value: str = "v") -> DataFrame:
    """The same with factors from features whose header holds a tag; samples without a value there keep factor 1, and without any match nothing changes."""
    reference = features.filter(contains_any(F.col(column), tags)).select("INDEX")
    return _by_sample(cells, _median_factors(cells.join(reference, "INDEX", "left_semi"), value), value)


def quantile_uniform(cells: DataFrame, value: str = "v", most: int = 1000) -> DataFrame:
    """Each sample mapped to [0, 1] by min(``most``, its number of values) quantiles; ties go to the middle of their quantiles.

    The grid of a sample is one array of at most ``most`` numbers, its sorted values where it has no more than that; a
    value is interpolated on it from both ends. The only value of a sample becomes 0.
    """
    grid = quantile_table(cells, ["Sample"], value, [i / (most - 1) for i in range(most)])
    grid = grid.groupBy("Sample").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "q"))), lambda x: x["q"]).alias("_many"))
    sizes = cells.groupBy("Sample").agg(F.count(value).alias("_n"))
    small = sizes.filter(F.col("_n") <= most)
    # one row for each sample
    few = cells.join(F.broadcast(small), "Sample", "left_semi").groupBy("Sample").agg(F.sort_array(F.collect_list(value)).alias("_few"))
    n = sizes.join(grid, "Sample", "left").join(few, "Sample", "left").select("Sample", F.coalesce("_few", "_many").alias("_grid")).filter("size(_grid) > 0")
    grids = _arrays(n)

    def place(x: np.ndarray, grid: np.ndarray) -> np.ndarray:
        last, under, upto = len(grid) - 1, np.searchsorted(grid, x), np.searchsorted(grid, x, "right")
        low, high = grid[np.clip(under - 1, 0, last)], grid[np.clip(under, 0, last)]
        with np.errstate(divide="ignore", invalid="ignore"):
            between = under - 1 + (x - low) / (high - low)
        at = np.where(upto > under, (under + upto - 1) / 2, np.where(under == 0, 0.0, np.where(under > last, last, between)))
        return at / last if last else np.zeros(len(x))

    return cells.withColumn(value, _on_own(grids, place)(F.col("Sample"), F.col(value)))


def _arrays(table: DataFrame) -> dict[str, tuple[np.ndarray, ...]]:
    """The arrays of each sample, from Sample and arrays of doubles: a row a sample, of bounded length."""
    return {r[0]: tuple(np.array(x, float) for x in r[1:]) for r in table.collect()}


def _on_own(arrays: dict[str, tuple[np.ndarray, ...]], f: Callable[..., np.ndarray]) -> Callable[[Column, Column], Column]:
    """A column function of (Sample, x): ``f`` of the known x of each sample and of that sample's arrays; null elsewhere."""
    held = SparkSession.active().sparkContext.broadcast(arrays)

    @F.pandas_udf("double")
    def apply(sample: pd.Series, x: pd.Series) -> pd.Series:
        v, out = x.to_numpy(float, na_value=np.nan), np.full(len(x), np.nan)
        codes, names = pd.factorize(sample)
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(names) + 1))
        for name, a, b in zip(names, ends, ends[1:]):
            rows = order[a:b]
            rows = rows[~np.isnan(v[rows])]
            if name in held.value and len(rows):
                out[rows] = f(v[rows], *held.value[name])
        return pd.Series(out)

    return apply


def _first(value: str) -> Column:
    """The value of the first sample of a group."""
    return F.min_by(value, "Sample")


def _with_condition(cells: DataFrame, samples: DataFrame) -> DataFrame:
    return cells.join(F.broadcast(samples.select("Sample", "CONDITION")), "Sample", "left")  # a row a sample


def first_values(cells: DataFrame, samples: DataFrame, value: str = "v") -> DataFrame:
    """INDEX, CONDITION, ref: the value of the condition's first sample among the known cells of a feature."""
    return _with_condition(cells.filter(F.col(value).isNotNull()), samples).groupBy("INDEX", "CONDITION").agg(_first(value).alias("ref"))


def reference_values(cells: DataFrame, samples: DataFrame, scale: str = "global", value: str = "v") -> DataFrame:
    """Add ``ref``: the feature's mean, or (local) the value of the condition's first sample, else the feature's mean."""
    feature = Window.partitionBy("INDEX")
    if scale == "global":
        return cells.withColumn("ref", F.avg(value).over(feature))
    first = _first(value).over(Window.partitionBy("INDEX", "CONDITION"))
    # the order changes no mean, as the frame is the whole feature: by it both windows share one sort
    mean = F.avg(value).over(feature.orderBy("CONDITION").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return _with_condition(cells, samples).withColumn("ref", F.coalesce(first, mean)).drop("CONDITION")


def ma(cells: DataFrame, value: str = "v") -> DataFrame:
    """Add M (mean of value and reference) and A (their difference)."""
    return cells.withColumns({"M": (F.col(value) + F.col("ref")) / 2, "A": F.col(value) - F.col("ref")})


def filled_for_fit(cells: DataFrame, value: str = "v", out: str = "fit") -> DataFrame:
    """Nulls become the feature's median, for a fit only."""
    return cells.withColumn(out, F.coalesce(value, F.median(value).over(Window.partitionBy("INDEX"))))


def linear_by_least_squares(cells: DataFrame, samples: DataFrame, scale: str = "global", value: str = "v") -> DataFrame:
    """Subtract a line A ~ M fitted by least squares for each sample; samples without spread are only centred."""
    at = ma(reference_values(filled_for_fit(cells, value), samples, scale, value).withColumn("_v", F.col(value)).withColumn(value, F.col("fit")), value)
    lines = at.groupBy("Sample").agg(F.regr_slope("A", "M").alias("_b"), F.avg("A").alias("_ma"), F.avg("M").alias("_mm"))
    predicted = F.coalesce(F.col("_b"), F.lit(0.0)) * (F.col("M") - F.col("_mm")) + F.col("_ma")
    return at.join(lines, "Sample", "left").withColumn(value, F.col("_v") - predicted).select(*cells.columns)


def linear_robust(cells: DataFrame, samples: DataFrame, scale: str = "global", value: str = "v", tries: int = 100, seed: int = 42) -> DataFrame:
    """Subtract a robust line A ~ M for each sample.

    ``tries`` lines through two hashed points each compete; the one with most points within the median absolute
    deviation of A (and 1e-9, so that rounding doesn't choose) wins, and a least-squares line through those points is
    subtracted.
    """
    at = ma(reference_values(filled_for_fit(cells, value), samples, scale, value).withColumn("_v", F.col(value)).withColumn(value, F.col("fit")), value)
    points = stored(at.filter("M IS NOT NULL AND A IS NOT NULL").select("INDEX", "Sample", "M", "A"), "points")  # read several times
    # the 2 * tries smallest hashes of a sample are below a bound that its size gives, with room for twenty times the
    # deviation of their number; only what is below meets in a window
    place = F.conv(F.substring(F.md5(F.concat_ws("|", "INDEX", F.lit(str(seed)))), 1, 15), 16, 10).cast("long")
    sizes = points.groupBy("Sample").agg(F.least(F.lit(1.0), (2 * tries + 20 * (2 * tries) ** 0.5 + 50) / F.count(F.lit(1))).alias("share"))
    low = points.withColumn("place", place).join(F.broadcast(sizes), "Sample").filter(F.col("place") < F.col("share") * float(1 << 60))  # a row a sample
    drawn = low.withColumn("rn", F.row_number().over(Window.partitionBy("Sample").orderBy("place", "INDEX"))).filter(F.col("rn") <= 2 * tries)
    pairs = drawn.groupBy("Sample", F.expr("(rn - 1) div 2").alias("k")).agg(F.min(F.struct("rn", "M", "A")).alias("p"), F.max(F.struct("rn", "M", "A")).alias("q")).filter("abs(q.M - p.M) > 1e-9")
    lines = pairs.select("Sample", "k", ((F.col("q.A") - F.col("p.A")) / (F.col("q.M") - F.col("p.M"))).alias("b"), F.col("p.M").alias("m0"), F.col("p.A").alias("a0"))
    # tables of a row a sample are found once
    medians = stored(quantiles(points, ["Sample"], "A", med=0.5), "medians")
    off = points.join(F.broadcast(medians), "Sample").select("Sample", F.abs(F.col("A") - F.col("med")).alias("off"))
    lines = stored(lines.join(F.broadcast(quantiles(off, ["Sample"], "off", mad=0.5)), "Sample").withColumn("reach", F.col("mad") + 1e-9), "lines")
    # at most `tries` lines a sample; each task counts a sample's points near each and sends the counts alone
    held = lines.groupBy("Sample").agg(F.sort_array(F.collect_list(F.struct("k", "b", "m0", "a0", "reach"))).alias("of"))
    tried = _arrays(held.select("Sample", *(F.col("of")[c].cast("array<double>").alias(c) for c in ("k", "b", "m0", "a0", "reach"))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {s: np.zeros(len(of[0]), np.int64) for s, of in tried.items()}
        for batch in batches:
            m, a = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("M", "A"))
            codes, names = pd.factorize(batch.column("Sample").to_pandas())
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(len(names) + 1))
            for s, start, end in zip(names, ends, ends[1:]):
                if s in tried:
                    rows, (_, b, m0, a0, reach) = order[start:end], tried[s]
                    found[s] += (np.abs(a[rows, None] - a0 - b * (m[rows, None] - m0)) <= reach).sum(0)
        parts = [pa.RecordBatch.from_arrays([pa.array([s] * len(n), pa.string()), pa.array(tried[s][0].astype(np.int64)), pa.array(n)], names=["Sample", "k", "n"]) for s, n in found.items()]
        yield from parts

    counts = points.select("Sample", "M", "A").mapInArrow(count, "Sample string, k long, n long").groupBy("Sample", "k").agg(F.sum("n").alias("n"))
    best = counts.groupBy("Sample").agg(F.max(F.struct("n", -F.col("k"))).alias("w")).select("Sample", (-F.col("w.col2")).alias("k"))
    best = stored(best.join(lines, ["Sample", "k"]), "best-lines")
    inlier = F.abs(F.col("A") - F.col("a0") - F.col("b") * (F.col("M") - F.col("m0"))) <= F.col("reach")
    fit = points.join(F.broadcast(best), "Sample").filter(inlier).groupBy("Sample").agg(F.regr_slope("A", "M").alias("_b"), F.avg("A").alias("_ma"), F.avg("M").alias("_mm"))
    predicted = F.coalesce(F.col("_b"), F.lit(0.0)) * (F.col("M") - F.coalesce("_mm", F.lit(0.0))) + F.coalesce("_ma", F.lit(0.0))
    return at.join(F.broadcast(stored(fit, "fitted-lines")), "Sample", "left").withColumn(value, F.col("_v") - predicted).select(*cells.columns)


def _loess(x: np.ndarray, y: np.ndarray, at: np.ndarray, span: float) -> np.ndarray:
    """Local quadratic fits with tricube weights."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    k = max(3, min(len(x), int(np.ceil(span * len(x)))))
    out, left = np.empty(len(at)), 0
    for i in np.argsort(at, kind="stable"):
        c = at[i]
        while left + k < len(x) and x[left + k] - c < c - x[left]:
            left += 1
        d, own = x[left : left + k] - c, y[left : left + k]
        h = max(np.abs(d).max(), 1e-12) * 1.0000001
        u = d / h
        t = 1 - np.abs(u * u * u)
        w = t * np.sqrt(t)  # square root of the tricube weight
        x3 = np.stack([w, w * u, w * u * u])
        g = x3 @ x3.T
        if np.linalg.cond(g) < 1e8:
            out[i] = np.linalg.solve(g, x3 @ (w * own))[0]
        else:  # too few distinct points for a quadratic
            out[i] = np.linalg.lstsq(np.stack([w, w * d, w * d * d], 1), w * own, rcond=None)[0][0]
    return out


def _ranks(points: DataFrame) -> DataFrame:
    """Add ``rank`` (from 1, by M and INDEX) and ``n`` of each sample: points are sorted over all tasks, and what stands in
    earlier parts is added, so that no task sorts a sample."""
    width = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-points.count() // PART))
    order = ("Sample", "M", "INDEX")
    placed = points.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    parts = stored(placed.withColumn("_part", F.spark_partition_id()), "sorted-points")
    counts = parts.groupBy("Sample", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_least"))  # a row a part and sample
    of = Window.partitionBy("Sample")
    counts = stored(counts.withColumns({"_before": F.sum("_n").over(of.orderBy("_part")) - F.col("_n"), "n": F.sum("_n").over(of)}), "sorted-counts")
    return parts.join(F.broadcast(counts.drop("_n")), ["Sample", "_part"]).withColumn("rank", F.col("_before") + F.col("_id") - F.col("_least") + 1).drop("_id", "_least", "_before", "_part")


def loess(cells: DataFrame, samples: DataFrame, scale: str = "global", span: float = 0.9, knots: int = 2000, exact: int = 20_000, value: str = "v") -> DataFrame:
    """Subtract a LOESS curve A ~ M for each sample, fitted on all its points, at every point, whatever their number.

    One task fits a sample of up to ``exact`` points. A larger one is cut by rank into about ``knots`` blocks, of
    ``local_fits.BLOCK`` points at most; windows are summed from blocks' power sums, which gives the same fits up to rounding.
    """
    at = ma(reference_values(filled_for_fit(cells, value), samples, scale, value).withColumn("_v", F.col(value)).withColumn(value, F.col("fit")), value)
    points = stored(at.filter("M IS NOT NULL AND A IS NOT NULL").select("INDEX", "Sample", "M", "A"), "points")
    sizes = {r["Sample"]: r["count"] for r in points.groupBy("Sample").count().collect()}  # as many rows as samples
    small, large = ([s for s, n in sizes.items() if (n <= max(exact, 3)) == is_small] for is_small in (True, False))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        m, a = pdf["M"].to_numpy(), pdf["A"].to_numpy()
        return pd.DataFrame({"INDEX": pdf["INDEX"], "Sample": pdf["Sample"], "_fit": _loess(m, a, m, span) if len(m) > 3 else np.full(len(m), a.mean())})

    fits = []
    if small:
        fits.append(points.filter(F.col("Sample").isin(small)).groupBy("Sample").applyInPandas(fit, "INDEX string, Sample string, _fit double"))
    if large:
        fits.append(whole_loess(_ranks(points.filter(F.col("Sample").isin(large))), {s: sizes[s] for s in large}, span, knots))
    if not fits:
        return cells
    return at.join(reduce(DataFrame.unionByName, fits), ["INDEX", "Sample"], "left").withColumn(value, F.col("_v") - F.coalesce("_fit", F.lit(0.0))).select(*cells.columns)


def normalize(cells: DataFrame, methods: str | list[str] | None, samples: DataFrame, features: DataFrame | None = None, tags: list[str] | None = None, span: float = 0.9, value: str = "v") -> DataFrame:
    """Apply the methods in order; after the first logarithm the values are kept as ``lognorm`` too."""
    for method in [methods] if isinstance(methods, str) else methods or ["none"]:
        scale = "local" if method.startswith("local") else "global"
        match method:
            case "log2" | "log10":
                cells = log_transform(cells, int(method[3:]), value).withColumn("lognorm", F.col(value))
            case "median_equalization":
                cells = median_equalization(cells, value)
            case "median_equalization_by_tag":
                cells = median_equalization_by_tag(cells, features, tags or [], value=value)
            case "quantile":
                cells = quantile_uniform(cells, value)
            case "global_linear" | "local_linear":
                cells = linear_robust(cells, samples, scale, value)
            case "global_loess" | "local_loess":
                cells = loess(cells, samples, scale, span, value=value)
            case "none":
                pass
            case _:
                raise ValueError(f"unknown normalization {method!r}; one of {', '.join(METHODS)}")
    return cells


def diagnostics(methods: str | list[str] | None, tags: list[str] | None = None, span: float | None = None) -> list[tuple[str, str]]:
    """What was asked for, as (name, value) rows."""
    names = [methods] if isinstance(methods, str) else methods or ["none"]
    return [("methods", ",".join(names)), ("tags", ",".join(tags or [])), ("span", "" if span is None else str(span))]

