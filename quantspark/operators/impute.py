"""Imputation of the complete grid. Input: INDEX, Sample, v (null: missing); output adds ``imputed``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.functions.numeric import noise
from quantspark.operators.neighbours import CORRELATION, EUCLIDEAN, Measure, Nearest, feature_donors
from quantspark.operators.products import feature_vectors, sample_names, sample_products, squared_distance, with_other_side
from quantspark.operators.quantiles import quantiles
from quantspark.sources.scratch import stored


def _done(cells: DataFrame, fill: Column, keep: list[str]) -> DataFrame:
    return cells.withColumn("imputed", F.col("v").isNull()).withColumn("v", F.coalesce("v", fill)).select(*keep, "imputed")


def row_mean(cells: DataFrame) -> DataFrame:
    """The feature's mean; 0 without any value."""
    return _done(cells, F.coalesce(F.avg("v").over(Window.partitionBy("INDEX")), F.lit(0.0)), cells.columns)


def row_median(cells: DataFrame) -> DataFrame:
    return _done(cells, F.coalesce(F.median("v").over(Window.partitionBy("INDEX")), F.lit(0.0)), cells.columns)


def column_mean(cells: DataFrame) -> DataFrame:
    """The sample's mean; 0 without any value."""
    own = cells.groupBy("Sample").agg(F.avg("v").alias("_m"))
    return _done(cells.join(own, "Sample", "left"), F.coalesce("_m", F.lit(0.0)), cells.columns)


def min_det(cells: DataFrame, quantile: float = 0.01, shift: float = 0.2) -> DataFrame:
    """A low quantile of the sample less a shift; a sample without values takes the global minimum."""
    own = stored(quantiles(cells, ["Sample"], "v", _q=quantile), "low-quantiles")
    whole = cells.agg(F.min("v").alias("_low"))
    at = cells.join(F.broadcast(own), "Sample", "left").join(F.broadcast(whole), how="cross")  # a row a sample, one row
    return _done(at, F.coalesce(F.col("_q") - shift, "_low"), cells.columns)


def min_prob(cells: DataFrame, quantile: float = 0.01, mu_shift: float = 1.8, sd_width: float = 0.3, clip: bool = True, seed: int = 42) -> DataFrame:
    """Noise around (low quantile - mu_shift * SD) with sd_width * SD of the sample, at most the quantile."""
    whole = cells.agg(F.stddev_samp("v").alias("_gsd")).join(quantiles(cells, [], "v", _gq=quantile), how="cross")
    own = cells.groupBy("Sample").agg(F.stddev_samp("v").alias("_sd")).join(quantiles(cells, ["Sample"], "v", _q=quantile), "Sample", "left")
    usable = lambda c: F.when(F.col(c) > 0, F.col(c))
    own = own.join(F.broadcast(whole), how="cross").select("Sample", F.coalesce("_q", "_gq").alias("_q"), F.coalesce(usable("_sd"), usable("_gsd"), F.lit(1.0)).alias("_sd"))
    drawn = F.col("_q") - mu_shift * F.col("_sd") + noise("INDEX", "Sample", seed=seed) * sd_width * F.col("_sd")
    return _done(cells.join(own, "Sample", "left"), F.least(drawn, F.col("_q")) if clip else drawn, cells.columns)


def detection_limit(cells: DataFrame, k: int | None = 10) -> DataFrame:
    """lod: median of the k lowest values (k None: one percent of them, 10 to 50); 0 without values. One row."""
    if k is None:
        n = cells.filter("v IS NOT NULL").count()
        k = min(50, max(10, -(-n // 100)))
    lowest = cells.filter("v IS NOT NULL").select("v").orderBy("v").limit(k)
    return lowest.agg(F.coalesce(F.median("v"), F.lit(0.0)).alias("lod"))


def _of_sorted(values: Column, share: float) -> Column:
    """Quantile of a sorted array, interpolated in the same form as Spark's percentile; null of an empty one."""
    at = (F.size(values) - 1) * F.lit(share)
    low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
    a, b = F.get(values, low), F.get(values, high)
    return F.when(a == b, a).otherwise((high - at) * a + (at - low) * b)


def _condition_groups(at: DataFrame, least: int, q_lower: float, q_upper: float) -> DataFrame:
    """INDEX, CONDITION, n, center, lower, upper, pooled_sd, and ``_cells``: the group's own cells.

    A group is one row and meets its feature's others in a window: what is by INDEX already moves no more.
    """
    held = [c for c in at.columns if c not in ("INDEX", "CONDITION")]
    own = at.groupBy("INDEX", "CONDITION").agg(
        F.count("v").alias("n"), F.sort_array(F.collect_list("v")).alias("_sorted"), F.var_samp("v").alias("s2"), F.sum("v").alias("t"), F.sum(F.col("v") * F.col("v")).alias("tt"),
        F.collect_list(F.struct(*held)).alias("_cells"),
    )
    counted = F.col("n") >= least
    by = Window.partitionBy("INDEX")
    df = F.sum(F.when(counted & (F.col("n") >= 2), F.col("n") - 1)).over(by)
    ss = F.sum(F.when(counted & (F.col("n") >= 2), (F.col("n") - 1) * F.col("s2"))).over(by)
    n, t, tt = (F.sum(F.when(counted, F.col(c))).over(by) for c in ("n", "t", "tt"))
    alone = F.when(n >= 2, F.sqrt(F.greatest((tt - t * t / n) / (n - 1), F.lit(0.0)))).otherwise(F.lit(0.0))
    pooled = F.greatest(F.coalesce(F.sqrt(ss / df), alone, F.lit(0.0)), F.lit(1e-8))
    shares = [_of_sorted(F.col("_sorted"), q).alias(c) for c, q in (("center", 0.5), ("lower", q_lower), ("upper", q_upper))]
    return own.withColumn("pooled_sd", pooled).select("INDEX", "CONDITION", "n", *shares, "pooled_sd", "_cells")


def condition_bounds(cells: DataFrame, samples: DataFrame, least: int = 1, q_lower: float = 0.25, q_upper: float = 0.75) -> DataFrame:
    """INDEX, CONDITION, n, center, lower, upper of observed values, and the feature's pooled SD."""
    at = cells.select("INDEX", "Sample", "v").join(F.broadcast(samples.select("Sample", "CONDITION")), "Sample")  # a row a sample
    return _condition_groups(at, least, q_lower, q_upper).drop("_cells")


def condition_median(cells: DataFrame, samples: DataFrame, lod_k: int | None = 10, jitter: float = 0.2, least: int = 1, q_lower: float = 0.25, q_upper: float = 0.75, lod_shift: float = 0.2, lod_sd: float = 0.05, seed: int = 42) -> DataFrame:
    """Left-censored: noise around the condition's median inside its quartiles; without enough values there, or without
    a known feature or condition, below the detection limit."""
    at = cells.join(F.broadcast(samples.select("Sample", "CONDITION")), "Sample")  # a row a sample
    named = F.col("INDEX").isNotNull() & F.col("CONDITION").isNotNull()
    groups = _condition_groups(at.filter(named), least, q_lower, q_upper)
    bounds = ["n", "center", "lower", "upper", "pooled_sd"]
    placed = groups.select("INDEX", "CONDITION", *bounds, F.inline("_cells")).unionByName(at.filter(~named), allowMissingColumns=True)
    placed = placed.join(F.broadcast(detection_limit(cells, lod_k)), how="cross")  # one row
    z = noise("INDEX", "Sample", seed=seed)
    inside = F.greatest(F.col("lower"), F.least(F.col("upper"), F.col("center") + z * F.greatest(jitter * F.col("pooled_sd"), F.lit(1e-8))))
    under = F.least(F.col("lod"), F.col("lod") - lod_shift + z * max(lod_sd, 1e-8))
    return _done(placed, F.when(F.col("n") >= least, inside).otherwise(under), cells.columns)


def detection_limit_fill(cells: DataFrame, k: int | None = None, shift: float = 0.2, sd: float = 0.05, seed: int = 42) -> DataFrame:
    """For embeddings: noise below the detection limit, whatever the condition."""
    under = F.least(F.col("lod"), F.col("lod") - shift + noise("INDEX", "Sample", seed=seed) * sd)
    return _done(cells.join(F.broadcast(detection_limit(cells, k)), how="cross"), under, cells.columns)


def sample_distances(cells: DataFrame) -> DataFrame:
    """src, dst, dist between samples: root mean squared difference of z-scores over features that both have."""
    known = cells.filter("INDEX IS NOT NULL AND v IS NOT NULL").select("INDEX", "Sample", "v")
    pairs = squared_distance(sample_products(known, centre=True, scale=True)).filter("a <> b")
    return pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.sqrt(F.col("d2") / F.col("n")).alias("dist"))


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each source, ties by name."""
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy("dist", "dst"))).filter(F.col("rank") <= k)


def knn_samples(cells: DataFrame, k: int = 6) -> DataFrame:
    """Mean over the k nearest samples, which stand in with the feature's minimum where they have no value; 0 for a feature without any.

    A feature is one row that holds its own cells, so that gaps are filled in place: no gap meets its donors by a join.
    """
    place = {name: i for i, name in enumerate(sample_names(cells))}
    donors: list[list[int]] = [[] for _ in place]
    for src, dst in nearest(sample_distances(cells), k).select("src", "dst").collect():  # k rows a sample
        donors[place[src]].append(place[dst])

    @F.arrow_udf("array<double>")
    def fills(at: pa.Array, v: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(at).to_numpy(zero_copy_only=False)
        row, i = np.repeat(np.arange(len(at)), sizes), at.flatten().to_numpy(zero_copy_only=False)
        x = np.full((len(at), len(donors)), np.nan)
        x[row, i] = v.flatten().to_numpy(zero_copy_only=False)
        low = np.fmin.reduce(x, 1)[:, None]
        there = np.where(np.isnan(x), low, x)
        out = np.nan_to_num(np.hstack([there[:, of].mean(1, keepdims=True) if of else low for of in donors]))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(out[row, i]))

    names = cells.sparkSession.createDataFrame(list(place.items()), "Sample string, _i int")
    held = [c for c in cells.columns if c != "INDEX"]
    # a row a sample
    rows = cells.filter("INDEX IS NOT NULL").join(F.broadcast(names), "Sample").groupBy("INDEX").agg(F.collect_list(F.struct("_i", *held)).alias("_have"))
    filled = rows.withColumn("_f", fills(F.col("_have._i"), F.col("_have.v").cast("array<double>"))).select("INDEX", F.inline(F.arrays_zip("_have", "_f")))
    at = filled.select("INDEX", *(F.col(f"_have.{c}").alias(c) for c in held), "_f").unionByName(cells.filter("INDEX IS NULL"), allowMissingColumns=True)
    return _done(at, F.coalesce("_f", F.lit(0.0)), cells.columns)


def equal_features(cells: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(cells of one feature for each class of features with equal values, members). The least name stands for its class;
    members: INDEX, rep, place (from 1 by name), size."""
    vectors = feature_vectors(cells, names).filter("INDEX IS NOT NULL")
    by = Window.partitionBy("x")
    placed = vectors.select("INDEX", F.min("INDEX").over(by).alias("rep"), F.row_number().over(by.orderBy("INDEX")).alias("place"), F.count(F.lit(1)).over(by).alias("size"))
    members = stored(placed, "equal-features")
    return cells.join(members.filter("place = 1").select("INDEX"), "INDEX", "left_semi"), members


def _taken(found: Nearest, sizes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many members of each class found are among the first ``room`` of a cell, if no two classes are equally far."""
    size = np.where(found.donor >= 0, sizes[found.donor] if len(sizes) else 0, 0)
    return np.clip(room[:, None] - (np.cumsum(size, 1) - size), 0, size)


def _by_name(room: int, entries: list[tuple[float, str, int]], count: int) -> np.ndarray:
    """The same where ties go by name: (distance, name, which of the classes; -1: none that has a value)."""
    out = np.zeros(count, int)
    for _, _, c in sorted(entries)[:room]:
        if c >= 0:
            out[c] += 1
    return out


def _class_fills(weight: Callable[[np.ndarray], np.ndarray]) -> Callable[[Nearest, list[str]], pa.Table]:
    """INDEX, place, fill: the weighted mean of each gap's k nearest features for the members of a class at ``place`` by
    name; beyond place k + 1 all members have that of place k + 1. Where donors need a value there it is one for all (place 0).

    The k nearest features lie in the k nearest classes, ordered by distance and first name. A member's equals lack a value
    where it does: they come in only where donors need no value, at distance 0 of rounding (1 without spread).
    """

    def fills(found: Nearest, names: list[str]) -> pa.Table:
        k, width, x = found.k, len(names), found.values()
        of = found.donors["names"].to_pylist()
        sizes = np.array([min(len(n), k) for n in of], int)
        w, there = weight(found.dist), found.donor >= 0
        if found.needs_value:
            take = _taken(found, sizes, np.full(len(found.dist), k))
            equal = (found.dist[:, 1:] == found.dist[:, :-1]) & there[:, 1:]
            for r in np.flatnonzero(equal.any(1) & (np.where(there, sizes[found.donor] if len(sizes) else 0, 0).sum(1) > k)):
                take[r] = _by_name(k, [(found.dist[r, c], n, c) for c in np.flatnonzero(there[r]) for n in of[found.donor[r, c]][:k]], k)
            row, j = np.nonzero(found.gaps)
            cell = row * width + j
            parts = np.where(there[cell], take[cell] * w[cell], 0.0)
            value = np.where(there[cell], x[found.donor[cell], j[:, None]] if len(x) else 0.0, 0.0)
            fill = np.full(found.gaps.shape, np.nan)
            with np.errstate(divide="ignore", invalid="ignore"):
                fill[row, j] = (parts * value).sum(1) / parts.sum(1)
            return _fill_rows(found.asks["INDEX"], np.arange(len(fill)), np.zeros(len(fill), int), fill)
        own = found.asks["names"].to_pylist()
        flat = np.ptp(np.nan_to_num(found.x), axis=1) == 0 if len(found.x) else np.zeros(0, bool)
        equals = np.array([len(n) - 1 for n in own], int)  # at most k
        places = equals + 1
        take = _taken(found, sizes, np.maximum(k - equals, 0))
        row = np.repeat(np.arange(len(own)), places)
        place = np.arange(len(row)) - np.repeat(np.cumsum(places) - places, places) + 1
        taken = take[row]
        least = np.where(flat, 1.0, 0.0)
        near = there & (found.dist <= least[:, None])
        equal = (found.dist[:, 1:] == found.dist[:, :-1]) & there[:, 1:]
        total = np.where(there, sizes[found.donor] if len(sizes) else 0, 0).sum(1) + equals
        slow = (equal.any(1) | (near.any(1) & (equals > 0))) & (total > k)
        for r in np.flatnonzero(slow[row]):
            i = row[r]
            entries = [(found.dist[i, c], n, c) for c in np.flatnonzero(there[i]) for n in of[found.donor[i, c]][:k]]
            entries += [(least[i], n, -1) for at, n in enumerate(own[i], 1) if at != place[r]]
            taken[r] = _by_name(k, entries, k)
        value = np.where(there[:, :, None], x[found.donor] if len(x) else np.nan, np.nan)
        fill = np.full((len(row), width), np.nan)
        with np.errstate(divide="ignore", invalid="ignore"):
            for c in range(k):
                parts = np.where(np.isnan(value[row, c]), 0.0, (taken[:, c] * w[row, c])[:, None])
                above, under = (parts * np.nan_to_num(value[row, c]), parts) if c == 0 else (above + parts * np.nan_to_num(value[row, c]), under + parts)
            fill = np.where(found.gaps[row] & (under > 0), above / under, np.nan)
        return _fill_rows(found.asks["INDEX"], row, place, fill)

    return fills


def _fill_rows(index: pa.ChunkedArray, row: np.ndarray, place: np.ndarray, fill: np.ndarray) -> pa.Table:
    width = fill.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(fill) + 1) * width, pa.int32()), pa.array(fill.ravel(), pa.float64(), from_pandas=True))
    return pa.table([index.combine_chunks().take(pa.array(row)), pa.array(place, pa.int32()), lists], names=["INDEX", "place", "_fills"])


def _filled(at: DataFrame, some: DataFrame, members: DataFrame, names: list[str], k: int, measure: Measure, needs_value: bool, weight: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``at`` with ``_f``, what the nearest features give a gap. A feature's fills come as one row, so that no cell moves for them."""
    first = members.filter(F.col("place") <= k + 1).groupBy(F.col("rep").alias("INDEX")).agg(F.sort_array(F.collect_list("INDEX")).alias("names"))
    fills, _ = feature_donors(some, k, measure, needs_value, None, "v", first, _class_fills(weight), "INDEX string, place int, _fills array<double>", names)
    own = members.select("INDEX", "rep", (F.lit(0) if needs_value else F.least("place", F.lit(k + 1))).cast("int").alias("place"))
    of = own.join(fills.withColumnRenamed("INDEX", "rep"), ["rep", "place"]).select("INDEX", "_fills")
    place = F.create_map(*(F.lit(x) for pair in ((n, i) for i, n in enumerate(names)) for x in pair))
    return at.join(of, "INDEX", "left").withColumn("_f", F.get("_fills", F.try_element_at(place, F.col("Sample")))).drop("_fills")


def knn_features(cells: DataFrame, k: int = 6) -> DataFrame:
    """Mean over the k nearest features that have the sample; without one the sample's mean. Equal features are looked up once."""
    names = sample_names(cells)
    some, members = equal_features(cells, names)
    own = stored(cells.groupBy("Sample").agg(F.avg("v").alias("_m")), "sample-means")
    at = _filled(cells, some, members, names, k, EUCLIDEAN, True, np.ones_like).join(F.broadcast(own), "Sample", "left")  # a row a sample
    return _done(at, F.coalesce("_f", "_m", F.lit(0.0)), cells.columns)


def knn_correlated(cells: DataFrame, k: int = 10) -> DataFrame:
    """Weighted mean of the k features with the strongest correlation, standardized; without a value there, the lowest value of all."""
    low = cells.agg(F.min("v").alias("_lod"))
    stats = cells.groupBy("INDEX").agg(F.avg("v").alias("_mu"), F.stddev_pop("v").alias("_sd"))
    at = cells.join(stats, "INDEX").join(F.broadcast(low), how="cross").withColumn("_sd", F.when(F.col("_mu").isNull(), 1.0).when(F.col("_sd") > 0, F.col("_sd")).otherwise(1e-8)).withColumn("_mu", F.coalesce("_mu", "_lod"))
    names = sample_names(cells)
    _, members = equal_features(cells, names)
    scaled = at.select("INDEX", "Sample", ((F.col("v") - F.col("_mu")) / F.col("_sd")).alias("v"))
    some = scaled.join(members.filter("place = 1").select("INDEX"), "INDEX", "left_semi")
    filled = _filled(at, some, members, names, k, CORRELATION, False, lambda dist: 1 / (dist + 1e-6))
    return _done(filled, F.coalesce(F.col("_f") * F.col("_sd") + F.col("_mu"), "_lod"), cells.columns)


def boosted(cells: DataFrame, rounds: int = 20, depth: int = 6, trees: int = 100, rate: float = 0.1, tolerance: float = 0.05, nearest_samples: int = 50, seed: int = 42) -> DataFrame:
    """Iterative regression: each sample with gaps is predicted from its ``nearest_samples`` most correlated ones by
    gradient-boosted trees, round by round, until no fill moves by more than ``tolerance`` of the largest observed value.

    Fills start at the sample's mean. Each round is written to the shared folder, so that plans don't grow.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    names = sample_names(cells)
    safe = {s: f"s{i}" for i, s in enumerate(names)}
    wide = cells.groupBy("INDEX").pivot("Sample", names).agg(F.first("v")).withColumnsRenamed(safe)
    facts = wide.agg(*(F.avg(c).alias(c) for c in safe.values()), *(F.count_if(F.col(c).isNull()).alias(f"{c}_n") for c in safe.values()), F.greatest(F.lit(0.0), *(F.coalesce(F.max(F.abs(c)), F.lit(0.0)) for c in safe.values())).alias("most")).first().asDict()
    gaps = [c for c in safe.values() if facts[f"{c}_n"]]
    near = correlated_samples(cells, nearest_samples)
    now = wide.withColumns({f"{c}_gap": F.col(c).isNull() for c in gaps}).fillna({c: facts[c] or 0.0 for c in safe.values()})
    for _ in range(rounds):
        before = now = stored(now, "round")
        for c in gaps:
            inputs = VectorAssembler(inputCols=[safe[x] for x in near.get(names[int(c[1:])], [x for x in names if safe[x] != c])], outputCol="_x")
            known = inputs.transform(now.filter(~F.col(f"{c}_gap")))
            model = GBTRegressor(featuresCol="_x", labelCol=c, predictionCol="_p", maxDepth=depth, maxIter=trees, stepSize=rate, seed=seed).fit(known)
            now = stored(model.transform(inputs.transform(now)).withColumn(c, F.when(F.col(f"{c}_gap"), F.col("_p")).otherwise(F.col(c))).drop("_x", "_p"), "column")
        old = before.select("INDEX", *(F.col(c).alias(f"{c}_old") for c in gaps))
        moved = now.join(old, "INDEX").agg(F.max(F.greatest(F.lit(0.0), *(F.abs(F.col(c) - F.col(f"{c}_old")) for c in gaps)))).first()[0] if gaps else 0.0
        if (moved or 0.0) <= tolerance * facts["most"]:
            break
    long = now.select("INDEX", F.inline(F.array(*(F.struct(F.lit(s).alias("Sample"), F.col(c).alias("_f")) for s, c in safe.items()))))
    return _done(cells.join(long, ["INDEX", "Sample"], "left"), F.col("_f"), cells.columns)


def correlated_samples(cells: DataFrame, k: int) -> dict[str, list[str]]:
    """For each sample the k others with the largest absolute correlation over shared features, ties by name: as many rows as samples times k."""
    p = with_other_side(sample_products(cells))
    spread = lambda x, xx: F.col(xx) - F.col(x) * F.col(x) / F.col("n")
    both = spread("x", "xx") * spread("y", "yy")
    r = F.abs((F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / F.sqrt(F.when(both > 0, both)))
    ranked = p.filter("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst"), (1 - F.coalesce(r, F.lit(0.0))).alias("dist"))
    out: dict[str, list[str]] = {}
    for row in nearest(ranked, k).orderBy("src", "rank").collect():
        out.setdefault(row["src"], []).append(row["dst"])
    return out


def covariate_imputed(covariate: DataFrame, imputer: Callable[[DataFrame], DataFrame], parents: DataFrame, key: str = "PARENT_PROTEIN") -> DataFrame:
    """INDEX, Sample, c, raw_covariate: impute one row for each parent, give it to the parent's features, and subtract each feature's median.

    ``raw_covariate`` is the value before imputation."""
    own = covariate.select(F.col(key).alias("INDEX"), "Sample", F.col("covariate").alias("v"))
    filled = imputer(own).select(F.col("INDEX").alias(key), "Sample", F.col("v").alias("c"), F.when(~F.col("imputed"), F.col("v")).alias("raw_covariate"))
    filled = stored(filled, "covariate")  # Spark sees its size: few parents are broadcast
    # a feature's parents stand together by INDEX before they are fanned out: the window moves no cell
    of = parents.groupBy("INDEX").agg(F.collect_set(key).alias("_of")).select("INDEX", F.explode("_of").alias(key))
    fanned = of.join(filled, key)
    return fanned.withColumn("c", F.col("c") - F.median("c").over(Window.partitionBy("INDEX")))


#: Name -> function of (cells, samples).
IMPUTERS: dict[str, Callable[..., DataFrame]] = {
    "mean": lambda cells, samples, **p: row_mean(cells), "median": lambda cells, samples, **p: row_median(cells),
    "lc_conmed": condition_median, "knn": lambda cells, samples, **p: knn_features(cells, **p), "nsknn": lambda cells, samples, **p: knn_samples(cells, **p),
    "tnknn": lambda cells, samples, **p: knn_correlated(cells, **p), "rf": lambda cells, samples, **p: boosted(cells, **p), "randomforest": lambda cells, samples, **p: boosted(cells, **p),
    "mindet": lambda cells, samples, **p: min_det(cells, **p), "minprob": lambda cells, samples, **p: min_prob(cells, **p), "colmean": lambda cells, samples, **p: column_mean(cells),
}


def impute(cells: DataFrame, samples: DataFrame, method: str | None = None, **params) -> DataFrame:
    if method is None:
        return cells.withColumn("imputed", F.lit(False))
    if method not in IMPUTERS:
        raise ValueError(f"unknown imputation {method!r}; one of {', '.join(IMPUTERS)}")
    return IMPUTERS[method](cells, samples, **params)
