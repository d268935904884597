"""Differential statistics: group means, contrasts, empirical-Bayes moderation, false discovery rates, covariate adjustment."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quantspark.functions.numeric import digamma, inverse_trigamma, t_pvalue, trigamma
from quantspark.operators.quantiles import quantiles
from quantspark.sources.scratch import read_file, stored


def contrast_pairs(levels: list[str], only_contrasts: list[str] | None = None, only_against: str | None = None) -> list[tuple[str, str, str]]:
    """(name, A, B): named contrasts (A_vs_B or A_v_B), else all against one level, else all pairs in order."""
    levels = sorted(levels)
    if only_contrasts:
        out = []
        for name in only_contrasts:
            a, _, b = name.partition("_vs_") if "_vs_" in name else name.partition("_v_")
            if a not in levels or b not in levels:
                raise ValueError(f"contrast {name!r} names no two of {', '.join(levels)}")
            out.append((f"{a}_vs_{b}", a, b))
        return out
    if only_against:
        if only_against not in levels:
            raise ValueError(f"{only_against!r} is none of {', '.join(levels)}")
        return [(f"{a}_vs_{only_against}", a, only_against) for a in levels if a != only_against]
    return [(f"{a}_vs_{b}", a, b) for a, b in combinations(levels, 2)]


def contrast_table(samples: DataFrame) -> DataFrame:
    """contrast, A, B for all pairs of conditions."""
    c = samples.select("CONDITION").distinct()
    return c.select(F.col("CONDITION").alias("A")).join(c.select(F.col("CONDITION").alias("B")), F.col("A") < F.col("B")).select(F.concat("A", F.lit("_vs_"), "B").alias("contrast"), "A", "B")


def group_fit(cells: DataFrame, samples: DataFrame, value: str = "v") -> tuple[DataFrame, DataFrame]:
    """(INDEX, CONDITION, mean, n) and (INDEX, s2, df): one-way group means and the pooled residual variance."""
    at = cells.filter(F.col(value).isNotNull()).join(F.broadcast(samples.select("Sample", "CONDITION")), "Sample")  # a row a sample
    groups = at.groupBy("INDEX", "CONDITION").agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("var"))
    df = F.sum(F.col("n") - 1)
    pooled = groups.groupBy("INDEX").agg((F.sum((F.col("n") - 1) * F.col("var")) / F.when(df > 0, df)).alias("s2"), df.alias("df"))
    return groups, pooled


def sides(groups: DataFrame, contrasts: DataFrame, key: tuple[str, ...], values: tuple[str, ...]) -> DataFrame:
    """``key``, contrast, A, B, and each of ``values`` as <value>_a and <value>_b, where a group has both conditions.

    A key's groups meet in one row, as many as conditions, so that no contrast is joined with another.
    """
    held = groups.filter(F.col("CONDITION").isNotNull()).groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("CONDITION", F.struct(*values)))).alias("_of"))
    # one row for each pair of conditions
    both = held.join(F.broadcast(contrasts), how="cross").withColumns({"_a": F.try_element_at("_of", F.col("A")), "_b": F.try_element_at("_of", F.col("B"))}).filter("_a IS NOT NULL AND _b IS NOT NULL")
    return both.select(*key, "contrast", "A", "B", *(F.col(f"_{s}")[v].alias(f"{v}_{s}") for s in "ab" for v in values))


def contrasts_of(groups: DataFrame, pooled: DataFrame, contrasts: DataFrame, key: tuple[str, ...] = ("INDEX",), carry: tuple[str, ...] = ()) -> DataFrame:
    """``key``, contrast, A, B, log2fc, s2, df, factor, se, t, p from groups (``key``, CONDITION, mean, n) and their pooled variance; ``carry``: further values of both sides."""
    both = sides(groups, contrasts, key, ("mean", "n", *carry)).join(pooled, [*key])
    out = both.select(*key, "contrast", "A", "B", (F.col("mean_a") - F.col("mean_b")).alias("log2fc"), "s2", "df", F.sqrt(1 / F.col("n_a") + 1 / F.col("n_b")).alias("factor"), *(f"{c}_{s}" for c in carry for s in "ab"))
    se = F.sqrt("s2") * F.col("factor")
    out = out.withColumn("se", F.when((se > 0) & (F.col("df") > 0), se)).withColumn("t", F.col("log2fc") / F.col("se"))
    return out.withColumn("p", t_pvalue(F.col("t"), F.col("df").cast("double")))


def contrast_stats(cells: DataFrame, samples: DataFrame, contrasts: DataFrame, value: str = "v") -> DataFrame:
    """INDEX, contrast, log2fc, s2, df, se, t, p from group means; null se, t and p without degrees of freedom or variance."""
    return contrasts_of(*group_fit(cells, samples, value), contrasts).drop("A", "B")


def priors(pooled: DataFrame, by: list[str]) -> list[Row]:
    """``by``, d0, s0: prior degrees of freedom and variance of each kind of fit, from the distribution of its log s2
    (Smyth 2004); infinite where that isn't wider than chance.

    One aggregation over all features gives a row for each kind and number of degrees of freedom; variances are floored at 1e-5 times their median.
    """
    ok = pooled.filter("df > 0 AND s2 IS NOT NULL")
    floor = quantiles(ok, by, "s2", _floor=0.5)
    at = (ok.join(F.broadcast(floor), by) if by else ok.join(F.broadcast(floor), how="cross")).withColumn("_log", F.ln(F.greatest("s2", F.col("_floor") * 1e-5)))  # a row a kind
    sums = at.groupBy(*by, "df").agg(F.count(F.lit(1)).alias("n"), F.sum("_log").alias("e"), F.sum(F.col("_log") * F.col("_log")).alias("ee")).collect()
    out = []
    for kind in sorted({tuple(r[c] for c in by) for r in sums}):
        kinds = [r for r in sums if tuple(r[c] for c in by) == kind]
        n = sum(r["n"] for r in kinds)
        shift = {r["df"]: math.log(r["df"] / 2) - digamma(r["df"] / 2) for r in kinds}
        mean = sum(r["e"] + r["n"] * shift[r["df"]] for r in kinds) / n
        squares = sum(r["ee"] + 2 * r["e"] * shift[r["df"]] + r["n"] * shift[r["df"]] ** 2 for r in kinds)
        var = (squares - n * mean**2) / max(n - 1, 1) - sum(r["n"] * trigamma(r["df"] / 2) for r in kinds) / n
        d0 = 2 * inverse_trigamma(var) if var > 0 else math.inf
        s0 = math.exp(mean + digamma(d0 / 2) - math.log(d0 / 2)) if var > 0 else math.exp(mean)
        out.append(Row(**dict(zip(by, kind, strict=True)), d0=d0, s0=s0))
    return out


def moderation(pooled: DataFrame) -> tuple[float, float]:
    """``priors`` of one kind of fit; (infinite, 1) without any."""
    return next(((r["d0"], r["s0"]) for r in priors(pooled, [])), (math.inf, 1.0))


def moderated(stats: DataFrame, d0: float | Column, s0: float | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Add s2_post, se_mod, t_mod and p_mod. Total degrees of freedom are at most those of all features (of a kind) together."""
    d0, s0 = (x if isinstance(x, Column) else F.lit(x) for x in (d0, s0))
    together = stats.select("INDEX", *by, "df").distinct().groupBy(*by).agg(F.sum("df").alias("_all"))
    at = stats.join(F.broadcast(together), list(by)) if by else stats.join(F.broadcast(together), how="cross")  # a row a kind
    post = F.when(d0 == float("inf"), s0).otherwise((d0 * s0 + F.col("df") * F.col("s2")) / (d0 + F.col("df")))
    se = F.sqrt("s2_post") * F.col("factor")
    out = at.withColumn("s2_post", post).withColumn("se_mod", F.when(se > 0, se)).withColumn("t_mod", F.col("log2fc") / F.col("se_mod")).withColumn("df_total", F.least(d0 + F.col("df"), F.col("_all")).cast("double"))
    return out.withColumn("p_mod", t_pvalue(F.col("t_mod"), F.col("df_total"))).drop("_all")


def _joined(a: DataFrame, b: DataFrame, on: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Join where the columns ``on`` are equal, null with null."""
    b = b.withColumnsRenamed({c: f"_on_{c}" for c in on})
    return a.join(b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on], how).drop(*[f"_on_{c}" for c in on])


def bh(stats: DataFrame, p: str | tuple[str, ...] = "p", out: str | tuple[str, ...] = "q", by: tuple[str, ...] = ("contrast",), bins: int = 1000, most: int = 1_000_000, bin_most: int = 1_000_000) -> DataFrame:
    """Benjamini-Hochberg q-values for each contrast; null p has null q and doesn't count, ties share one q.

    Several columns of p-values are corrected each for itself, into the columns ``out``. Contrasts of at most ``most`` rows take a
    window each. Where one is larger, rows are sorted within bins of the logarithm of p, ``bins`` to each factor of e, so that
    no window grows with the features of a contrast: counts of smaller bins give ranks, minima of larger bins the running
    minimum, and the rows move once. p-values of 0 and 1 are their own q-values and need no window; a bin of more than
    ``bin_most`` rows is sorted by its distinct values.
    """
    pairs = [(p, out)] if isinstance(p, str) else list(zip(p, out, strict=True))
    known = stored(stats, "p-values")  # read several times
    done = known
    if (known.groupBy(*by).count().agg(F.max("count")).first()[0] or 0) <= most:
        for p, out in pairs:
            ok = F.col(p).isNotNull()
            of = Window.partitionBy(*by, ok)
            done = done.withColumn("_share", F.when(ok, F.col(p) / F.cume_dist().over(of.orderBy(p))))
            done = done.withColumn(out, F.when(ok, F.least(F.lit(1.0), F.min("_share").over(of.orderBy(F.desc(p)))))).drop("_share")
        return done
    for p, out in pairs:
        done = _binned_bh(done, p, out, by, bins, bin_most)
    return done


def _binned_bh(known: DataFrame, p: str, out: str, by: tuple[str, ...], bins: int, bin_most: int) -> DataFrame:
    x = F.col(p)
    inside = (x > 0) & (x < 1)
    # 0 is below all bins, 1 is the last one
    at = known.withColumn("_bin", F.when(x <= 0, F.lit(-(1 << 40))).otherwise(F.floor(F.ln(F.greatest(x, F.lit(1e-300))) * bins)))
    sizes = at.filter(x.isNotNull()).groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_size"))  # rows by bins, not by features
    sizes = sizes.withColumns({"_below": F.sum("_size").over(Window.partitionBy(*by).orderBy("_bin")) - F.col("_size"), "_all": F.sum("_size").over(Window.partitionBy(*by))})
    sizes = stored(sizes, "p-bins")
    large = F.col("_size") > bin_most
    held = _joined(at.filter(inside), sizes, (*by, "_bin"))

    def lowest(rows: DataFrame, n: Column) -> DataFrame:
        """Add ``_own``: the least share at this p or a larger one of the bin."""
        of = Window.partitionBy(*by, "_bin")
        rows = rows.withColumn("_share", x * F.col("_all") / (F.col("_below") + F.sum(n).over(of.orderBy(p))))
        return rows.withColumn("_own", F.min("_share").over(of.orderBy(F.desc(p)))).drop("_share", "_size", "_below", "_all")

    marked = lowest(held.filter(~large), F.lit(1))
    if not sizes.filter(large & (F.col("_bin") < 0) & (F.col("_bin") > -(1 << 40))).isEmpty():
        ties = lowest(held.filter(large).groupBy(*by, "_bin", p, "_below", "_all").agg(F.count(F.lit(1)).alias("_n")), F.col("_n")).drop("_n")
        many = held.filter(large).drop("_size", "_below", "_all")
        marked = marked.unionByName(_joined(many, ties.drop("_bin"), (*by, p)).select(*marked.columns))
    marked = stored(marked, "p-shares")
    lows = marked.groupBy(*by, "_bin").agg(F.min("_own").alias("_low"))
    above = Window.partitionBy(*by).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    lows = stored(lows.withColumn("_later", F.min("_low").over(above)).drop("_low"), "p-lows")
    found = _joined(marked, lows, (*by, "_bin")).withColumn(out, F.least(F.lit(1.0), "_own", "_later")).select(*known.columns, out)
    ends = known.filter(x.isNull() | ~inside).withColumn(out, F.when(x <= 0, 0.0).when(x >= 1, 1.0))
    return found.unionByName(ends)


#: p-values that stand sorted in one file.
PART = 500_000


def bh_values(values: DataFrame, codes: int, rows: int) -> DataFrame:
    """key, q: Benjamini-Hochberg q-values of p-values between 0 and 1 (key, p) for each code, the remainder of the key by ``codes``.

    p-values of 0 and 1 count, but are their own q-values and have no row. The others move once, as a number and a p, into
    files sorted by code and p; of each file and code the driver has the count and the least share, from which every
    file's ranks and running minimum follow, so that q-values are found where the p-values lie. ``rows``: how many there are at most.
    """
    spark = values.sparkSession
    code = F.col("key") % codes
    values = values.filter("p IS NOT NULL")
    inside = (F.col("p") > 0) & (F.col("p") < 1)
    ends = {r["code"]: (r["low"], r["high"]) for r in values.filter(~inside).groupBy(code.alias("code")).agg(F.count_if(F.col("p") <= 0).alias("low"), F.count_if(F.col("p") >= 1).alias("high")).collect()}  # a row a code
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART))
    placed = stored(values.filter(inside).select("key", "p").repartitionByRange(width, code, "p").sortWithinPartitions(code, "p"), "p-values")
    sizes = placed.groupBy(F.input_file_name().alias("file"), code.alias("code")).agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("least")).collect()  # a row a file and code or so
    sizes.sort(key=lambda r: (r["code"], r["least"]))
    upto: dict[int, int] = {}
    before: dict[str, dict[int, int]] = {}
    for r in sizes:
        before.setdefault(r["file"], {})[r["code"]] = start = upto.get(r["code"], ends.get(r["code"], (0, 0))[0])
        upto[r["code"]] = start + r["n"]
    total = {c: n + ends.get(c, (0, 0))[1] for c, n in upto.items()}
    files = sorted(before)

    def shares(file: str) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(code, keys, least share at this p or a larger one of the file) of each code."""
        table = read_file(file)
        key, p = table["key"].to_numpy(), table["p"].to_numpy()
        starts = np.flatnonzero(np.diff(key % codes, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(key)]):
            c = int(key[a] % codes)
            share = p[a:b] * total[c] / (before[file][c] + np.searchsorted(p[a:b], p[a:b], "right"))
            yield c, key[a:b], np.minimum.accumulate(share[::-1])[::-1]

    def lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                for c, _, share in shares(files[i]):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([c], pa.int64()), pa.array([share[0]])], names=["id", "code", "low"])

    each = spark.range(0, len(files), 1, max(1, len(files)))
    low = {(files[r["id"]], r["code"]): r["low"] for r in each.mapInArrow(lows, "id long, code long, low double").collect()}  # the same rows
    later: dict[tuple[str, int], float] = {}
    least: dict[int, float] = {}
    for r in reversed(sizes):
        later[r["file"], r["code"]] = least.get(r["code"], 1.0)
        least[r["code"]] = min(least.get(r["code"], 1.0), low[r["file"], r["code"]])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                for c, key, share in shares(files[i]):
                    for a in range(0, len(key), 10_000):
                        yield pa.RecordBatch.from_arrays([pa.array(key[a : a + 10_000]), pa.array(np.minimum(share[a : a + 10_000], later[files[i], c]))], names=["key", "q"])

    return each.mapInArrow(found, "key long, q double")


def missing_mask(observed: DataFrame, contrasts: DataFrame) -> DataFrame:
    """INDEX, contrast, n_a, n_b, masked (no value before imputation on either side). ``observed``: INDEX, CONDITION, n_observed."""
    both = sides(observed, contrasts, ("INDEX",), ("n_observed",)).withColumnsRenamed({"n_observed_a": "n_a", "n_observed_b": "n_b"})
    return both.select("INDEX", "contrast", "n_a", "n_b", ((F.col("n_a") == 0) & (F.col("n_b") == 0)).alias("masked"))


def neutralized(stats: DataFrame, mask: DataFrame, p: tuple[str, ...] = ("p",), t: tuple[str, ...] = ("t",)) -> DataFrame:
    """Masked p-values are 1 before the correction; afterwards masked rows say nothing: fold change and t 0, p and q 1, infinite SE."""
    at = stats.join(mask.select("INDEX", "contrast", "masked"), ["INDEX", "contrast"], "left").withColumn("masked", F.coalesce("masked", F.lit(False)))
    at = at.withColumns({x: F.when(F.col("masked"), 1.0).otherwise(F.col(x)) for x in p})
    at = bh(at, p, tuple("q" + x[1:] for x in p))
    zero = {x: F.when(F.col("masked"), 0.0).otherwise(F.col(x)) for x in ("log2fc", *t)}
    return at.withColumns({**zero, "se": F.when(F.col("masked"), float("inf")).otherwise(F.col("se"))})


def is_pilot(samples: DataFrame) -> bool:
    """Whether any condition has one replicate or there is one condition only: fold changes alone make sense then."""
    sizes = [r["count"] for r in samples.groupBy("CONDITION").count().collect()]
    return len(sizes) < 2 or min(sizes) < 2


def differential(cells: DataFrame, samples: DataFrame, contrasts: DataFrame, observed: DataFrame | None = None, value: str = "v") -> DataFrame:
    """Statistics of every feature and contrast, moderated, corrected and masked; fold changes alone in a pilot."""
    groups, pooled = group_fit(cells, samples, value)
    pooled = pooled.persist()  # read for the prior and for every contrast
    stats = contrasts_of(groups, pooled, contrasts).drop("A", "B")
    if is_pilot(samples):
        return stats.select("INDEX", "contrast", "log2fc")
    stats = moderated(stats, *moderation(pooled))
    mask = missing_mask(observed, contrasts) if observed is not None else stats.select("INDEX", "contrast", F.lit(False).alias("masked"))
    return neutralized(stats, mask, ("p", "p_mod"), ("t", "t_mod"))


def tested(fc: DataFrame) -> DataFrame:
    """From INDEX, contrast, log2fc, se, df: t, p and q; null where se or degrees of freedom aren't positive."""
    t = F.when((F.col("se") > 0) & (F.col("df") > 0), F.col("log2fc") / F.col("se"))
    return bh(fc.withColumn("t", t).withColumn("p", t_pvalue(F.col("t"), F.col("df").cast("double"))))


def top_hits(stats: DataFrame, mask: DataFrame, n: int = 10, q: str = "q", below: float = 0.05, missing_rule: str = "any") -> DataFrame:
    """The n smallest q-values below a limit for each contrast and direction; features without values on one (any) or both (all) sides don't count."""
    if missing_rule not in ("any", "all"):
        raise ValueError("missing_rule is any or all")
    empty = (F.col("n_a") == 0) | (F.col("n_b") == 0) if missing_rule == "any" else (F.col("n_a") == 0) & (F.col("n_b") == 0)
    ok = stats.filter(F.col(q) < below).join(mask.filter(~empty).select("INDEX", "contrast"), ["INDEX", "contrast"], "left_semi")
    way = ok.withColumn("direction", F.when(F.col("log2fc") > 0, "up").otherwise("down"))
    rank = F.row_number().over(Window.partitionBy("contrast", "direction").orderBy(q, "INDEX"))
    return way.withColumn("rank", rank).filter(F.col("rank") <= n)

