"""Exact quantiles of groups of any size: counts of value bins, refined until the bin of a wanted rank is small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.sources.scratch import stored

#: Values of a group, or of one bin of it, that one task may hold.
MOST = 1_000_000
#: Edges that cut a group in one pass.
EDGES = 64


def below(grid: Column, x: Column, most: int) -> Column:
    """How many numbers of a sorted array, at most ``most`` long, are less than x: halving steps, not a look at each."""
    steps = [1 << i for i in reversed(range(most.bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda n, s: F.when(F.get(grid, n + s - 1) < x, n + s).otherwise(n))


def quantile_table(df: DataFrame, by: list[str], value: str, shares: list[float], most: int = MOST) -> DataFrame:
    """``by``, k, q: the ``shares[k]`` quantile of each group's values, interpolated between neighbours.

    Groups of up to ``most`` values are aggregated as they are. A larger one is cut by quantiles of a sketch into
    bins: an edge's own value is a bin, and so is what lies between two edges. Bins are counted in every task, counts
    tell in which bin a wanted rank lies, and only the rows of such bins go on, where the rank is counted anew. A bin
    of up to ``most`` rows is sorted, a bin of equal values needs no further look; an edge is always a value of the
    group, so that every pass leaves less, whatever the distribution. Many ranks are followed at once.
    Nulls don't count, groups without values have no rows. The result is that of a sort, whatever ``most`` is.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.filter(F.col("_n") > most)
    probs = F.array(*[F.lit(float(s)) for s in shares])
    if large.isEmpty():
        found = rows.groupBy(*by).agg(F.percentile("_v", probs).alias("_q"))
        return found.filter(F.col("_q").isNotNull()).select(*by, F.posexplode("_q").alias("k", "q"))
    large = stored(large, "large-groups")
    small = (rows.join(F.broadcast(large.select(*by)), by, "left_anti") if by else rows.limit(0)).groupBy(*by).agg(F.percentile("_v", probs).alias("_q")).filter(F.col("_q").isNotNull())
    at = large.select(*by, "_n", F.posexplode(probs).alias("k", "_p")).withColumn("_at", F.col("_p") * (F.col("_n") - 1))
    wanted = at.select(*by, F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_rank")).distinct()
    values = _ranked(rows.join(F.broadcast(large.select(*by)), by, "left_semi") if by else rows, by, wanted.withColumn("_asked", F.col("_rank")), most)
    ends = at.select(*by, "k", F.floor("_at").alias("_lo"), F.ceil("_at").alias("_hi"), (F.col("_at") - F.floor("_at")).alias("_f"))
    low, high = (values.select(*by, F.col("_asked").alias(r), F.col("_value").alias(f"{r}_v")) for r in ("_lo", "_hi"))
    both = ends.join(low, [*by, "_lo"]).join(high, [*by, "_hi"])
    # the same form as Spark's percentile: exact where both ends are one value
    q = F.when(F.col("_lo_v") == F.col("_hi_v"), F.col("_lo_v")).otherwise((1 - F.col("_f")) * F.col("_lo_v") + F.col("_f") * F.col("_hi_v"))
    return small.select(*by, F.posexplode("_q").alias("k", "q")).unionByName(both.select(*by, "k", q.alias("q")))


def _ranked(rows: DataFrame, by: list[str], wanted: DataFrame, most: int) -> DataFrame:
    """``by``, _asked, _value: the value at each rank (from 0) of its group; every group here is larger than ``most``."""
    rows, wanted = rows.withColumn("_bin", F.lit(0).cast("long")), wanted.withColumn("_bin", F.lit(0).cast("long"))
    key, answers, level = [*by, "_bin"], [], 0
    while True:
        edges = rows.groupBy(*key).agg(F.array_sort(F.array_distinct(F.percentile_approx("_v", [i / EDGES for i in range(1, EDGES)], 100 * EDGES))).alias("_edges"))
        # one row for each bin that is cut: at level 0 a row a group; below, bins are many but none is large
        edges = F.broadcast(edges) if level == 0 else edges
        under = below(F.col("_edges"), F.col("_v"), EDGES)
        part = 2 * under + F.when(F.get("_edges", under) == F.col("_v"), 1).otherwise(0)
        cut = stored(rows.join(edges, key).select(*key, "_v", part.cast("long").alias("_part")), "quantile-bins")
        counts = cut.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_greatest"))
        upto = F.sum("_n").over(Window.partitionBy(*key).orderBy("_part"))  # at most 2 * EDGES rows
        counts = counts.withColumn("_below", upto - F.col("_n"))
        met = wanted.join(counts, key).filter((F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_n")))
        met = stored(met.select(*by, "_asked", (F.col("_bin") * (2 * EDGES + 1) + F.col("_part")).alias("_to"), "_bin", "_part", (F.col("_rank") - F.col("_below")).alias("_rank"), "_n", "_least", "_greatest"), "quantile-ranks")
        answers.append(met.filter("_least = _greatest").select(*by, "_asked", F.col("_least").alias("_value")))
        open_ = met.filter("_least < _greatest")
        fit = open_.filter(F.col("_n") <= most)
        inside = cut.join(fit.select(*key, "_part", "_to").distinct(), [*key, "_part"]).withColumn("_rank", F.row_number().over(Window.partitionBy(*by, "_to").orderBy("_v")) - 1)
        answers.append(fit.select(*by, "_to", "_rank", "_asked").join(inside.select(*by, "_to", "_rank", "_v"), [*by, "_to", "_rank"]).select(*by, "_asked", F.col("_v").alias("_value")))
        again = open_.filter(F.col("_n") > most)
        if again.isEmpty():
            break
        rows = cut.join(again.select(*key, "_part", "_to").distinct(), [*key, "_part"]).select(*by, F.col("_to").alias("_bin"), "_v")
        # bins get small numbers anew, so that paths of any depth fit
        names = stored(again.select(*by, "_to").distinct().withColumn("_new", F.monotonically_increasing_id()), "quantile-names")
        rows = rows.join(names.withColumnRenamed("_to", "_bin"), [*by, "_bin"]).select(*by, F.col("_new").alias("_bin"), "_v")
        wanted = again.join(names, [*by, "_to"]).select(*by, F.col("_new").alias("_bin"), "_rank", "_asked")
        level += 1
    out = answers[0]
    for more in answers[1:]:
        out = out.unionByName(more)
    return out


def quantiles(df: DataFrame, by: list[str], value: str, most: int = MOST, **shares: float) -> DataFrame:
    """One row a group with a column for each named share; null without values only where there is no group at all (``by`` empty)."""
    names = list(shares)
    long = quantile_table(df, by, value, [shares[n] for n in names], most)
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("k") == i, F.col("q"))).alias(n) for i, n in enumerate(names)])
