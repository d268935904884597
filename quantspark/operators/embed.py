"""Sample embeddings, distances and clusters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.operators.impute import nearest
from quantspark.operators.products import sample_products, squared_distance, with_other_side


def top_variance(cells: DataFrame, n: int, value: str = "v") -> DataFrame:
    """INDEX of the n features with the largest population variance, ties by INDEX."""
    return cells.groupBy("INDEX").agg(F.var_pop(value).alias("variance")).filter("variance IS NOT NULL").orderBy(F.desc("variance"), "INDEX").limit(n)


def random_features(cells: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n features by hash, the same whatever the partitions."""
    return cells.select("INDEX").distinct().orderBy(F.xxhash64("INDEX", F.lit(seed)), "INDEX").limit(n)


def feature_centred(cells: DataFrame, chosen: DataFrame | None = None, value: str = "v") -> DataFrame:
    """Add the value less the feature's mean; null for features that aren't chosen."""
    out = cells.withColumn("centred", F.col(value) - F.avg(value).over(Window.partitionBy("INDEX")))
    if chosen is None:
        return out
    return out.join(chosen.select("INDEX", F.lit(True).alias("_in")), "INDEX", "left").withColumn("centred", F.when(F.col("_in"), F.col("centred"))).drop("_in")


def gram(cells: DataFrame, value: str = "centred") -> DataFrame:
    """a, b, dot: inner products of samples over features, summed in Spark."""
    return sample_products(cells, value).select("a", "b", F.col("xy").alias("dot"))


def pca(cells: DataFrame, n_pcs: int | None = None, value: str = "centred") -> tuple[DataFrame, list[float]]:
    """Scores (Sample, pc, score) and explained shares. Values must be centred by feature.

    The samples x samples Gram matrix is summed in Spark; its eigenvectors are found on the driver, as samples are few.
    A component's sign makes its largest score positive. Up to three samples have no embedding: no rows.
    """
    spark = cells.sparkSession
    rows = gram(cells, value).collect()  # samples squared
    names = sorted({r["a"] for r in rows})
    n = len(names)
    if n <= 3:
        return spark.createDataFrame([], "Sample string, pc int, score double"), []
    at = {s: i for i, s in enumerate(names)}
    g = np.zeros((n, n))
    for r in rows:
        g[at[r["a"]], at[r["b"]]] = r["dot"]
    middle = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(middle @ g @ middle)
    k = max(1, min(n_pcs or n - 1, n - 1))
    values, vectors = np.maximum(values[::-1][:k], 0), vectors[:, ::-1][:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    scores = vectors * signs * np.sqrt(values)
    out = spark.createDataFrame([(s, p + 1, float(scores[i, p])) for s, i in at.items() for p in range(k)], "Sample string, pc int, score double")
    total = max(float(np.trace(middle @ g @ middle)), 1e-300)
    return out, [float(v / total) for v in values]


def neighbours(scores: DataFrame, n_samples: int) -> DataFrame:
    """src, dst, dist: the kNN graph in component space, k = sqrt(N) between 10 and 30."""
    k = max(1, min(n_samples - 1, max(10, min(30, round(n_samples**0.5)))))
    cells = scores.select(F.col("pc").cast("string").alias("INDEX"), "Sample", F.col("score").alias("v"))
    return nearest(euclidean(cells).select(F.col("a").alias("src"), F.col("b").alias("dst"), "dist").filter("src <> dst"), k)


def euclidean(cells: DataFrame, value: str = "v") -> DataFrame:
    """a, b, dist over features that both samples have."""
    return squared_distance(sample_products(cells, value, centre=True)).select("a", "b", F.sqrt("d2").alias("dist"))


def correlation_distance(cells: DataFrame, value: str = "v") -> DataFrame:
    """a, b, dist: 1 - r, between 0 and 2, zero for a sample with itself; null where either has no spread."""
    p = with_other_side(sample_products(cells, value))
    spread = lambda x, xx: F.col(xx) - F.col(x) * F.col(x) / F.col("n")
    both = spread("x", "xx") * spread("y", "yy")
    r = (F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / F.sqrt(F.when(both > 0, both))
    return p.select("a", "b", F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.when(r.isNotNull(), F.least(F.lit(2.0), F.greatest(F.lit(0.0), 1 - r)))).alias("dist"))


def missing_distance(flags: DataFrame) -> DataFrame:
    """a, b, n_differ: features missing in one of two samples alone."""
    return squared_distance(sample_products(flags, "missing")).select("a", "b", F.round("d2").cast("long").alias("n_differ"))


def missing_patterns(flags: DataFrame) -> DataFrame:
    """pattern (0 and 1 over samples in order), n_features."""
    own = flags.groupBy("INDEX").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("Sample", "missing"))), lambda s: s["missing"].cast("string")), "").alias("pattern"))
    return own.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_features"))


def feature_clusters(cells: DataFrame, k: int = 8, value: str = "v", seed: int = 42) -> DataFrame:
    """INDEX, cluster by bisecting k-means over all samples; features with a gap take no part."""
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector

    n = cells.select("Sample").distinct().count()
    own = cells.filter(F.col(value).isNotNull()).groupBy("INDEX").agg(F.transform(F.array_sort(F.collect_list(F.struct("Sample", value))), lambda s: s[value]).alias("x")).filter(F.size("x") == n)
    vectors = own.select("INDEX", array_to_vector("x").alias("features")).orderBy("INDEX")
    return BisectingKMeans(k=k, seed=seed).fit(vectors).transform(vectors).select("INDEX", F.col("prediction").alias("cluster"))
