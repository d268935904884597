"""Samples x samples matrices from partial products: no join of a feature with itself, no pair of cells as a row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_names(cells: DataFrame) -> list[str]:
    """The samples of an experiment, in order."""
    return sorted(r[0] for r in cells.select("Sample").distinct().collect())


def feature_vectors(cells: DataFrame, names: list[str], value: str = "v") -> DataFrame:
    """INDEX and x: a feature's values over ``names`` in order, null where it has none. One shuffle of the cells."""
    place = cells.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "Sample string, _i int")
    # a row a sample
    held = cells.join(F.broadcast(place), "Sample").groupBy("INDEX").agg(F.map_from_entries(F.collect_list(F.struct("_i", F.col(value).cast("double").alias("_v")))).alias("_m"))
    return held.select("INDEX", F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.try_element_at("_m", i)).alias("x"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, nulls as NaN."""
    return np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), float).reshape(-1, width)


def sample_products(cells: DataFrame, value: str = "v", centre: bool = False, scale: bool = False) -> DataFrame:
    """a, b, n, x, xx, xy: for each two samples (and each with itself) over the features that both have: how many, and
    the sums of a's values, of their squares, and of products with b's. The other side's sums are the row (b, a).

    Each task multiplies the features of its partition as matrices and sends the sums once, samples squared rows
    whatever its features; Spark adds them up. ``centre`` takes each feature's mean off first, which leaves
    differences between samples as they are and keeps them exact; ``scale`` then divides by its standard deviation (by 1
    where its values are equal). Pairs that share no feature have no row.
    """
    names = sample_names(cells)
    s = len(names)
    if not s:
        return cells.sparkSession.createDataFrame([], "a string, b string, n long, x double, xx double, xy double")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, s, s))
        for batch in batches:
            rows = matrix(batch.column("x"), s)
            known = (~np.isnan(rows)).astype(float)
            held = np.maximum(known.sum(1), 1)
            if centre or scale:
                equal = np.fmax.reduce(rows, 1) == np.fmin.reduce(rows, 1)
                rows = rows - (np.nansum(rows, 1) / held)[:, None]
            if scale:
                rows = rows / np.where(equal, 1.0, np.sqrt(np.nansum(rows * rows, 1) / held))[:, None]
            rows = np.nan_to_num(rows)
            total += [known.T @ known, rows.T @ known, (rows * rows).T @ known, rows.T @ rows]
        a, b = np.nonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total[0][a, b], pa.int64()), *(pa.array(t[a, b]) for t in total[1:])], names=["a", "b", "n", "x", "xx", "xy"])

    parts = feature_vectors(cells, names, value).select("x").mapInArrow(multiply, "a int, b int, n long, x double, xx double, xy double")
    summed = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "x", "xx", "xy")])
    label = F.array(*[F.lit(n) for n in names])
    return summed.select(F.get(label, F.col("a")).alias("a"), F.get(label, F.col("b")).alias("b"), "n", "x", "xx", "xy")


def with_other_side(products: DataFrame) -> DataFrame:
    """Add y and yy: the sums of b's values and squares."""
    other = products.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("x").alias("y"), F.col("xx").alias("yy"))
    return products.join(other, ["a", "b"])


def squared_distance(products: DataFrame) -> DataFrame:
    """a, b, n, d2: summed squared differences over shared features."""
    d2 = F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.greatest(F.lit(0.0), F.col("xx") + F.col("yy") - 2 * F.col("xy")))
    return with_other_side(products).select("a", "b", "n", d2.alias("d2"))
