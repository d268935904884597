"""Operator 9: quality rules, and an isolation forest over their statistics with a threshold from labelled rows."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import col, slices, small_batches, staged

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
#: Words in a window whose repetition counts.
WINDOW = 5
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["symbols", "bars", "echo", "word_length", "distinct"]


def n_repeated(words: list, window: int = WINDOW) -> int:
    """Words that stand in a window found twice or more in the text, its first place included."""
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    often = {g for g, n in Counter(grams).items() if n > 1}
    total, upto = 0, 0
    for i, g in enumerate(grams):
        if g in often:
            total += i + window - max(i, upto)
            upto = i + window
    return total


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """STATS and FEATURES of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # on bytes: at the six ASCII blanks alone
    n, chars = len(words), len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    dup = len(lines) - len(set(lines))
    repeats = n_repeated(words)
    per_word = 1 / max(n, 1)
    echo = sum(map(eq, words, words[1:]))
    features = [symbols * per_word, text.count("|") * per_word, echo * per_word, chars * per_word, (len(set(words)) * per_word) ** 0.5]
    return [n, chars, symbols, dup, repeats], features


def base_failed(stats: list[int]) -> bool:
    n, repeats = stats[0], stats[4]
    return n < 10 or 100 * repeats > 20 * n


def _depth(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Random trees as arrays: feature (-1 at a leaf), split, children, and the path length at each leaf."""

    trees: tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], ...]
    points: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / that of as many random points): near 1 for rows that random splits isolate soon."""
        total = np.zeros(len(x))
        for feature, split, left, right, length in self.trees:
            at = np.zeros(len(x), np.int32)
            while (inner := np.flatnonzero(feature[at] >= 0)).size:
                node = at[inner]
                at[inner] = np.where(x[inner, feature[node]] < split[node], left[node], right[node])
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / max(_depth(self.points), 1e-9)) if self.trees else np.zeros(len(x))


def grow(x: np.ndarray, trees: int, points: int, seed: int) -> Forest:
    """Each tree splits its own random ``points`` rows at random values of random features."""
    rng = np.random.default_rng(seed)
    points = min(points, len(x))
    limit = math.ceil(math.log2(max(points, 2))) + 2
    grown = []
    for _ in range(trees if points > 1 else 0):
        nodes: list[list[float]] = []

        def add(rows: np.ndarray, depth: int, nodes=nodes) -> int:
            me = len(nodes)
            nodes.append([-1, 0.0, 0, 0, depth + _depth(len(rows))])
            low, high = rows.min(0), rows.max(0)
            free = np.flatnonzero(high > low)
            if depth < limit and len(rows) > 1 and len(free):
                f = int(rng.choice(free))
                s = float(rng.uniform(low[f], high[f]))
                under = rows[:, f] < s
                if under.any() and not under.all():
                    nodes[me][:2] = [f, s]
                    nodes[me][2] = add(rows[under], depth + 1)
                    nodes[me][3] = add(rows[~under], depth + 1)
            return me

        add(x[rng.choice(len(x), points, replace=False)], 0)
        f, s, a, b, d = zip(*nodes, strict=True)
        grown.append((np.array(f, np.int32), np.array(s), np.array(a, np.int32), np.array(b, np.int32), np.array(d)))
    return Forest(tuple(grown), points)


@dataclass(frozen=True)
class QualityModel:
    forest: Forest
    center: np.ndarray
    scale: np.ndarray
    threshold: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.forest.scores((features - self.center) / self.scale)

    def filter(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The rows of ``docs`` that are kept, all columns as they were."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chain.from_iterable(map(slices, batches)):
                found = [statistics(t) for t in batch.column(text_col).to_pylist()]
                ok = self.scores(np.array([f for _, f in found]).reshape(-1, len(FEATURES))) <= self.threshold
                ok &= ~np.array([base_failed(s) for s, _ in found], bool)
                yield batch.filter(pa.array(ok))

        return docs.mapInArrow(run, docs.schema)


def with_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, STATS, base_failed and features of every whole text."""
    small_batches(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            found = [statistics(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([s[i] for s, _ in found], pa.int64()) for i in range(len(STATS))]
            failed = pa.array([base_failed(s) for s, _ in found], pa.bool_())
            features = pa.array([f for _, f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns, failed, features], names=["id", *STATS, "base_failed", "features"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'{s} long' for s in STATS)}, base_failed boolean, features array<double>")


def _labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One label for each id: the lowest, if several."""
    return labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label")).dropna().groupBy("id").agg(F.min("label").alias("label"))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", trees: int = 128, points: int = 256, fit_rows: int = 8192, spoiled: float = 0.01, lose: float = 0.002, seed: int = 9) -> QualityModel:
    """Grow the forest and find its threshold.

    The forest is fitted on a bounded sample: at most ``fit_rows`` rows labelled good (those with the smallest hashed
    ids) and at most ``fit_rows * spoiled`` labelled bad, so that random splits reach beyond what is good.
    The threshold covers all labelled rows: their scores are counted by label in 2,000 steps, and the lowest threshold
    is taken that loses at most the share ``lose`` of the rows labelled good. Rows that fail the base rules take no
    part. Without labels of both kinds nothing is anomalous.
    """
    known = stats.filter(~F.col("base_failed")).join(_labels(labels, id_col, label_col), "id")
    known = staged(known.select("id", "label", "features"), "labelled-statistics")
    order = [F.xxhash64("id"), F.col("id")]
    good = known.filter("label > 0").orderBy(*order).limit(fit_rows).select("features").toPandas()["features"]
    bad = known.filter("label <= 0").orderBy(*order).limit(max(1, int(len(good) * spoiled))).select("features").toPandas()["features"]
    x = np.array([*good, *bad]).reshape(-1, len(FEATURES))
    if not len(good) or not len(bad):
        return QualityModel(Forest((), 0), np.zeros(len(FEATURES)), np.ones(len(FEATURES)), 1.0)
    center, scale = np.median(x, 0), np.maximum(x.std(0), 1e-6)
    model = QualityModel(grow((x - center) / scale, trees, points, seed), center, scale, 1.0)
    steps = 2000
    counted = score(known, model).groupBy((F.col("label") > 0).alias("good"), F.ceil(F.col("score") * steps).alias("step")).count().collect()
    goods = np.zeros(steps + 2)
    for r in counted:
        if r["good"]:
            goods[r["step"]] += r["count"]
    above = goods[::-1].cumsum()[::-1]  # rows labelled good that score above step - 1
    step = int(np.flatnonzero(np.append(above[1:], 0) <= lose * max(goods.sum(), 1))[0])
    return QualityModel(model.forest, center, scale, step / steps)


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """Add the forest's score of ``features``."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stats.schema)}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pc.list_flatten(batch.column("features")).to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(x))], names=[*batch.schema.names, "score"])

    return stats.mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """STATS, base_failed, score and kept of every document; ``id_col`` names the id of both tables.

    Null or empty text: no words, so the base rules fail. Null ids are judged but have no label; repeated ids and rows
    are judged each; one id with several labels has the lowest. Very long texts: whole, one at a time. A score equal to
    the threshold is kept. Empty tables: no rows, or no verdict but the base
    rules'. Other columns are not read.
    """
    stats = staged(with_statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, labels, id_col, label_col)
    out = score(stats, model).withColumn("kept", ~F.col("base_failed") & (F.col("score") <= model.threshold))
    return out.select(F.col("id").alias(id_col), *STATS, "base_failed", "score", "kept")


def op9_isolation_rules(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, with the threshold from the labelled ones."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
