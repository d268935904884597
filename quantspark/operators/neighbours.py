"""Nearest features of features with gaps: each block of features reads the others' files, and leaves out those that bounds allow it to."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.operators.products import feature_vectors, matrix, sample_names
from quantspark.sources.scratch import read_file, stored


@dataclass(frozen=True)
class Measure:
    """A distance with what bounds it between two blocks of vectors."""

    #: distances of all rows of one matrix to all of another
    distances: Callable[[np.ndarray, np.ndarray], np.ndarray]
    #: an order in which near features stand together, from the column x
    key: Callable[[Column], Column]
    #: two vectors that describe a block
    outline: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    #: no distance between a block of this outline and blocks of those (a row each) is less
    least: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def nan_euclidean(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Over coordinates that both have, scaled up to all of them."""
    a, b = ~np.isnan(x), ~np.isnan(y)
    x0, y0 = np.where(a, x, 0), np.where(b, y, 0)
    both = a.astype(float) @ b.T.astype(float)
    sq = (x0**2) @ b.T - 2 * x0 @ y0.T + a @ (y0**2).T
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(both > 0, np.sqrt(np.maximum(sq, 0) * x.shape[1] / both), np.inf)


def _box(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each sample; (inf, -inf) where no feature has one."""
    none = np.isnan(x)
    return np.where(none, np.inf, x).min(0), np.where(none, -np.inf, x).max(0)


def _box_gap(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """A mean of squared differences is at least the least of them, so root of samples times the least gap of both boxes
    among samples that both have."""
    both = (low <= high) & (lows <= highs)
    gaps = np.where(both, np.maximum(0, np.maximum(np.where(both, lows - high, 0), np.where(both, low - highs, 0))), np.inf)
    return np.sqrt(len(low)) * gaps.min(1) * (1 - 1e-9)


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.nan_to_num(x)
    x = x - x.mean(1, keepdims=True)
    norm = np.sqrt((x**2).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def correlation_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 - |r|, gaps as 0."""
    return 1 - np.abs(_unit(x) @ _unit(y).T)


def _ball(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and radius of the unit vectors."""
    u = _unit(x)
    centre = u.mean(0)
    return centre, np.array([np.sqrt(((u - centre) ** 2).sum(1)).max(initial=0)])


def _ball_gap(centre: np.ndarray, radius: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """|x . y| is at most |c . d| + |c| s + |d| r + r s for points of balls (c, r) and (d, s)."""
    r, s = radius[0], radii[:, 0]
    return 1 - np.abs(centres @ centre) - np.sqrt(centre @ centre) * s - np.sqrt((centres**2).sum(1)) * r - r * s - 1e-9


def _known(x: Column) -> Column:
    return F.filter(x, lambda v: v.isNotNull())


EUCLIDEAN = Measure(nan_euclidean, lambda x: F.aggregate(_known(x), F.lit(0.0), lambda t, v: t + v) / F.greatest(F.size(_known(x)), F.lit(1)), _box, _box_gap)
CORRELATION = Measure(correlation_distance, lambda x: F.array_position(x, F.array_max(_known(x))).cast("double"), _ball, _ball_gap)

FOUND = pa.schema([("INDEX", pa.string()), ("Sample", pa.string()), ("dist", pa.float64()), ("donor", pa.string()), ("value", pa.float64()), ("rank", pa.int32())])
FOUND_DDL = "INDEX string, Sample string, dist double, donor string, value double, rank int"
#: Donors whose distances to a block's features are found at once.
MEETING = 4000


class Nearest:
    """The k nearest donors found so far of each gap of some features, or of each feature where donors need no value, and
    the rows of these donors alone."""

    def __init__(self, asks: pa.Table, width: int, k: int, needs_value: bool):
        self.asks, self.x, self.k, self.width = asks, matrix(asks["x"].combine_chunks(), width), k, width
        self.gaps, self.needs_value = np.isnan(self.x), needs_value
        cells = len(self.x) * (width if needs_value else 1)
        self.dist, self.donor = np.full((cells, k), np.inf), np.full((cells, k), -1)
        self.donors = asks.slice(0, 0)

    @property
    def wanted(self) -> np.ndarray:
        """Which cells are looked for: a row a feature."""
        return self.gaps if self.needs_value else self.gaps.any(1, keepdims=True)

    def limits(self) -> np.ndarray:
        return np.where(self.wanted, self.dist[:, -1].reshape(len(self.x), -1), -np.inf)

    def reach(self) -> float:
        """No donor farther than this is looked for; infinite where a gap has fewer than k."""
        return self.limits().max(initial=-np.inf)

    def add(self, rows: pa.Table, d: np.ndarray) -> None:
        """Donors and the features' distances to them."""
        y = matrix(rows["x"].combine_chunks(), self.width)
        have = ~np.isnan(y) if self.needs_value else np.ones((len(y), 1), bool)
        limits = self.limits()
        for j in range(limits.shape[1]):  # a bound for gaps without k donors yet
            of, to = np.flatnonzero(np.isposinf(limits[:, j])), np.flatnonzero(have[:, j])
            if len(of) and len(to) >= self.k:
                limits[of, j] = np.partition(d[np.ix_(of, to)], self.k - 1, axis=1)[:, self.k - 1]
        i, c = np.nonzero((d <= limits.max(1, keepdims=True)) & np.isfinite(d))
        near, j = np.nonzero(have[c] & (d[i, c][:, None] <= limits[i]))
        if not len(near):
            return
        i, c = i[near], c[near]
        cell, dist, donor = i * limits.shape[1] + j, d[i, c], c + len(self.donors)
        moved = np.unique(cell)
        row, place = np.nonzero(self.donor[moved] >= 0)
        cell, dist, donor = np.append(moved[row], cell), np.append(self.dist[moved][row, place], dist), np.append(self.donor[moved][row, place], donor)
        pool = pa.concat_tables([self.donors, rows])
        names = np.array([s.encode() for s in pool["INDEX"].to_pylist()])  # bytes are in the order of names
        by = np.lexsort((names[donor], dist, cell))
        cell, dist, donor = cell[by], dist[by], donor[by]
        place = np.arange(len(cell)) - np.searchsorted(cell, cell)
        best = place < self.k
        self.dist[moved], self.donor[moved] = np.inf, -1
        self.dist[cell[best], place[best]], self.donor[cell[best], place[best]] = dist[best], donor[best]
        used, new = np.unique(self.donor[self.donor >= 0], return_inverse=True)
        self.donor[self.donor >= 0] = new
        self.donors = pool.take(pa.array(used))

    def values(self) -> np.ndarray:
        """What the donors have there: a row a donor."""
        return matrix(self.donors["x"].combine_chunks(), self.width)


def found_rows(found: Nearest, names: list[str]) -> pa.Table:
    """A row for each gap and donor."""
    row, j = np.nonzero(found.gaps)
    cell = row * len(names) + j if found.needs_value else row
    at, place = np.nonzero(found.donor[cell] >= 0)
    donor, x = found.donor[cell[at], place], found.values()
    take = lambda values, i: values.combine_chunks().take(pa.array(i))
    return pa.table([take(found.asks["INDEX"], row[at]), pa.array(names, pa.string()).take(pa.array(j[at])), pa.array(found.dist[cell[at], place]), take(found.donors["INDEX"], donor), pa.array(x[donor, j[at]], pa.float64(), from_pandas=True), pa.array(place + 1, pa.int32())], schema=FOUND)


def _no_rows(schema: pa.Schema, count: int, met: int) -> pa.Table:
    return pa.table([pa.nulls(1, f.type) for f in schema] + [pa.array([count]), pa.array([met])], names=[*schema.names, "_pairs", "_met"])


def feature_donors(
    cells: DataFrame, k: int, measure: Measure, needs_value: bool, block: int | None = None, value: str = "v", more: DataFrame | None = None,
    finish: Callable[[Nearest, list[str]], pa.Table] = found_rows, ddl: str = FOUND_DDL, names: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(INDEX, Sample, dist, donor, value, rank) of the k nearest features for each gap, or what ``finish`` makes of them with
    the columns that ``more`` has by INDEX, and (pairs, met): pairs of blocks there are and pairs that met.

    Features are sorted by ``measure.key`` over all tasks into blocks of about ``block``, a file each in the shared folder. A
    task takes a block, which meets itself first, then the others, nearest outline first, a few thousand features at a
    time, as long as the bound between outlines is no more than the largest kth distance so far. So no pair of blocks and no
    candidate is shuffled, no vector passes the driver, and a task holds a block, a few others, and the donors it keeps.
    """
    spark, names = cells.sparkSession, names or sample_names(cells)
    vectors = feature_vectors(cells, names, value)
    if more is not None:
        vectors = vectors.join(more, "INDEX")
    vectors = stored(vectors.withColumn("_key", measure.key(F.col("x"))), "feature-vectors")
    n, width = vectors.count(), len(names)
    block = block or min(1000, max(100, n // (4 * spark.sparkContext.defaultParallelism)))
    blocks = max(1, -(-n // block))
    placed = stored(vectors.repartitionByRange(blocks, "_key", "INDEX").drop("_key"), "feature-blocks")
    files = sorted(r[0] for r in placed.select(F.input_file_name()).distinct().collect())  # a name a block

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                p, q = measure.outline(matrix(read_file(files[i])["x"].combine_chunks(), width))
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([p.tolist()], pa.list_(pa.float64())), pa.array([q.tolist()], pa.list_(pa.float64()))], names=["id", "p", "q"])

    each = spark.range(0, len(files), 1, max(1, len(files)))
    outlines = sorted(each.coalesce(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))).mapInArrow(outline, "id long, p array<double>, q array<double>").collect())  # a row a block
    held = spark.sparkContext.broadcast(tuple(np.array([r[c] for r in outlines], float) for c in ("p", "q")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                own, (p, q) = read_file(files[i]), held.value
                asks = own.filter(pa.array(np.isnan(matrix(own["x"].combine_chunks(), width)).any(1)))
                found, met = Nearest(asks, width, k, needs_value), 0
                if asks.num_rows:
                    d = measure.distances(found.x, matrix(own["x"].combine_chunks(), width))
                    d[np.array(asks["INDEX"].to_pylist(), object)[:, None] == np.array(own["INDEX"].to_pylist(), object)[None, :]] = np.inf
                    found.add(own, d)
                    bounds = measure.least(p[i], q[i], p, q)
                    todo = [int(o) for o in np.argsort(bounds, kind="stable") if o != i]
                    while todo and bounds[todo[0]] <= (reach := found.reach()):
                        some: list[pa.Table] = []
                        while todo and bounds[todo[0]] <= reach and (not some or sum(x.num_rows for x in some) + own.num_rows <= MEETING):
                            some.append(read_file(files[todo.pop(0)]))
                        met += len(some)
                        rows = pa.concat_tables(some)
                        found.add(rows, measure.distances(found.x, matrix(rows["x"].combine_chunks(), width)))
                out = finish(found, names)
                marked = pa.table([*out.columns, pa.nulls(out.num_rows, pa.int64()), pa.nulls(out.num_rows, pa.int64())], names=[*out.column_names, "_pairs", "_met"])
                yield from pa.concat_tables([marked, _no_rows(out.schema, len(files) - 1, met)]).combine_chunks().to_batches(max_chunksize=10_000)

    all_ = stored(each.mapInArrow(search, f"{ddl}, _pairs long, _met long"), "neighbours")
    pairs = all_.filter("_pairs IS NOT NULL").agg(F.sum("_pairs").alias("pairs"), F.sum("_met").alias("met"))
    return all_.filter("_pairs IS NULL").drop("_pairs", "_met"), pairs
