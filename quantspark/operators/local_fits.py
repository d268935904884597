"""LOESS over sorted points that no task holds: windows are summed from power sums, every point is fitted on its whole window."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.sources.scratch import stored

#: Points of a sample that stand together in one task; windows under four times as many take smaller blocks.
BLOCK = 20_000
#: A block is not smaller for the number of blocks alone.
LEAST = 5_000
#: Powers of x, and of x with y, that the tricube weights of a quadratic fit need.
POWERS, WITH_Y = 14, 12
_EXACT = np.longdouble
_CHOOSE = [[float(np.prod(np.arange(p - j + 1, p + 1)) / np.prod(np.arange(1, j + 1))) for j in range(p + 1)] for p in range(POWERS)]
_PIECE_DDL = "Sample string, at long, n long, first double, last double, sums array<double>"


@dataclass(frozen=True)
class Piece:
    """Consecutive points of a sample: the first one's rank, how many, the ends, and the sums about ``first`` and over ``last - first``."""

    at: int
    n: int
    first: float
    last: float
    sums: np.ndarray


@dataclass(frozen=True)
class Layout:
    """How a sample of n points is cut: windows of k points, blocks of ``block`` points, and the steps of a window's left end,
    ``block`` each, as the doubled middles at which they begin (``steps``) and at which the last one ends."""

    n: int
    k: int
    block: int
    pieces: list[Piece]
    steps: np.ndarray
    end: float

    @property
    def moves(self) -> int:
        return self.n - self.k

    def step_of(self, twice: np.ndarray) -> np.ndarray:
        """-1: the window is the leftmost one; as many as there are steps: the rightmost one."""
        of = np.searchsorted(self.steps, twice, "left") - 1
        return np.where(twice > self.end, len(self.steps), of) if len(self.steps) else np.full(np.shape(twice), -1)

    def lefts(self, step: int) -> tuple[int, int]:
        """The least and the greatest left end in a step."""
        if step < 0:
            return 0, 0
        return (self.moves, self.moves) if step == len(self.steps) else (step * self.block, min((step + 1) * self.block, self.moves))


def window_size(n: int, span: float) -> int:
    return max(3, min(n, int(np.ceil(span * n))))


def _block(n: int, k: int, blocks: int) -> int:
    return max(1, min(BLOCK, k // 4, -(-n // blocks) if n > blocks * LEAST else LEAST))


def _powers(u: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows: 1, u, u^2, ..., then y, y u, ...; a column a point."""
    u, y = u.astype(_EXACT), y.astype(_EXACT)
    out = np.empty((POWERS + WITH_Y, len(u)), _EXACT)
    out[0] = 1
    for p in range(1, POWERS):
        np.multiply(out[p - 1], u, out=out[p])
    np.multiply(out[:WITH_Y], y, out=out[POWERS:])
    return out


def _moved(sums: np.ndarray, shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Sums of powers of ``u * scale + shift`` from those of u."""
    shift, scale = np.asarray(shift, _EXACT), np.asarray(scale, _EXACT)
    shifts, scales = [np.ones_like(shift)], [np.ones_like(scale)]
    for _ in range(POWERS - 1):
        shifts.append(shifts[-1] * shift)
        scales.append(scales[-1] * scale)
    out = np.zeros(sums.shape, _EXACT)
    for start, many in ((0, POWERS), (POWERS, WITH_Y)):
        scaled = [sums[start + j] * scales[j] for j in range(many)]
        for p in range(many):
            for j in range(p + 1):
                out[start + p] += _CHOOSE[p][j] * scaled[j] * shifts[p - j]
    return out


def _pieces(batch: pd.DataFrame, cuts: dict[str, tuple[int, int, int]]) -> Iterator[tuple]:
    """Sums of runs of consecutive ranks that no cut parts: multiples of the block, these past k, and the last left end."""
    at, name = batch["at"].to_numpy(np.int64), batch["Sample"].to_numpy()
    n, k, block = (np.array([cuts[s][i] for s in name], np.int64) for i in range(3))
    keys = (at // block, np.where(at >= k, (at - k) // block, -1), at >= n - k)
    new = np.flatnonzero((np.diff(at) != 1) | (name[1:] != name[:-1]) | np.logical_or.reduce([np.diff(x) != 0 for x in keys])) + 1
    x, y = batch["M"].to_numpy(float), batch["A"].to_numpy(float)
    for a, b in zip([0, *new], [*new, len(at)]):
        width = x[b - 1] - x[a]
        u = (x[a:b] - x[a]) / width if width > 0 else np.zeros(b - a)
        sums = _powers(u, y[a:b]).sum(1)
        high = sums.astype(float)
        yield name[a], at[a], b - a, x[a], x[b - 1], np.concatenate([high, (sums - high).astype(float)])  # the digits that a double has no room for


def _joined(halves: np.ndarray) -> np.ndarray:
    return halves[: POWERS + WITH_Y].astype(_EXACT) + halves[POWERS + WITH_Y :]


def layouts(ranked: DataFrame, sizes: dict[str, int], span: float, blocks: int) -> dict[str, Layout]:
    """The layout of each sample: of its points' sums there is a row for each batch and cut."""
    cuts = {s: (n, k := window_size(n, span), _block(n, k, blocks)) for s, n in sizes.items()}

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = list(_pieces(batch.to_pandas().sort_values(["Sample", "at"], ignore_index=True), cuts))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64())))], names=["Sample", "at", "n", "first", "last", "sums"])

    of: dict[str, list[Piece]] = {s: [] for s in sizes}
    for r in ranked.select("Sample", (F.col("rank") - 1).alias("at"), "M", "A").mapInArrow(summed, _PIECE_DDL).collect():  # a row for each ten thousand points or so
        of[r["Sample"]].append(Piece(r["at"], r["n"], r["first"], r["last"], _joined(np.array(r["sums"]))))
    out = {}
    for s, (n, k, block) in cuts.items():
        pieces = sorted(of[s], key=lambda p: p.at)
        first, last = {p.at: p.first for p in pieces}, {p.at + p.n: p.last for p in pieces}
        steps = np.array([first[i] + first[i + k] for i in range(0, n - k, block)])
        out[s] = Layout(n, k, block, pieces, steps, last[n - k] + last[n] if n > k else -np.inf)
    return out


def meetings(layout: Layout) -> list[tuple[int, int]]:
    """(block, step) where points of the block have a window that begins in the step: at most as many as blocks and steps together."""
    ends: dict[int, list[float]] = {}
    for p in layout.pieces:
        ends.setdefault(p.at // layout.block, []).extend((p.first, p.last))
    out = []
    for b, of in sorted(ends.items()):
        low, high = layout.step_of(np.array([2 * min(of), 2 * max(of)]))
        out += [(b, int(t)) for t in range(low, high + 1)]
    return out


def _tricube(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The fits' values at 0, from sums of powers of u in [-1, 0] and in [0, 1] with weights (1 - |u|^3)^3.

    Solved by orthogonal polynomials; a direction that no weight reaches (too few distinct points) is left out.
    """
    both, apart = left + right, right - left
    weighed = lambda q: both[q] - 3 * apart[q + 3] + 3 * both[q + 6] - apart[q + 9]
    g0, g1, g2, g3, g4 = (weighed(q) for q in range(5))
    y0, y1, y2 = (weighed(POWERS + q) for q in range(3))
    mean, square = g1 / g0, g2 / g0
    one, cross = g2 - mean * g1, g3 - mean * g2
    some = one > 1e-13 * g0
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where(some, (y1 - mean * y0) / one, 0)
        along = np.where(some, cross / one, 0)
        two = g4 - along * cross - square * g2
        bend = np.where(two > 1e-13 * g0, (y2 - along * (y1 - mean * y0) - square * y0) / two, 0)
    return (y0 / g0 - slope * mean + bend * (along * mean - square)).astype(float)


def _fit(at: np.ndarray, x: np.ndarray, y: np.ndarray, layout: Layout, block: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(ranks, fitted values) of the block's points whose window begins in the step. The points held, in order of rank, are
    the block's, and those that windows gain and lose within the step; all others come as pieces' sums."""
    own = np.flatnonzero((at // layout.block == block) & (layout.step_of(2 * x) == step))
    if not len(own):
        return at[own], np.empty(0)
    k, (low, high) = layout.k, layout.lefts(step)
    first, last = {p.at: p.first for p in layout.pieces}, {p.at + p.n: p.last for p in layout.pieces}
    lows = x[np.searchsorted(at, low) : np.searchsorted(at, high)]
    highs = x[np.searchsorted(at, low + k) : np.searchsorted(at, high + k)]
    if high > low:
        left = low + np.searchsorted(lows + highs, 2 * x[own], "left")
        begins, ends = np.append(lows, first[high]), np.append(last[low + k], highs)
    else:
        left, begins, ends = np.full(len(own), low), np.array([first[low]]), np.array([last[low + k]])
    reach = np.maximum(np.maximum(x[own] - begins[left - low], ends[left - low] - x[own]), 1e-12) * 1.0000001
    middle = np.clip(at[own], left, left + k)
    held = np.isin([p.at for p in layout.pieces], at)  # a piece is held whole or not at all
    out = np.empty(len(own))

    def total(a: int, b: int, centre: float, scale: float) -> np.ndarray:
        """Sums of the ranks a to b about the centre."""
        i, j = np.searchsorted(at, (a, b))
        sums = _powers((x[i:j] - centre) / scale, y[i:j]).sum(1) if j > i else np.zeros(POWERS + WITH_Y, _EXACT)
        rest = [p for p, h in zip(layout.pieces, held) if not h and a <= p.at < b]
        if rest:
            shift, width = np.array([(p.first - centre) / scale for p in rest]), np.array([(p.last - p.first) / scale for p in rest])
            sums = sums + _moved(np.array([p.sums for p in rest]).T, shift, width).sum(1)
        return sums

    def running(a: int, b: int, centre: float, scale: float, back: bool = False) -> np.ndarray:
        """Sums of the first 0, 1, ... of the held ranks a to b, or of the last ones."""
        i, j = np.searchsorted(at, (a, b))
        of = _powers((x[i:j] - centre) / scale, y[i:j])
        return np.concatenate([np.zeros((POWERS + WITH_Y, 1), _EXACT), np.cumsum(of[:, ::-1] if back else of, 1)], 1)

    todo = [(0, len(own))]
    while todo:
        i, j = todo.pop()
        l0, l1, m0, m1 = int(left[i]), int(left[j - 1]), int(middle[i]), int(middle[j - 1])
        if j - i > 1 and (l1 > m0 or m1 > l0 + k):  # sums are taken from the points outward, so that none is a difference
            todo += [(i, (i + j) // 2), ((i + j) // 2, j)]
            continue
        rows = slice(i, j)
        c, h = x[own[rows]], reach[rows]
        centre, scale = (c[0] + c[-1]) / 2, h.max()
        inner = running(m0, m1, centre, scale)[:, middle[rows] - m0]
        lost = running(l0, l1, centre, scale, True)[:, l1 - left[rows]]
        gained = running(l0 + k, l1 + k, centre, scale)[:, left[rows] - l0]
        on_left = total(l1, m0, centre, scale)[:, None] + lost + inner
        on_right = total(m1, l0 + k, centre, scale)[:, None] + gained + (inner[:, -1:] - inner)
        shift, width = (centre - c) / h, scale / h
        out[rows] = _tricube(_moved(on_left, shift, width), _moved(on_right, shift, width))
    return at[own], out


def whole_loess(ranked: DataFrame, sizes: dict[str, int], span: float, blocks: int) -> DataFrame:
    """INDEX, Sample, _fit: local quadratic fits with tricube weights at every point of large samples (INDEX, Sample, M, A, rank).

    As a point's window moves with it, a fit is a sum over the window of powers of M with weights; tricube weights are
    polynomials on either side of the point. Points are cut by rank into blocks, and the left ends of windows into steps of
    as many points. A task holds a block and what windows gain and lose in one step, at most three blocks; what lies between
    comes as sums. The points move once for each block they are in and once for each meeting with a step.
    """
    of = layouts(ranked, sizes, span, blocks)
    held = ranked.sparkSession.sparkContext.broadcast(of)
    steps = [(s, b, t, *(layout.lefts(t) if 0 <= t < len(layout.steps) else (0, 0)), layout.k, layout.block) for s, layout in of.items() for b, t in meetings(layout)]
    # a row for each meeting: blocks and steps of all samples together
    pairs = ranked.sparkSession.createDataFrame(steps, "Sample string, _b long, _t long, _low long, _high long, _k long, _w long")
    points = ranked.select("INDEX", "Sample", "M", "A", (F.col("rank") - 1).alias("at"))
    cuts = ranked.sparkSession.createDataFrame([(s, layout.k, layout.block, layout.moves) for s, layout in of.items()], "Sample string, _k long, _w long, _moves long")
    placed = points.join(F.broadcast(cuts), "Sample")
    by_block, by_step = pairs.select("Sample", "_b", "_t"), pairs.filter("_high > _low").select("Sample", "_b", "_t")
    block, lows = F.floor(F.col("at") / F.col("_w")), F.col("at") < F.col("_moves")
    highs = F.floor((F.col("at") - F.col("_k")) / F.col("_w"))
    columns = ["Sample", "_b", "_t", "at", "M", "A"]
    rows = placed.withColumn("_b", block).join(F.broadcast(by_block), ["Sample", "_b"]).select(*columns, "INDEX", F.lit(True).alias("own"))
    # the same point may be in a block and in a step: it comes twice and counts once
    for of_step in (placed.filter(lows).withColumn("_t", block), placed.filter(F.col("at") >= F.col("_k")).withColumn("_t", highs)):
        rows = rows.unionByName(of_step.join(F.broadcast(by_step), ["Sample", "_t"]).select(*columns, F.lit(None).cast("string").alias("INDEX"), F.lit(False).alias("own")))

    def fit(group: pa.Table) -> pa.Table:
        at, x, y = (group[c].to_numpy() for c in ("at", "M", "A"))
        block, step, sample = (group[c][0].as_py() for c in ("_b", "_t", "Sample"))
        ranks, once = np.unique(at, return_index=True)
        found, values = _fit(ranks, x[once], y[once], held.value[sample], block, step)
        named = np.flatnonzero(group["own"].to_numpy())
        named = named[np.argsort(at[named])]
        place = named[np.searchsorted(at[named], found)]
        return pa.table([group["INDEX"].combine_chunks().take(pa.array(place)), pa.array([sample] * len(found), pa.string()), pa.array(values)], names=["INDEX", "Sample", "_fit"])

    return stored(rows.groupBy("Sample", "_b", "_t").applyInArrow(fit, "INDEX string, Sample string, _fit double"), "fits")
