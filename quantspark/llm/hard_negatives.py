"""Operator 12: hard negatives of anchors, found by segment summaries that bound every inner product."""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col, meet, staged
from quantspark.llm.topk import scaled, usable

#: Segments a level has; a level with more segments than components is left out.
LEVELS = (1, 4, 16)
LONG = 1 << 63
#: Anchors bounded at a time, so that a tile of bounds stays small whatever the block.
TILE = 64
#: Share of the product of both lengths that covers rounding in the bounds.
SLACK = 1e-9


class Summaries:
    """Vectors of one length with the mean and deviation of each segment, level by level.

    With segments of n components, x . y = sum over segments of n (mean x * mean y) + the product of what is left of
    both, which is at most n (deviation x * deviation y) either way. A further level cuts each segment in parts and
    never widens the bounds. Components are divided by a power of two first, so that no product overflows.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, numbers: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.copies, self.numbers, self.x = ids, labels, copies, numbers, x
        self.most = int(max((abs(v) for v in x.flat), default=0) if x.dtype == object else np.abs(x).max(initial=0))
        self.shift = max(0, self.most.bit_length() - 500)
        f = np.array([float(int(v) >> self.shift) for v in x.flat]).reshape(x.shape) if x.dtype == object else x
        self.f, self.length = f, np.sqrt((f * f).sum(1)) + (self.shift > 0)
        self.segments, self.mean, self.deviation = [], [], []
        for n in LEVELS:
            if n <= x.shape[1]:
                edges = np.linspace(0, x.shape[1], n + 1).astype(int)
                size = np.diff(edges)
                mean = np.add.reduceat(f, edges[:-1], axis=1) / size
                self.segments.append([np.arange(*e) for e in zip(edges, edges[1:], strict=False)])
                self.mean.append(mean * np.sqrt(size))
                self.deviation.append(np.sqrt(np.add.reduceat((f - np.repeat(mean, size, axis=1)) ** 2, edges[:-1], axis=1)))

    def take(self, rows: np.ndarray | slice) -> Summaries:
        out = copy.copy(self)
        for name in ("ids", "labels", "copies", "numbers", "x", "f", "length"):
            setattr(out, name, getattr(self, name)[rows])
        out.mean, out.deviation = [m[rows] for m in self.mean], [d[rows] for d in self.deviation]
        return out

    def refined(self, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last level with these segments cut down to single components, which have no deviation."""
        rest = np.setdiff1d(np.arange(self.mean[-1].shape[1]), split)
        parts = np.concatenate([self.segments[-1][s] for s in split])
        return np.hstack([self.f[:, parts], self.mean[-1][:, rest]]), self.deviation[-1][:, rest]


def bounds(a: Summaries, b: Summaries, alive: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lower, upper) scores of all pairs, once a level; pairs no longer in ``alive``, which the caller thins out, keep
    (-inf, -inf). After the levels, the last one's segments with most deviation are cut down to components, half of
    those left at a time. Where many pairs live, a level is one product of matrices, else it goes pair by pair."""
    low, high = np.full(alive.shape, -np.inf), np.full(alive.shape, -np.inf)
    order = np.argsort(-a.deviation[-1].sum(0) * b.deviation[-1].sum(0), kind="stable")
    splits = [order[: len(order) - (len(order) >> k)] for k in range(1, len(order).bit_length())]
    levels = [lambda s, k=k: (s.mean[k], s.deviation[k]) for k in range(len(a.mean))] + [lambda s, k=k: s.refined(k) for k in splits]
    for level in levels:
        if not alive.any():
            return
        (mean_a, deviation_a), (mean_b, deviation_b) = level(a), level(b)
        if alive.mean() > 0.1:
            middle = mean_a @ mean_b.T
            spread = deviation_a @ deviation_b.T + SLACK * a.length[:, None] * b.length[None, :]
            low[:], high[:] = middle - spread, middle + spread
        else:
            i, j = np.nonzero(alive)
            middle = np.einsum("ps,ps->p", mean_a[i], mean_b[j])
            spread = np.einsum("ps,ps->p", deviation_a[i], deviation_b[j]) + SLACK * a.length[i] * b.length[j]
            low[i, j], high[i, j] = middle - spread, middle + spread
        low[~alive] = high[~alive] = -np.inf
        yield low, high


def exact(a: Summaries, b: Summaries, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores of pairs: doubles while they hold every sum exactly, Python integers beyond."""
    if max(a.most, 1) * max(b.most, 1) * a.x.shape[1] < 1 << 53:
        out = np.empty(len(i))
        for s in range(0, len(i), 1 << 16):
            out[s : s + (1 << 16)] = np.einsum("pd,pd->p", a.x[i[s : s + (1 << 16)]].astype(float), b.x[j[s : s + (1 << 16)]].astype(float))
        return out
    return np.array([sum(int(x) * int(y) for x, y in zip(a.x[p], b.x[q], strict=True)) for p, q in zip(i, j, strict=True)] + [None], object)[:-1]


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """Each row's kth largest value; -inf where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


def sortable(score: int) -> tuple[int, str | None]:
    """A score as a long and, at and beyond a long's ends, a text that sorts as the score does."""
    if -LONG < score < LONG - 1:
        return score, None
    digits = str(abs(score)).zfill(700)
    return max(-LONG, min(LONG - 1, score)), digits if score > 0 else digits.translate(str.maketrans("0123456789", "9876543210"))


def unsorted(score: int, beyond: str | None) -> int:
    """The score that ``sortable`` gave."""
    if beyond is None:
        return score
    return int(beyond) if score > 0 else -int(beyond.translate(str.maketrans("0123456789", "9876543210")))


def positives_in(anchors: Summaries, rows: Summaries, k: int) -> tuple[list[tuple], int]:
    """(anchor number, score, id, copies) of the k best rows of each anchor's own label, and how many were scored."""
    out, scored = [], 0
    by_label = np.argsort(rows.labels, kind="stable")
    ends = np.searchsorted(rows.labels[by_label], rows.labels[by_label], side="right")
    for label in np.unique(anchors.labels):
        a = int(np.searchsorted(rows.labels[by_label], label))
        if a == len(by_label) or rows.labels[by_label[a]] != label:
            continue
        own, mine = rows.take(by_label[a : ends[a]]), np.flatnonzero(anchors.labels == label)
        for s in range(0, len(mine), TILE):
            tile = anchors.take(mine[s : s + TILE])
            alive = tile.ids[:, None] != own.ids[None, :]
            for low, high in bounds(tile, own, alive):
                alive &= high >= kth(low, k)[:, None]
            i, j = np.nonzero(alive)
            scored += len(i)
            _best(out, tile, own, i, j, exact(tile, own, i, j), k)
    return out, scored


def _best(out: list[tuple], tile: Summaries, rows: Summaries, i: np.ndarray, j: np.ndarray, score: np.ndarray, k: int, *more: int) -> None:
    """Append each anchor's k best of these pairs, ties to smaller ids."""
    order = np.lexsort((rows.ids[j], -score, i)) if score.dtype != object else np.array(sorted(range(len(i)), key=lambda p: (i[p], -score[p], rows.ids[j[p]])), int)
    i, j, score = i[order], j[order], score[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    for p in np.flatnonzero(place < k):
        out.append((int(tile.numbers[i[p]]), int(score[p]), int(rows.ids[j[p]]), int(rows.copies[j[p]]), *more))


def negatives_in(anchors: Summaries, rows: Summaries, wanted: list[list[int]], k: int, low_percent: int, high_percent: int) -> tuple[list[tuple], int]:
    """For each anchor and each of its positives' scores, the k best rows of other labels within the band of that score:
    (anchor number, score, id, copies, positive's score), and how many pairs were scored."""
    out, scored = [], 0
    shift = anchors.shift + rows.shift
    depth = max(map(len, wanted), default=0)
    for s in range(0, len(wanted), TILE):
        tile, asked = anchors.take(slice(s, s + TILE)), wanted[s : s + TILE]
        # bands as doubles, a little wide; an empty band is (inf, -inf)
        width = lambda v: SLACK * abs(v) + (shift > 0)
        scale = lambda v: float(v >> shift) if shift else float(v)
        least, most = np.full((len(asked), depth), np.inf), np.full((len(asked), depth), -np.inf)
        sure_least, sure_most = least.copy(), most.copy()
        for r, scores in enumerate(asked):
            for c, v in enumerate(scores):
                lo, hi = scale(low_percent * v // 100), scale(high_percent * v // 100)
                least[r, c], most[r, c] = lo - width(lo), hi + width(hi)
                sure_least[r, c], sure_most[r, c] = lo + 1 + width(lo), hi - width(hi)
        alive = (tile.labels[:, None] != rows.labels[None, :]) & (least <= most).any(1)[:, None]
        for low, high in bounds(tile, rows, alive):
            keep = np.zeros_like(alive)
            for c in range(depth):
                # rows that are in the band whatever their score: the kth of their lower bounds must be reached
                sure = np.where((high <= sure_most[:, c, None]) & (low >= sure_least[:, c, None]), low, -np.inf)
                floor = np.maximum(least[:, c], kth(sure, k))
                keep |= (high >= floor[:, None]) & (low <= most[:, c, None])
            alive &= keep
        i, j = np.nonzero(alive)
        scored += len(i)
        score = exact(tile, rows, i, j)
        for c in range(depth):
            v = [scores[c] if c < len(scores) else None for scores in asked]
            fits = np.array([v[p] is not None and low_percent * v[p] <= 100 * int(x) <= high_percent * v[p] for p, x in zip(i.tolist(), score, strict=True)], bool)
            for r in np.unique(i[fits]):
                mine = fits & (i == r)
                _best(out, tile, rows, i[mine], j[mine], score[mine], k, v[r])
    return out, scored


def _summaries(rows: pa.Table, scale: int) -> dict[int, Summaries]:
    """Vectors by their length."""
    sizes, flat = scaled(rows["vector"].combine_chunks(), scale)
    ends, ids, labels, copies = np.cumsum(sizes), *(rows[c].to_numpy() for c in ("id", "label", "copies"))
    out = {}
    for d in np.unique(sizes):
        own = np.flatnonzero(sizes == d)
        out[int(d)] = Summaries(ids[own], labels[own], copies[own], rows["number"].to_numpy()[own], np.stack([flat[ends[i] - d : ends[i]] for i in own]))
    return out


#: Scores as ``sortable`` gives them.
WANTED = "array<struct<score:long,beyond:string>>"


def _grid(rows: DataFrame, anchors: DataFrame, across: int, down: int) -> DataFrame:
    """Each block of rows beside each block of anchors, one group a pair of blocks."""
    names = ["number", "id", "label", "copies", "vector", "wanted"]
    row_block, anchor_block = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(across)), F.pmod(F.xxhash64("number"), F.lit(down))
    left = rows.withColumns({"number": F.lit(0).cast("long"), "wanted": F.lit(None).cast(WANTED)}).select(*names, F.lit(False).alias("asks"), row_block.cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("b"))
    right = anchors.select(*names, F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("a"), anchor_block.cast("int").alias("b"))
    return left.unionByName(right).groupBy("a", "b")


def _answers(scale: int, look: Callable[[Summaries, Summaries, list[list[int]]], tuple[list[tuple], int]]) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        asks = block["asks"].to_numpy()
        anchors, rows = block.filter(pa.array(asks)), block.filter(pa.array(~asks))
        found, scored, pairs = [], 0, anchors.num_rows * rows.num_rows
        if pairs:
            wanted = dict(zip(anchors["number"].to_pylist(), anchors["wanted"].to_pylist(), strict=True))
            candidates = _summaries(rows, scale)
            for d, own in _summaries(anchors, scale).items():
                if d in candidates:
                    some, n = look(own, candidates[d], [[unsorted(**s) for s in wanted[i] or []] for i in own.numbers.tolist()])
                    found, scored = found + some, scored + n
        out = [(f[0], *sortable(f[1]), f[2], f[3], *(sortable(f[4]) if len(f) > 4 else (None, None))) for f in found]
        out.append((-1, scored, None, pairs, 0, None, None))  # one row of counts
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), FOUND, strict=True)], schema=FOUND)

    return run


FOUND = pa.schema([("number", pa.int64()), ("score", pa.int64()), ("beyond", pa.string()), ("found", pa.int64()), ("copies", pa.int64()), ("of_score", pa.int64()), ("of_beyond", pa.string())])
FOUND_DDL = "number long, score long, beyond string, found long, copies long, of_score long, of_beyond string"


def _first(found: DataFrame, key: list[str], k: int) -> DataFrame:
    """The k best of each key over all blocks, as ``place`` from 1; a row with copies takes as many places."""
    order = [F.desc("score"), F.desc_nulls_last("beyond"), F.asc("found")]
    ranked = found.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("_n") <= k)
    spread = ranked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    return spread.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("place") <= k).drop("_n", "_copy")


def mine_hard_negatives(df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_rows: int = 8192, block_anchors: int = 2048) -> tuple[DataFrame, DataFrame]:
    """(negatives, counts). Negatives: anchor_id, place (the positive's), positive_id, rank, negative_id, positive_score,
    negative_score. Counts: for each search, pairs of blocks' rows and how many of them were scored exactly.

    Components become floor(scale * x), scores are their integer inner products. An anchor's positives are its best
    ``positives`` other rows of its label; for each, the best ``negatives`` rows of other labels whose score is between
    ``low_percent`` and ``high_percent`` of the positive's. Rows are dealt by a hash into blocks of about
    ``block_rows``, anchors into blocks of about ``block_anchors``, and every pair of blocks is one group: the size of
    a task's memory is that of two blocks, and no vector passes the driver. In a group, segment summaries bound all
    scores of the anchor's label (then: of other labels), level after level, and only pairs that may be among the best
    are scored. The best of all blocks meet in one window an anchor (an anchor and positive).
    Rows with a null id, label or vector, or a null or non-finite component, take no part; vectors of another length
    than the anchor's are no candidates. Equal rows are one candidate with as many places, and one anchor; rows with
    the anchor's id are its own. Scores beyond a long are compared exactly and returned as the nearest long. Ties: smaller
    ids first. Empty table: no rows. Other columns are not read.
    """
    rows = df.select(col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"), col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = staged(rows.groupBy("id", "label", "vector", "asks").agg(F.count(F.lit(1)).alias("copies")), "vectors")
    asked = staged(rows.filter("asks").drop("asks").withColumn("number", F.monotonically_increasing_id()), "anchors")
    rows = rows.drop("asks")
    across, down = max(1, -(-rows.count() // block_rows)), max(1, -(-asked.count() // block_anchors))
    start = asked.withColumn("wanted", F.lit(None).cast(WANTED))
    first = staged(_grid(rows, start, across, down).applyInArrow(_answers(scale, lambda a, r, _: positives_in(a, r, positives)), FOUND_DDL), "positives")
    best = _first(first.filter("number >= 0"), ["number"], positives)
    best = staged(best.select("number", F.col("place").alias("at"), F.col("found").alias("positive_id"), F.col("score").alias("of_score"), F.col("beyond").alias("of_beyond")), "best")
    wanted = best.groupBy("number").agg(F.collect_set(F.struct(F.col("of_score").alias("score"), F.col("of_beyond").alias("beyond"))).alias("wanted"))  # at most `positives`

    def look(a: Summaries, r: Summaries, scores: list[list[int]]) -> tuple[list[tuple], int]:
        return negatives_in(a, r, scores, negatives, low_percent, high_percent)

    second = staged(_grid(rows, asked.join(wanted, "number"), across, down).applyInArrow(_answers(scale, look), FOUND_DDL), "negatives")
    each = meet(second.filter("number >= 0"), best, ["number", "of_score", "of_beyond"])
    ranked = _first(each, ["number", "at"], negatives)
    out = ranked.join(asked.select("number", F.col("id").alias("anchor_id")), "number").select(
        "anchor_id", F.col("at").alias("place"), "positive_id", F.col("place").cast("int").alias("rank"), F.col("found").alias("negative_id"), F.col("of_score").alias("positive_score"), F.col("score").alias("negative_score")
    )
    counts = [t.filter("number < 0").select(F.lit(n).alias("search"), F.col("found").alias("pairs"), F.col("score").alias("scored")) for n, t in (("positives", first), ("negatives", second))]
    return out, counts[0].unionByName(counts[1]).groupBy("search").agg(F.sum("pairs").alias("pairs"), F.sum("scored").alias("scored"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Query: hard negatives of every embedding whose id is divisible by 100, every seventh id's label shifted."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(F.col("label").isNotNull())
    df = df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    out, _ = mine_hard_negatives(df, F.col("vec_id") % 100 == 0)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same
), n AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, place ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  WHERE place <= 5 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
