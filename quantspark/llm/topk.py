"""Operator 10: exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col

LONG = 1 << 63
#: Beyond this size of a component, float64 may not hold a sum of products exactly and Python integers are used.
EXACT = 1 << 20


def usable(vector: Column) -> Column:
    """Neither null nor empty, all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def scaled(lists: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and floor(scale * x) of all components one after another; Python integers where a double can't hold them."""
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if len(flat) and np.abs(flat).max() > 2.0**52:  # beyond, a double is a whole number
        return sizes, np.array([int(x) * scale if abs(x) > 2.0**52 else math.floor(x * scale) for x in flat.tolist()], object)
    return sizes, np.floor(scale * flat)


class Lists:
    """A block of candidates with one list for each dimension, sorted by that component."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by_id], x[by_id]
        self.most = max(map(abs, self.x.flat), default=0) if x.dtype == object else np.abs(x).max(initial=0)
        self.order = np.argsort(self.x, axis=0, kind="stable").T if self.most <= EXACT else None  # dimension x rank, ascending

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of this block, ties to smaller ids.

        All lists are read in steps from their best end, the first a thirty-second deep; each row that turns up is
        scored once by random access. No unseen row can score above the sum of query times last-read components;
        reading stops when that bound is below the kth score (equal scores may still win by their id), or when every
        row has turned up.
        """
        n = len(self.x)
        live = np.flatnonzero(query)
        up, down = live[query[live] > 0], live[query[live] < 0]
        seen = self.ids == own
        found, score, at, upto = np.empty(0, np.int64), np.empty(0), 0, max(8, n // 32)
        while not seen.all():
            upto = min(n, upto) if len(live) else n
            fresh = ~seen
            if upto < n:
                turned = np.zeros(n, bool)
                turned[self.order[up, n - upto : n - at]] = True
                turned[self.order[down, at:upto]] = True
                fresh &= turned
            rows = np.flatnonzero(fresh)
            seen |= fresh
            found, score = np.concatenate([found, rows]), np.concatenate([score, self.x[rows] @ query])
            if len(found) > k:
                best = score >= np.partition(score, -k)[-k]
                found, score = found[best], score[best]
            if upto < n and len(found) >= k:
                bound = self.x[self.order[up, n - upto], up] @ query[up] + self.x[self.order[down, upto - 1], down] @ query[down]
                if bound < score.min():
                    break
            at, upto = upto, 2 * upto
        best = np.lexsort((self.ids[found], -score))[:k]
        return self.ids[found[best]], score[best]


def _exact_top(ids: np.ndarray, x: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[list[int], list[int]]:
    """For components too large for float64 sums: whole Python integers, limited to the range of a long (beyond it all are ties)."""
    whole = [int(v) for v in query]
    rows = [(-max(-LONG, min(LONG - 1, sum(int(a) * b for a, b in zip(row, whole, strict=True)))), int(i)) for i, row in zip(ids, x, strict=True) if i != own]
    best = sorted(rows)[:k]
    return [i for _, i in best], [-s for s, _ in best]


def threshold_top_k(df: DataFrame, queries: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 2048) -> DataFrame:
    """The k largest integer inner products of each query row with all other rows: query_id, rank, id, score.

    Components become floor(scale * x). Rows for which ``queries`` holds are the queries. They are sent to the tasks
    in blocks of at most about ``block`` rows (the bound of each broadcast), and each block meets all rows: every
    Arrow batch of candidates builds its sorted lists once and answers all queries of the block by the threshold
    algorithm; the best k of each batch then meet in one window per query.
    Vectors that are null, empty, or hold null or non-finite components take no part; vectors of another length than
    the query's are no candidates. A query's own rows are those with its id. Repeated queries give one result,
    repeated candidates one rank each. Null ids take no part. Empty table: no rows.
    """
    rows = df.select(col(id_col).cast("long").alias("id"), col(vector_col).alias("vector"), queries.alias("is_query")).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    asked = rows.filter(F.coalesce("is_query", F.lit(False))).select("id", "vector").distinct()
    blocks = max(1, -(-asked.count() // block))
    found = None
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow()  # about `block` rows
        sizes, flat = scaled(part["vector"].combine_chunks(), scale) if part.num_rows else (np.empty(0, int), np.empty(0))
        ends = np.cumsum(sizes)
        sent = df.sparkSession.sparkContext.broadcast([(int(i), flat[e - s : e]) for i, s, e in zip(part["id"].to_pylist(), sizes, ends, strict=True)])

        def answer(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("id").to_numpy(zero_copy_only=False)
                sizes, flat = scaled(batch.column("vector"), scale)
                ends, lists, out = np.cumsum(sizes), {}, ([], [], [])
                for dims in set(sizes.tolist()):
                    own = np.flatnonzero(sizes == dims)
                    lists[dims] = Lists(ids[own], np.stack([flat[ends[i] - dims : ends[i]] for i in own]))
                for query, q in sent.value:
                    if (block := lists.get(len(q))) is None:
                        continue
                    if max(block.most, *map(abs, q.tolist())) > EXACT:
                        best, score = _exact_top(block.ids, block.x, q, query, k)
                    else:
                        best, score = block.top(q, query, k)
                    out[0].extend([query] * len(best))
                    out[1].extend(int(i) for i in best)
                    out[2].extend(int(s) for s in score)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query_id", "id", "score"])

        part_found = rows.select("id", "vector").mapInArrow(answer, "query_id long, id long, score long")
        found = part_found if found is None else found.unionByName(part_found)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def op10_threshold_top_k(spark, sf_dir: str) -> DataFrame:
    """Query: the 10 best of every embedding whose id is divisible by 100."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return threshold_top_k(df, F.col("vec_id") % 100 == 0, k=10, scale=1024)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
