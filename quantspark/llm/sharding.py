"""Operator 7: reproducible sharding by a Feistel permutation of global row numbers. DataFrame functions only."""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col, staged

ROUNDS = 6


@dataclass(frozen=True)
class Feistel:
    """A keyed permutation of ``range(n)``.

    Row x is the pair (x div right, x mod right) in a domain of left * right >= n points, with less than ``left``
    points too many. Rounds change one half in turn by a hash of the other. Points that land outside ``range(n)``
    are permuted again (cycle walking); ``walks`` is the longest such walk, found from the few points outside.
    """

    n: int
    seed: int = 0

    @property
    def left(self) -> int:
        return max(1, math.isqrt(max(0, self.n - 1)) + 1)

    @property
    def right(self) -> int:
        return max(1, -(-self.n // self.left))

    def _key(self, i: int) -> int:
        return (self.seed * 1_000_003 + i * 7_919 + 1) % (1 << 31)

    def _once(self, x: int, back: bool = False) -> int:
        a, b = divmod(x, self.right)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            h = xxhash.xxh64(struct.pack("<q", (b if i % 2 == 0 else a) + self._key(i) * (1 << 31)), seed=42).intdigest()
            h = h - (1 << 64) if h >> 63 else h  # as a signed long
            if i % 2 == 0:
                a = (a - h % self.left if back else a + h % self.left) % self.left
            else:
                b = (b - h % self.right if back else b + h % self.right) % self.right
        return a * self.right + b

    def at(self, x: int) -> int:
        """Where row x goes."""
        while (x := self._once(x)) >= self.n:
            pass
        return x

    def row(self, y: int) -> int:
        """The row that went to y."""
        while (y := self._once(y, back=True)) >= self.n:
            pass
        return y

    def walks(self) -> int:
        """Most extra applications that any row needs: the longest chain of consecutive points outside."""
        step = {x: self._once(x) for x in range(self.n, self.left * self.right)}
        longest = 0
        for x in step:
            k = 1
            while (x := step[x]) >= self.n:
                k += 1
                if k > len(step):  # a cycle that no row enters
                    k = 0
                    break
            longest = max(longest, k)
        return longest

    def columns(self, df: DataFrame, x: str, out: str) -> DataFrame:
        """Add ``out`` = ``at(x)`` by column arithmetic."""
        df = self._apply(df, x, out)
        for _ in range(self.walks()):
            df = self._apply(df, out, "_next")
            df = df.withColumn(out, F.when(F.col(out) < self.n, F.col(out)).otherwise(F.col("_next"))).drop("_next")
        return df

    def _apply(self, df: DataFrame, x: str, out: str) -> DataFrame:
        df = df.withColumns({"_a": F.expr(f"`{x}` div {self.right}L"), "_b": F.col(x) % F.lit(self.right).cast("long")})
        for i in range(ROUNDS):
            to, by, size = ("_a", "_b", self.left) if i % 2 == 0 else ("_b", "_a", self.right)
            whole, moved = F.lit(size).cast("long"), F.xxhash64(F.col(by) + F.lit(self._key(i) * (1 << 31)))
            df = df.withColumn(to, (F.col(to) + F.pmod(moved, whole)) % whole)
        return df.withColumn(out, F.col("_a") * F.lit(self.right).cast("long") + F.col("_b")).drop("_a", "_b")


def numbered(df: DataFrame, key: list[str], buckets: int = 1024) -> tuple[DataFrame, int]:
    """Global row numbers from 0 without a global sort: (rows with ``row``, their count).

    Rows are counted by ``key``, keys hashed into ``buckets``; a row number is the offset of its bucket plus its place
    in the bucket by key. Only the ``buckets`` counts reach the driver. Repeated rows are one counted key until the
    end, so that a key with very many copies is one row in the window, and its copies are dealt out afterwards.
    """
    keys = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"))
    keys = staged(keys.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")), "row-keys")
    sizes = {r[0]: r[1] for r in keys.groupBy("_bucket").agg(F.sum("_copies")).collect()}
    start, total = [], 0
    for b in range(buckets):
        start.append(total)
        total += sizes.get(b, 0)
    offsets = df.sparkSession.createDataFrame([(b, x) for b, x in enumerate(start)], "_bucket int, _start long")
    inside = Window.partitionBy("_bucket").orderBy(*key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the offsets are `buckets` rows, whatever the input
    out = keys.withColumn("_upto", F.sum("_copies").over(inside)).join(F.broadcast(offsets), "_bucket")
    first = F.col("_start") + F.col("_upto") - F.col("_copies")
    return out.select(*key, F.explode(F.sequence(first, F.col("_start") + F.col("_upto") - 1)).alias("row")), total


def feistel_shards(df: DataFrame, shards: int = 24, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1024) -> DataFrame:
    """Shuffle all rows reproducibly into ``shards`` shards whose counts differ by one at most.

    Returns id, size (UTF-8 bytes plus 8), text_crc32, row (global number), place (after the permutation), shard and
    slot, one row for each input row. shard = place mod shards, slot = place div shards, so both follow from the row
    number alone (``Feistel.at``), and a row number from both (``Feistel.row``).
    Null text: size 8 and CRC of no bytes; null id: a key like any other; repeated rows: as many rows, each with its
    own slot; empty table: no rows. Other columns are not read.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows, n = numbered(df.select(col(id_col).alias(id_col), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")), [id_col, "size", "text_crc32"], buckets)
    perm = Feistel(max(n, 1), seed)
    placed = perm.columns(rows, "row", "place")
    return placed.withColumns({"shard": (F.col("place") % shards).cast("int"), "slot": F.expr(f"place div {shards}L")})


def op7_feistel_shards(spark, sf_dir: str) -> DataFrame:
    """Query: all documents into 24 shards under the law ``rows``."""
    out = feistel_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=24, seed=7)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
