"""Operator 2: best-fit packing by length patterns fitted to the histogram with non-negative least squares."""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col, slices, small_batches, staged

#: The ids are those of this file; its ranks alone are read from the ``.tiktoken`` file beside it, whose library gives
#: the same ids in a fifth of the time.
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0


@cache
def encoding(vocabulary: str) -> tiktoken.Encoding:
    path = public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: all full, but the first may be shorter."""
    first = n % most or min(n, most)
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def tokenized_pieces(df: DataFrame, most: int, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """id, piece, start, length, ids_crc32 of every piece of every text, its end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(vocabulary)
        added = own.special_tokens_set  # in a text they are one token, as that file declares them
        for batch in chain.from_iterable(map(slices, batches)):
            out: list[list[int]] = [[], [], [], [], []]
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = array("I", own.encode(text, allowed_special=added))
                ids.append(END_ID)
                raw = ids.tobytes()
                for piece, (start, length) in enumerate(cut(len(ids), most)):
                    rows.append(i)
                    for to, x in zip(out[1:], (piece, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])), strict=True):
                        to.append(x)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows, pa.int64())), *(pa.array(x, k) for x, k in zip(out[1:], kinds, strict=True))], names=["id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def patterns(lengths: np.ndarray, most: int) -> list[tuple[int, ...]]:
    """Patterns of two and three lengths that fill a sequence: all pairs, and for each longest length a few splits of the rest."""
    there = set(lengths.tolist())
    found = {(a, most - a) for a in range(-(-most // 2), most)}
    for a in range(-(-most // 3), most - 1):
        rest = most - a
        for part in (2, 3, 4, 5, 7, 11):
            c = rest // part
            if c and rest - c <= a:
                found.add((a, rest - c, c))
    return sorted(p for p in found if there.issuperset(p))


def fit(columns: list[tuple[int, ...]], histogram: dict[int, int], most: int, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 with least squared error of (patterns @ x - histogram), by accelerated projected gradients.

    Errors of long documents weigh more, as they are harder to place.
    """
    rows = np.array([length - 1 for p in columns for length in p])
    cols = np.repeat(np.arange(len(columns)), [len(p) for p in columns])
    h = np.zeros(most)
    for length, n in histogram.items():
        h[length - 1] = n
    weight = (0.2 + np.arange(1, most + 1) / most) ** 2

    def gradient(x: np.ndarray) -> np.ndarray:
        error = weight * (np.bincount(rows, x[cols], most) - h)
        return np.bincount(cols, error[rows], len(columns))

    # the largest eigenvalue is at most the largest sum of |entries| of A'WA over a row
    load = np.bincount(cols, (weight * np.bincount(rows, minlength=most))[rows], len(columns))
    step = 1 / max(load.max() * 3, 1e-9)
    x = z = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        y = np.maximum(0, z - step * gradient(z))
        u = (1 + (1 + 4 * t * t) ** 0.5) / 2
        x, z, t = y, y + (t - 1) / u * (y - x), u
    return x


def rounded(columns: list[tuple[int, ...]], x: np.ndarray, histogram: dict[int, int]) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Whole repeat counts that the histogram can serve, most-used patterns first, and what is left of it."""
    left, plan = dict(histogram), []
    for i in np.lexsort((np.arange(len(x)), -x)):
        need: dict[int, int] = defaultdict(int)
        for length in columns[i]:
            need[length] += 1
        n = min(round(float(x[i])), min(left[length] // k for length, k in need.items()))
        if n > 0:
            plan.append((columns[i], n))
            for length, k in need.items():
                left[length] -= n * k
    return plan, {length: n for length, n in left.items() if n}


def best_fit(histogram: dict[int, int], most: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts of lengths: equal sequences are one pattern with a repeat count."""
    free: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((r for r in free if r >= length), default=0)
            if not room:
                each = most // length
                if full := left // each:
                    free[most - each * length].append(((length,) * each, full))
                if odd := left % each:
                    free[most - odd * length].append(((length,) * odd, 1))
                break
            pattern, n = free[room].pop()
            k = min(n, left)
            if n > k:
                free[room].append((pattern, n - k))
            if not free[room]:
                del free[room]
            free[room - length].append(((*pattern, length), k))
            left -= k
    return [p for of in free.values() for p in of]


def plan_packs(histogram: dict[int, int], most: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeat count) that place every length. Work depends on the number of lengths, not on that of documents."""
    fixed = [((most,), histogram[most])] if histogram.get(most) else []
    rest = {length: n for length, n in histogram.items() if length < most}
    if not rest:
        return fixed
    plain = best_fit(rest, most)
    columns = patterns(np.array(sorted(rest)), most)
    if not columns:
        return fixed + plain
    x = fit(columns, rest, most)
    tried = []
    for share in (1.0, 0.9, 0.75, 0.5):  # the rounded fit, and with more left to the residuals
        plan, left = rounded(columns, x * share, rest)
        tried.append(plan + best_fit(left, most))
    return fixed + min([*tried, plain], key=lambda p: sum(n for _, n in p))


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from, to, copies in a sequence, first sequence, first offset): numbers of the pieces of a length that a pattern takes."""
    taken: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, n in plan:
        at = 0
        for length in sorted(set(pattern), reverse=True):
            k = pattern.count(length)
            out.append((length, taken[length], taken[length] + n * k, k, sequence, at))
            taken[length] += n * k
            at += k * length
        sequence += n
    return out


def pack(df: DataFrame, most: int = 2048, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, window: int = 100_000) -> DataFrame:
    """Pack all documents into few sequences of at most ``most`` tokens.

    Texts are tokenized once, each with an end id; only longer ones are cut, into full pieces after a shorter first.
    The histogram of piece lengths (at most ``most`` counts) goes to the driver, where patterns are fitted, rounded and
    residuals packed as counts, so that the plan's size depends on ``most`` alone. Pieces of a length are then numbered
    (in parts of about ``window`` pieces at most, so that one hot length is many windows) and a number finds its sequence and
    offset in the plan's slots.

    Returns id, piece, start, length, ids_crc32, sequence_id, offset. Null text: empty, one piece of the end id alone.
    Null or repeated ids and repeated rows are packed like any other, each row for itself. Very long texts: one is
    tokenized at a time, whole. Empty table: no rows. Other columns are not read.
    """
    small_batches(df.sparkSession)
    spark = df.sparkSession
    pieces = tokenized_pieces(df, most, id_col, text_col, vocabulary)
    pieces = staged(pieces, "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    salts = 1 + max(histogram.values(), default=0) // window
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    table = spark.createDataFrame(slots(plan_packs(histogram, most)), "length long, lo long, hi long, k long, first_sequence long, first_offset long")

    counts = pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("length", "salt", (F.sum("n").over(before) - F.col("n")).alias("first"))
    inside = Window.partitionBy("length", "salt").orderBy("id", "piece", "start", "ids_crc32")
    numbered = pieces.withColumn("rn", F.row_number().over(inside) - 1).join(starts, ["length", "salt"]).withColumn("number", F.col("first") + F.col("rn"))
    # the plan has at most a few rows for each of `most` lengths
    placed = numbered.join(F.broadcast(table), (numbered["length"] == table["length"]) & (F.col("number") >= F.col("lo")) & (F.col("number") < F.col("hi"))).drop(table["length"])
    step = F.col("number") - F.col("lo")
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.expr("(number - lo) div k")).alias("sequence_id"),
        (F.col("first_offset") + (step % F.col("k")) * F.col("length")).alias("offset"),
    )


def op2_pattern_packing(spark, sf_dir: str) -> DataFrame:
    """Query: all documents into sequences of at most 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), most=2048)
