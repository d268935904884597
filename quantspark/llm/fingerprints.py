"""Operator 13: document fingerprints from improbable byte windows in chained Bloom filters."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col, meet, slices, small_batches, staged

#: (window, least, below): bytes of a window, and of the texts that have features of this scale. Texts of similar
#: lengths share a scale.
SCALES = ((32, 64, 1 << 62), (8, 0, 256))
#: Entropy classes of a scale, bits and features of a filter, bits a feature sets.
CLASSES, BITS, FEATURES, SETS = 1000, 2048, 160, 5
NOWHERE = np.iinfo(np.int64).max
#: Bytes of texts that are worked on at a time: arrays of this length stay in cache.
SLICE = 1 << 18


def entropy_classes(data: np.ndarray, window: int) -> np.ndarray:
    """The class of each window of ``data``: its bytes' entropy of at most log2(window) bits, in CLASSES steps.

    From one window to the next the sum of c log c changes by what one byte takes away and another adds, which depend
    on how often each occurs in its window: counted by comparing the text with itself at every distance. Sums are
    whole numbers of 2^-20, so that they don't depend on where a text stands in a batch.
    """
    n, c = len(data), np.arange(window + 1)
    if n < window:
        return np.empty(0, np.int64)
    clogc = np.rint(c * np.log2(np.maximum(c, 1)) * 2**20).astype(np.int64)
    gain = np.diff(clogc, prepend=0)
    ahead, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)
    for d in range(1, window):
        same = (data[d:] == data[:-d]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    total = np.empty(n - window + 1, np.int64)
    total[0] = clogc[np.bincount(data[:window])].sum()
    total[1:] = total[0] + np.cumsum(gain[behind[window:]] - gain[ahead[: n - window]])
    return (clogc[window] - total) * CLASSES // clogc[window]


def _scaled(data: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each scale: window, the bytes and sizes of its texts (others have size 0), where its windows begin, and in which text."""
    for window, least, below in SCALES:
        own = (sizes >= max(least, 1)) & (sizes < below)
        bytes_ = data if own.all() else data[np.repeat(own, sizes)]
        own_sizes = np.where(own, sizes, 0)
        windows = np.maximum(own_sizes - window + 1, 0)
        text = np.repeat(np.arange(len(sizes)), windows)
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        yield window, bytes_, own_sizes, (np.cumsum(own_sizes) - own_sizes)[text] + inside, text


def features(data: np.ndarray, sizes: np.ndarray, ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the improbable windows of texts that stand one after another in ``data``, each once a text.

    Of as many windows in a row as a window has bytes, the rarest, the first among equals, gets a vote; those with a
    quarter of the votes that they may get are features. A text's ends count as if nothing stood beyond, so every text
    has one at least. A text shorter than a window is one feature by itself, filled up with zeros; an empty one has none.
    """
    hashed, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for (window, bytes_, own, at, text), rank in zip(_scaled(data, sizes), ranks, strict=True):
        if len(at):
            gap = window - 1
            place = np.arange(len(at)) + gap * (1 + np.concatenate([[0], np.cumsum(np.diff(text) > 0)]))
            votes = np.full(place[-1] + 1 + gap, NOWHERE)
            votes[place] = rank[entropy_classes(bytes_, window)[at]] << 40 | np.arange(len(at))
            for s in (1 << k for k in range(window.bit_length() - 1)):
                votes = np.minimum(votes[:-s], votes[s:])
            chosen = np.flatnonzero(np.bincount(votes[votes != NOWHERE] & (1 << 40) - 1, minlength=len(at)) >= window // 4)
            hashed.append(_hash(np.lib.stride_tricks.sliding_window_view(bytes_, window)[at[chosen]]))
            owner.append(text[chosen])
        short = np.flatnonzero((own > 0) & (own < window))
        if len(short):
            filled, starts = np.zeros((len(short), window), np.uint8), np.cumsum(own) - own
            for row, t in zip(filled, short, strict=True):
                row[: own[t]] = bytes_[starts[t] : starts[t] + own[t]]
            hashed.append(_hash(filled))
            owner.append(short)
    hashed, owner = np.concatenate(hashed), np.concatenate(owner)
    order = np.lexsort((hashed, owner))  # stable: repeats stay in order
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashed[order][1:] != hashed[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    keep = np.sort(order[fresh])
    keep = keep[np.argsort(owner[keep], kind="stable")]
    return owner[keep], hashed[keep]


def _hash(windows: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of bytes."""
    out = np.full(len(windows), windows.shape[1], np.uint64)
    for word in np.ascontiguousarray(windows).view("<u8").T:
        out = (out ^ word) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and how many each has."""
    flat = texts.cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    buffer = flat.buffers()[2]
    return np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.empty(0, np.uint8), np.diff(offsets)


def fingerprint(texts: pa.Array, ranks: list[np.ndarray]) -> list[str]:
    """``features:filters`` of each text: how many features it has, then its filters of BITS bits in base64, in order;
    each but the last holds FEATURES of them."""
    owner, hashed = features(*_bytes(texts), ranks)
    counts = np.bincount(owner, minlength=len(texts))
    filters = -(-counts // FEATURES)
    first = np.cumsum(filters) - filters
    into = first[owner] + (np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]) // FEATURES
    bits = np.zeros((filters.sum(), BITS), bool)
    for k in range(SETS):
        bits[into, (hashed >> np.uint64(11 * k)) % np.uint64(BITS)] = True
    packed = np.packbits(bits, axis=1)
    return [f"{n}:{base64.b64encode(packed[a : a + f].tobytes()).decode()}" for n, a, f in zip(counts, first, filters, strict=True)]


def _opened(print_: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of each filter, its bits)."""
    n, packed = print_.split(":")
    bits = np.unpackbits(np.frombuffer(base64.b64decode(packed), np.uint8)).reshape(-1, BITS)
    return np.minimum(int(n) - FEATURES * np.arange(len(bits)), FEATURES), bits.astype(np.float32)


def likeness(a: str, b: str) -> float:
    """Shared features as a share of both texts' features, from their filters' bits: 1 for equal fingerprints, 0 where nothing is shared.

    Two filters' common bits beyond what chance gives, normalised by the most that there can be, say how many features
    of the smaller are in the larger. Overlaps within four deviations of chance count as nothing; a filter shares at
    most what it holds, so that chains cut at other places still meet.
    """
    if a == b:
        return 1.0
    (n_a, a), (n_b, b) = _opened(a), _opened(b)  # noqa: PLW2901
    if not len(n_a) or not len(n_b):
        return 0.0
    set_b, in_a, in_b, step = b.sum(1), 0.0, np.zeros(len(n_b)), 1024
    for s in range(0, len(n_a), step):  # the table of overlaps is never whole for long texts
        part, n = a[s : s + step], n_a[s : s + step]
        set_a, both = part.sum(1)[:, None], part @ b.T
        chance = set_a * set_b / BITS
        spread = np.sqrt(chance * (1 - set_a / BITS) * (1 - set_b / BITS))
        most = np.minimum(set_a, set_b)
        share = np.where(both - chance > 4 * spread, (both - chance) / np.maximum(most - chance, 1e-9), 0)
        shared = np.clip(share, 0, 1) * np.minimum(n[:, None], n_b)
        in_a += np.minimum(shared.sum(1), n).sum()
        in_b += shared.sum(0)
    return float((in_a + np.minimum(in_b, n_b).sum()) / (n_a.sum() + n_b.sum()))


def rarity(df: DataFrame, text_col: str = "text") -> list[list[int]]:
    """For each scale the rank of each entropy class by how few windows of all texts have it: 0 the rarest, ties to lower classes.

    Counts are made in every task and added up in Spark; at most CLASSES + 1 a scale come to the driver, whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SCALES), CLASSES + 1), np.int64)
        for batch in batches:
            for part in slices(batch, SLICE):
                for of, (window, bytes_, _, at, _) in zip(total, _scaled(*_bytes(part.column(0))), strict=True):
                    if len(at):
                        of += np.bincount(entropy_classes(bytes_, window)[at], minlength=CLASSES + 1)
        scale, kind = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (scale, kind, total[scale, kind])], names=["scale", "class", "n"])

    small_batches(df.sparkSession)
    texts = df.select(F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = {(r[0], r[1]): r[2] for r in texts.mapInArrow(count, "scale long, class long, n long").groupBy("scale", "class").agg(F.sum("n")).collect()}
    out = []
    for scale in range(len(SCALES)):
        order = sorted(range(CLASSES + 1), key=lambda c: (counts.get((scale, c), 0), c))  # noqa: B023
        out.append(np.argsort(order).tolist())
    return out


def _print_udf(ranks: list[list[int]]):
    table = [np.array(r, np.int64) for r in ranks]

    @F.arrow_udf("string")
    def prints(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        return pa.array([x for part in slices(batch, SLICE) for x in fingerprint(part.column(0), table)], pa.string())

    return prints


def fingerprinted(df: DataFrame, ranks: list[list[int]], text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add each text's fingerprint; all other columns stay. Null text: as the empty one, ``0:``. Equal texts have equal
    fingerprints under equal ``ranks``, which belong to the fingerprints and are kept with them. A text is read whole,
    in one task; a task holds the arrays of one slice of about 256 KB, or of one longer text."""
    small_batches(df.sparkSession)
    return df.withColumn(out, _print_udf(ranks)(F.coalesce(col(text_col).cast("string"), F.lit(""))))


def successors(df: DataFrame, id_col: str = "id", digest_col: str = "digest") -> DataFrame:
    """For each id the one that comes next by descending id, nulls last, after the last the first: id, digest (of the row
    that stands for it), n (its rows), for_id (whom it follows) and wraps (whether it is the first, which follows the last).

    Rows that share an id are one place in the order, for which the one with the least digest stands. Ids are sorted
    over all tasks and numbered by the counts of the sorted parts, which alone reach the driver.
    """
    ids = df.groupBy(F.col(id_col).alias("id")).agg(F.min(digest_col).alias("digest"), F.count(F.lit(1)).alias("n"))
    ordered = staged(ids.orderBy(F.desc_nulls_last("id")).withColumn("pos", F.monotonically_increasing_id()), "ids").withColumn("part", F.shiftright("pos", 33))
    sizes = sorted(tuple(r) for r in ordered.groupBy("part").count().collect())
    starts = [sum(n for _, n in sizes[:i]) for i in range(len(sizes))]
    offsets = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts, strict=True)] or [(0, 0)], "part long, start long")
    total = max(1, sum(n for _, n in sizes))
    # one row a sorted part, whatever the input
    numbered = ordered.join(F.broadcast(offsets), "part").withColumn("row", F.col("start") + F.col("pos").bitwiseAND((1 << 33) - 1))
    follows = numbered.select(((F.col("row") + 1) % total).alias("row"), F.col("id").alias("for_id"))
    return numbered.select("row", "id", "digest", "n").join(follows, "row").select("id", "digest", "n", "for_id", (F.col("row") == 0).alias("wraps"))


PRINTS = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _in_order(ranks: list[list[int]]):
    """Rows sorted against the order of documents, so that a document's successor has passed by before it: only one
    successor is held, however many rows share an id."""
    table = [np.array(r, np.int64) for r in ranks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, last, following = None, None, None  # (bucket, leads, id), its last row, the successor: each row as (text, fingerprint)
        for batch in batches:
            for part in slices(batch, SLICE):
                texts = part.column("text")
                plain, own = texts.to_pylist(), fingerprint(texts, table)
                rows = []
                for i, (bucket, leads, ident, ghost) in enumerate(zip(*(part.column(c).to_pylist() for c in ("bucket", "leads", "id", "ghost")), strict=True)):
                    if place is None or (bucket, leads, ident) != place:
                        following = last if place is not None and bucket == place[0] else None
                        place = bucket, leads, ident
                    last = plain[i], own[i]
                    if not ghost:
                        text, n = plain[i], len(plain[i])
                        rows.append((ident, i, text[: n - n // 3] + following[0][: n // 3], following[1]))
                if not rows:
                    continue
                edited = pa.array([r[2] for r in rows], pa.string())
                after = fingerprint(edited, table)
                out = [
                    [r[0] for r in rows], [len(plain[r[1]]) for r in rows], [hashlib.sha256(r[2].encode()).hexdigest() for r in rows], [own[r[1]] for r in rows], after,
                    [likeness(own[r[1]], e) for r, e in zip(rows, after, strict=True)], [likeness(own[r[1]], r[3]) for r in rows],
                ]
                names, types = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"], [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)

    return run


def document_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: list[list[int]] | None = None, large: int = 10_000) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like both and the next document are to it.

    Edited: the last third of a text's code points (floor) replaced by the first as many of the next document's, by
    descending id. Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, one
    row for each input row. ``ranks`` (``rarity``) are counted over all texts unless given.
    Texts are shuffled once, into ranges of ids; a row that comes next in another range is copied into this one. An
    id with more than ``large`` rows, and more than two ranges' share, is dealt over ranges of its own, each with its
    successor. Four ranges a shuffle partition; their bounds, and the copied rows' keys (at most a few a range), are
    all that the driver and the broadcasts hold.
    Null text: empty; null id: after all others; rows of one id are one place (``successors``); a single document is
    its own next. Repeated rows are repeated. Very long texts: whole, see ``fingerprinted``. Empty table: no rows.
    """
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    ranks = rarity(docs) if ranks is None else ranks
    docs = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    order = staged(successors(docs.select("id", "digest")), "order")
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total, bounds = docs.agg(F.count(F.lit(1)), F.percentile_approx("id", [i / ranges for i in range(1, ranges)])).first()
    bounds = F.array(*[F.lit(b) for b in sorted(set(bounds or []), reverse=True)]).cast("array<long>")
    range_of = lambda c: F.when(c.isNull(), ranges).otherwise(F.size(F.filter(bounds, lambda b: b > c))).cast("long")
    share = max(large, 2 * total // ranges)
    hot = order.filter(F.col("n") > share).select("id", F.ceil(F.col("n") / share).alias("deals"), (F.lit(ranges + 1) + F.col("id").isNull().cast("long") + F.dense_rank().over(Window.orderBy("id")) * (1 << 20)).alias("base"))
    hot = staged(hot, "hot-ids")  # each has more than a range's rows, so there are fewer than ranges
    # copies of rows that come next elsewhere: (id, digest) -> range, and whether the row leads it
    led = meet(order.select("id", "digest", F.col("for_id"), "wraps"), F.broadcast(hot.withColumnRenamed("id", "for_id")), ["for_id"], "left")
    own = led.filter(F.col("deals").isNull() & (F.col("wraps") | (range_of(F.col("id")) != range_of(F.col("for_id"))))).select("id", "digest", range_of(F.col("for_id")).alias("bucket"), F.lit(True).alias("leads"))
    dealt = led.filter(F.col("deals").isNotNull()).select("id", "digest", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1), lambda i: F.col("base") + i)).alias("bucket"), F.lit(True).alias("leads"))
    stand = meet(order, F.broadcast(hot.select("id")), ["id"], "left_semi").select("id", "digest", range_of(F.col("id")).alias("bucket"), F.lit(False).alias("leads"))
    copies = staged(own.unionByName(dealt).unionByName(stand), "copied-keys")
    ghosts = meet(docs, F.broadcast(copies), ["id", "digest"]).withColumn("ghost", F.lit(True))
    salt = F.pmod(F.xxhash64("digest", F.monotonically_increasing_id()), F.col("deals"))
    rows = meet(docs, F.broadcast(hot), ["id"], "left").withColumn("bucket", F.coalesce(F.col("base") + salt, range_of(F.col("id")))).select("id", "text", "digest", "bucket", F.lit(False).alias("leads"), F.lit(False).alias("ghost"))
    dealt_out = rows.unionByName(ghosts).repartition("bucket").sortWithinPartitions("bucket", F.desc("leads"), F.asc_nulls_first("id"), F.desc("digest"))
    return dealt_out.select("bucket", "leads", "id", "ghost", "text").mapInArrow(_in_order(ranks), PRINTS).withColumnRenamed("id", id_col)


def op13_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Query: all documents."""
    return document_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
