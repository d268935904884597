"""Operator 6: an interpolated modified Kneser-Ney model of any order from 2, counted in Spark and read from mapped files."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import col, mounted, scratch
from quantspark.llm.hashstore import bucket_count, by_bucket, find, load, save

#: No word holds a space, so these are no word's hashes.
END = xxhash.xxh3_64_intdigest(b" end")
#: Bytes of text that are looked up at once where grams above pairs are.
SLICE = 6_000_000


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts one after another, and each text's number of tokens (its end included)."""
    split = [t.lower().split() for t in texts]  # on bytes: A-Z, and the six ASCII blanks
    sizes = np.array([len(w) + 1 for w in split], np.int64)
    hashes = np.full(int(sizes.sum()), END, np.uint64)
    at = 0
    for w in split:
        hashes[at : at + len(w)] = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
        at += len(w) + 1
    return hashes, sizes


def _blob(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows of (bucket, arrays...) as binary cells."""
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32())] + [pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[1:]], names=names)


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _planes(values: np.ndarray) -> np.ndarray:
    """32-bit numbers byte by byte, the high bytes together: mostly zeros, which the shuffle packs."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _unplaned(cell: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(cell, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _few(counts: np.ndarray) -> list[int]:
    """How many were seen once, twice, three and four times, and how many there are."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(counts)]


def _packed(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts up to 254, else 255, and the counts beyond."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small, counts[small == 255].astype(np.uint32)


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Neighbouring texts of about ``SLICE`` bytes; none for no texts."""
    of = (np.cumsum([len(t) for t in texts]) - 1) // SLICE if texts else np.empty(0, np.int64)
    ends = np.flatnonzero(np.diff(of)) + 1
    for a, e in zip([0, *ends], [*ends, len(of)], strict=True) if len(of) else ():
        yield texts[a:e]


@dataclass(frozen=True)
class Level:
    """Grams of ``order`` words: key (context's id << shift | word's id), in order; a gram's id is its place.

    A context is the gram of one word less before the word; the one of begin marks alone has the id after the last.
    Files of bucket b: as of pairs, with the order after the name (gram3-b, seen3-b, many3-b, often3-b).
    """

    order: int
    shift: int
    cuts: tuple[int, ...]  # first context of each bucket
    starts: tuple[int, ...] = ()  # id of each bucket's first gram
    n: int = 0
    discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)

    def name(self, kind: str) -> str:
        return {"gram": "pair"}.get(kind, kind) if self.order == 2 else f"{kind}{self.order}"

    def by_context(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Slices of keys in order that belong to one bucket each."""
        yield from _runs(np.searchsorted(self.cuts, (keys >> np.uint64(self.shift)).astype(np.int64), "right") - 1)


def _runs(of: np.ndarray) -> Iterator[tuple[int, slice]]:
    ends = np.flatnonzero(np.diff(of)) + 1
    for a, e in zip([0, *ends], [*ends, len(of)], strict=True) if len(of) else ():
        yield int(of[a]), slice(int(a), int(e))


@dataclass(frozen=True)
class Model:
    """Where the files are, and what fits in a few numbers.

    Files of bucket b: word-b (hashes in order), count-b, cont-b (distinct words before it), total-b, n1-b, n2-b, n3-b
    (tokens after it, and followers seen once, twice, more often), pair-b (id before << 32 | id, in order), seen-b (pair
    counts up to 254, else 255), many-b and often-b (the pairs and counts beyond). Below the highest order the counts of
    grams are of the distinct words before them.
    """

    folder: str
    buckets: int
    starts: tuple[int, ...]  # id of each bucket's first word
    n_tokens: int
    n_words: int
    n_pairs: int
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    low_mass: float  # what continuation counts leave for words never seen
    levels: tuple[Level, ...] = ()  # pairs and all grams above, where there are any above


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of modified Kneser-Ney from how many n-grams were seen once, twice, three and four times; half a count where those are too few to tell."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(k, max(0.05, k - (k + 1) * y * above / below)) if below else k * 0.5 for k, below, above in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


class Words:
    """Ids by hash, from the mapped files."""

    def __init__(self, folder: str, buckets: int, starts: tuple[int, ...]):
        self.folder, self.buckets, self.starts, self.files = folder, buckets, starts, {}

    def array(self, name: str, b: int, kind: type = np.uint64) -> np.ndarray:
        if (name, b) not in self.files:
            self.files[name, b] = load(self.folder, f"{name}-{b}", kind)
        return self.files[name, b]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Of distinct hashes in order; -1 where unknown."""
        out = np.full(len(hashes), -1, np.int64)
        for b, part in by_bucket(hashes, self.buckets):
            at = find(self.array("word", b), hashes[part])
            out[part] = np.where(at >= 0, at + self.starts[b], -1)
        return out

    def values(self, name: str, ids: np.ndarray) -> np.ndarray:
        """A per-word array at ids in order; 0 where the id is -1."""
        out = np.zeros(len(ids), np.float64)
        of = np.searchsorted(self.starts, ids, "right") - 1
        for b in np.unique(of[ids >= 0]):
            own = (of == b) & (ids >= 0)
            if len(values := self.array(name, int(b))):
                out[own] = values[ids[own] - self.starts[b]]
        return out

    # grams of two words and more

    def places(self, level: Level, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of keys in order; -1 and 0 where unknown."""
        ids, n = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
        for b, part in level.by_context(keys):
            at = find(self.array(level.name("gram"), b), keys[part])
            ids[part] = np.where(at >= 0, at + level.starts[b], -1)
            n[part] = np.where(at >= 0, self.seen(level, b, np.maximum(at, 0)), 0)
        return ids, n

    def gram_ids(self, level: Level, keys: np.ndarray) -> np.ndarray:
        """Ids of keys in any order; -1 where unknown."""
        distinct, back = np.unique(keys, return_inverse=True)
        ids = np.full(len(distinct), -1, np.int64)
        for b, part in level.by_context(distinct):
            at = find(self.array(level.name("gram"), b), distinct[part])
            ids[part] = np.where(at >= 0, at + level.starts[b], -1)
        return ids[back]

    def seen(self, level: Level, b: int, at: np.ndarray) -> np.ndarray:
        """Counts at places of a bucket."""
        small = self.array(level.name("seen"), b, np.uint8)
        if not len(small):
            return np.zeros(len(at))
        n = small[at].astype(np.float64)
        if len(many := np.flatnonzero(n == 255)):
            n[many] = self.array(level.name("often"), b)[find(self.array(level.name("many"), b), self.array(level.name("gram"), b)[at[many]])]
        return n

    def keys_at(self, level: Level, ids: np.ndarray) -> np.ndarray:
        """Keys of ids in order."""
        out = np.empty(len(ids), np.uint64)
        for b, part in _runs(np.searchsorted(level.starts, ids, "right") - 1):
            out[part] = self.array(level.name("gram"), b)[ids[part] - level.starts[b]]
        return out

    def endings(self, levels: tuple[Level, ...], keys: np.ndarray, n_words: int) -> np.ndarray:
        """For keys of the last level, the id of the same gram without its first word."""
        level = levels[-1]
        word = keys & np.uint64((1 << level.shift) - 1)
        if level.order == 2:
            return word.astype(np.int64)
        below = levels[-2]
        contexts, back = np.unique((keys >> np.uint64(level.shift)).astype(np.int64), return_inverse=True)
        own = contexts < below.n
        shorter = np.full(len(contexts), levels[-3].n if len(levels) > 2 else n_words, np.int64)  # of begin marks alone
        shorter[own] = self.endings(levels[:-1], self.keys_at(below, contexts[own]), n_words)
        return self.gram_ids(below, shorter.astype(np.uint64)[back] << np.uint64(below.shift) | word)

    def context_sums(self, level: Level, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of contexts in order: the sum of the counts after them and what their discounts take; 0 where unknown."""
        total, kept = np.zeros(len(contexts)), np.zeros(len(contexts))
        taken = np.array([0.0, *level.discounts])
        for b, part in _runs(np.searchsorted(level.cuts, contexts, "right") - 1):
            keys, own = self.array(level.name("gram"), b), contexts[part].astype(np.uint64)
            first = np.searchsorted(keys, own << np.uint64(level.shift))
            size = np.searchsorted(keys, (own + np.uint64(1)) << np.uint64(level.shift)) - first
            full = np.flatnonzero(size)
            if not len(full):
                continue
            first, size = first[full], size[full]
            start = np.cumsum(size) - size
            n = self.seen(level, b, np.repeat(first - start, size) + np.arange(int(size.sum())))
            total[part.start + full] = np.add.reduceat(n, start)
            kept[part.start + full] = np.add.reduceat(taken[np.minimum(n, 3).astype(np.int64)], start)
        return total, kept


@lru_cache(maxsize=2)
def _words(folder: str, buckets: int, starts: tuple[int, ...]) -> Words:
    return Words(folder, buckets, starts)


def _texts(df: DataFrame, text: Column) -> DataFrame:
    return df.select(F.coalesce(text, F.lit("")).cast("binary").alias("text"))


def train(df: DataFrame, text_col: str = "text", buckets: int | None = None, order: int = 2) -> Model:
    """Count all texts of ``df`` and write the model's files below the shared folder: words, pairs, and grams up to ``order`` words.

    Words and pairs are counted in each Arrow batch first, then dealt by ranges of word hashes, so that a very frequent
    word is one entry for each batch and a bucket's share is that of a shuffle partition. Only a few numbers for each
    bucket reach the driver. Grams above pairs are dealt by ranges of their contexts' ids. A count's shuffle files are
    removed when it is done.
    """
    if order < 2:
        raise ValueError(f"order must be 2 at least, not {order}")
    spark = df.sparkSession
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        model = _pair_model(df, text_col, buckets)
        for k in range(3, order + 1):
            model = _raised(df, text_col, model, k, k == order)
        return model
    finally:
        spark.conf.set(CLEAN, before) if before is not None else spark.conf.unset(CLEAN)


def _pair_model(df: DataFrame, text_col: str, buckets: int | None) -> Model:
    """Of order 2, with the files of words and pairs."""
    spark = df.sparkSession
    folder, nb = mounted(scratch(spark, "bigrams")), buckets or bucket_count(spark)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = np.unique(tokens(batch.column("text").to_pylist())[0], return_counts=True)
            yield _blob([(b, keys[s], counts[s].astype(np.uint32)) for b, s in by_bucket(keys, nb)], ["bucket", "word", "n"])

    def words_in(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        keys, counts = _summed(_joined(table, "word", np.uint64), _joined(table, "n", np.uint32).astype(np.uint64))
        save(folder, f"word-{b}", keys)
        save(folder, f"count-{b}", counts)
        return pa.table({"bucket": pa.array([b], pa.int32()), "n": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64())})

    got = _texts(df, col(text_col)).mapInArrow(words_of, "bucket int, word binary, n binary").groupBy("bucket").applyInArrow(words_in, "bucket int, n long, total long").collect()
    sizes = {r["bucket"]: r["n"] for r in got}
    starts = tuple(int(x) for x in np.cumsum([0] + [sizes.get(b, 0) for b in range(nb - 1)]))
    n_words = sum(sizes.values())
    begin = n_words  # in the last bucket, after its words

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = np.unique(_pairs(_words(folder, nb, starts), batch.column("text").to_pylist(), begin)[0], return_counts=True)
            rows, of = [], np.searchsorted(starts, (keys >> np.uint64(32)).astype(np.int64), "right") - 1
            ends = np.flatnonzero(np.diff(of)) + 1
            for a, e in zip([0, *ends], [*ends, len(of)], strict=True) if len(of) else ():
                before, runs = np.unique((keys[a:e] >> np.uint64(32)).astype(np.uint32), return_counts=True)
                small = np.minimum(counts[a:e], 255).astype(np.uint8)
                rows.append((int(of[a]), before, runs.astype(np.uint32), keys[a:e].astype(np.uint32), small, counts[a:e][small == 255].astype(np.uint32)))
            yield _blob(rows, ["bucket", "before", "runs", "word", "n", "more"])

    def pairs_in(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        before = np.repeat(_joined(table, "before", np.uint32), _joined(table, "runs", np.uint32))
        n = _joined(table, "n", np.uint8).astype(np.uint32)
        n[n == 255] = _joined(table, "more", np.uint32)
        keys, counts = _summed(before.astype(np.uint64) << np.uint64(32) | _joined(table, "word", np.uint32).astype(np.uint64), n)
        del before, n
        save(folder, f"pair-{b}", keys)
        _save_counts(folder, "", b, keys, counts)
        _save_follow(folder, b, keys, counts, starts[b], sizes.get(b, 0) + (b == nb - 1))
        # how many of this bucket's words stand before each word
        words, n_before = np.unique(keys.astype(np.uint32), return_counts=True)
        of = np.searchsorted(starts, words.astype(np.int64), "right") - 1
        ends = np.flatnonzero(np.diff(of)) + 1
        rows = [(int(of[a]), words[a:e], n_before[a:e].astype(np.uint32)) for a, e in zip([0, *ends], [*ends, len(of)], strict=True)]
        few = [b, *_few(counts)]
        return pa.Table.from_batches([_blob([*rows, (-1, np.array(few, np.int64), np.empty(0, np.uint32))], ["bucket", "word", "n"])])

    def before_in(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        if b < 0:
            own = [np.frombuffer(x, np.int64) for x in table.column("word").to_pylist()]
            few = np.concatenate([np.sum(own, axis=0)[1:], np.array([(x[0], x[5]) for x in own]).ravel()]).tolist()  # then each bucket and its pairs
            return pa.table({"pairs": pa.array([True]), "few": pa.array([few], pa.list_(pa.int64()))})
        n = np.bincount(_joined(table, "word", np.uint32).astype(np.int64) - starts[b], _joined(table, "n", np.uint32), sizes.get(b, 0))
        save(folder, f"cont-{b}", n.astype(np.uint32))
        few = [int((n == k).sum()) for k in (1, 2, 3, 4)] + [int((n >= 3).sum())]
        return pa.table({"pairs": pa.array([False]), "few": pa.array([few], pa.list_(pa.int64()))})

    pairs = _texts(df, col(text_col)).mapInArrow(pairs_of, "bucket int, before binary, runs binary, word binary, n binary, more binary")
    words = pairs.groupBy("bucket").applyInArrow(pairs_in, "bucket int, word binary, n binary")
    few = words.groupBy("bucket").applyInArrow(before_in, "pairs boolean, few array<long>").collect()
    found = next((r["few"] for r in few if r["pairs"]), [0] * 5)  # one row at most
    high, of_bucket = found[:5], dict(zip(found[5::2], found[6::2], strict=True))
    low = np.sum([r["few"] for r in few if not r["pairs"]] or [[0] * 5], axis=0).tolist()
    d, e = discounts(high[:4]), discounts(low[:4])
    mass = (e[0] * low[0] + e[1] * low[1] + e[2] * low[4]) / high[4] if high[4] else 1.0
    level = Level(2, 32, starts, _starts(of_bucket, nb), high[4], d)
    return Model(folder, nb, starts, sum(r["total"] for r in got), n_words, high[4], d, e, mass, (level,))


#: Spark's setting that removes shuffle files when a query ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _starts(sizes: dict[int, int], nb: int) -> tuple[int, ...]:
    return tuple(int(x) for x in np.cumsum([0] + [sizes.get(b, 0) for b in range(nb - 1)]))


def _save_counts(folder: str, suffix: str, b: int, keys: np.ndarray, counts: np.ndarray) -> None:
    save(folder, f"seen{suffix}-{b}", np.minimum(counts, 255).astype(np.uint8))
    save(folder, f"many{suffix}-{b}", keys[counts >= 255])
    save(folder, f"often{suffix}-{b}", counts[counts >= 255].astype(np.uint64))


def _save_follow(folder: str, b: int, keys: np.ndarray, counts: np.ndarray, start: int, length: int) -> None:
    """What follows each word of the bucket."""
    at = (keys >> np.uint64(32)).astype(np.int64) - start
    save(folder, f"total-{b}", np.bincount(at, counts, length).astype(np.uint64))
    for k in (1, 2, 3):
        save(folder, f"n{k}-{b}", np.bincount(at[counts == k] if k < 3 else at[counts >= 3], minlength=length).astype(np.uint32))


def _raised(df: DataFrame, text_col: str, model: Model, order: int, last: bool) -> Model:
    """The model with grams of one word more; the counts of the order below become those of distinct words before."""
    spark, folder, nb, below = df.sparkSession, model.folder, model.buckets, model.levels[-1]
    shift = max(1, model.n_words.bit_length())
    if (below.n + 1).bit_length() + shift > 64:
        raise ValueError(f"{below.n} contexts and {model.n_words} words don't fit in one 64-bit key")
    cuts = tuple(b * ((below.n + nb) // nb) for b in range(nb))
    level = Level(order, shift, cuts)

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(folder, nb, model.starts)
        for batch in batches:
            for texts in _slices(batch.column("text").to_pylist()):
                keys, counts = np.unique(_context_keys(words, model, level, texts), return_counts=True)
                rows = []
                for b, s in level.by_context(keys):
                    context = (keys[s] >> np.uint64(shift)).astype(np.int64) - cuts[b]
                    rows.append((b, _planes(np.diff(context, prepend=0)), _planes(keys[s] & np.uint64((1 << shift) - 1)), *_packed(counts[s])))
                yield _blob(rows, ["bucket", "step", "word", "n", "more"])

    def grams_in(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        parts = [(np.cumsum(_unplaned(x).astype(np.uint64)) + np.uint64(cuts[b])) << np.uint64(shift) | _unplaned(w).astype(np.uint64) for x, w in zip(table.column("step").to_pylist(), table.column("word").to_pylist(), strict=True)]
        keys, counts = _summed(np.concatenate(parts), _counts(table))
        save(folder, f"{level.name('gram')}-{b}", keys)
        if last:
            _save_counts(folder, str(order), b, keys, counts)
        return pa.table({"bucket": pa.array([b], pa.int32()), "few": pa.array([_few(counts)], pa.list_(pa.int64()))})

    rows = _texts(df, col(text_col)).mapInArrow(grams_of, "bucket int, step binary, word binary, n binary, more binary")
    got = rows.groupBy("bucket").applyInArrow(grams_in, "bucket int, few array<long>").collect()
    few = np.sum([r["few"] for r in got] or [[0] * 5], axis=0).tolist()
    level = Level(order, shift, cuts, _starts({r["bucket"]: r["few"][4] for r in got}, nb), few[4], discounts(few[:4]))
    levels = (*model.levels, level)

    def endings_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(folder, nb, model.starts)
        for batch in batches:
            for b in batch.column("id").to_pylist():
                ids, counts = np.unique(words.endings(levels, np.asarray(load(folder, f"{level.name('gram')}-{b}")), model.n_words), return_counts=True)
                found = list(_runs(np.searchsorted(below.starts, ids, "right") - 1))
                yield _blob([(k, _planes(np.diff(ids[s] - below.starts[k], prepend=0)), *_packed(counts[s])) for k, s in found], ["bucket", "step", "n", "more"])

    def endings_in(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        keys = np.asarray(load(folder, f"{below.name('gram')}-{b}"))
        at = np.concatenate([np.cumsum(_unplaned(x).astype(np.int64)) for x in table.column("step").to_pylist()])
        counts = np.bincount(at, _counts(table), len(keys)).astype(np.uint64)
        _save_counts(folder, "" if below.order == 2 else str(below.order), b, keys, counts)
        if below.order == 2:
            _save_follow(folder, b, keys, counts, model.starts[b], (model.starts[b + 1] if b + 1 < nb else model.n_words + 1) - model.starts[b])
        return pa.table({"few": pa.array([_few(counts)], pa.list_(pa.int64()))})

    rows = spark.range(0, nb, 1, nb).mapInArrow(endings_of, "bucket int, step binary, n binary, more binary")
    few = np.sum([r["few"] for r in rows.groupBy("bucket").applyInArrow(endings_in, "few array<long>").collect()] or [[0] * 5], axis=0).tolist()
    cut = discounts(few[:4])
    model = replace(model, levels=(*model.levels[:-1], replace(below, discounts=cut), level))
    return replace(model, discounts=cut) if below.order == 2 else model


def _counts(table: pa.Table) -> np.ndarray:
    """Counts of all rows, from the parts of ``_packed``."""
    n = _joined(table, "n", np.uint8).astype(np.uint32)
    n[n == 255] = _joined(table, "more", np.uint32)
    return n


def _contexts(ids: np.ndarray, sizes: np.ndarray, begin: int) -> np.ndarray:
    """Of every token the gram that ends one token before."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    if len(out):
        out[np.cumsum(sizes) - sizes] = begin
    return out


def _context_keys(words: Words, model: Model, level: Level, texts: list[bytes]) -> np.ndarray:
    """The keys of every token's gram at a level above pairs; the words must be known."""
    keys, ids, sizes = _pairs(words, texts, model.n_words)
    for below, above in zip(model.levels, [*model.levels[1:], level], strict=True):
        contexts = _contexts(words.gram_ids(below, keys), sizes, below.n)
        keys = contexts.astype(np.uint64) << np.uint64(above.shift) | ids.astype(np.uint64)
    return keys


def _pairs(words: Words, texts: list[bytes], begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id before << 32 | id) of every token, ids (-1: unknown), and each text's number of tokens."""
    hashes, sizes = tokens(texts)
    distinct, back = np.unique(hashes, return_inverse=True)
    ids = words.ids(distinct)[back]
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(sizes)[:-1]] = begin
    if len(before):
        before[0] = begin
    missing = np.uint64((1 << 32) - 1)
    high, low = (np.where(x >= 0, x, missing).astype(np.uint64) for x in (before, ids))
    return high << np.uint64(32) | low, ids, sizes


def _cut(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """What is left of counts after their discount."""
    return np.maximum(0.0, n - np.choose(np.clip(n, 0, 3).astype(np.int64), [0.0, *d]))


def _score(model: Model, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, base_score and score of each text."""
    words = _words(model.folder, model.buckets, model.starts)
    pairs, ids, sizes = _pairs(words, texts, model.n_words)
    at = np.cumsum(sizes) - sizes
    own, back = np.unique(ids, return_inverse=True)
    counts = words.values("count", own)
    base = np.log10((counts + 1) / (model.n_tokens + model.n_words + 1))
    low = _cut(words.values("cont", own), model.low_discounts) / max(model.n_pairs, 1) + model.low_mass / (model.n_words + 1)

    distinct, pair_back = np.unique(pairs, return_inverse=True)
    before, of_word = (distinct >> np.uint64(32)).astype(np.int64), (distinct & np.uint64((1 << 32) - 1)).astype(np.int64)
    known = before <= model.n_words
    n = np.zeros(len(distinct))
    buckets = np.searchsorted(model.starts, before, "right") - 1
    pair_ids = np.full(len(distinct), -1, np.int64)
    for b in np.unique(buckets[known]).tolist():
        part = np.flatnonzero(known & (buckets == b))
        place = find(words.array("pair", b), distinct[part])
        part, place = part[place >= 0], place[place >= 0]
        pair_ids[part] = place + model.levels[0].starts[b]
        seen = words.array("seen", b, np.uint8)[place].astype(np.float64)
        if len(many := np.flatnonzero(seen == 255)):
            seen[many] = words.array("often", b)[find(words.array("many", b), distinct[part[many]])]
        n[part] = seen
    prior, prior_back = np.unique(np.where(known, before, -1), return_inverse=True)
    total = words.values("total", prior)
    kept = sum(d * words.values(f"n{k}", prior) for k, d in zip((1, 2, 3), model.discounts, strict=True))
    with np.errstate(divide="ignore", invalid="ignore"):
        back_off = np.where(total > 0, kept / total, 1.0)[prior_back]
        direct = np.where(total[prior_back] > 0, _cut(n, model.discounts) / total[prior_back], 0.0)
    low_at = low[np.clip(np.searchsorted(own, np.where(of_word < (1 << 32) - 1, of_word, -1)), 0, len(own) - 1)]
    score = (direct + back_off * low_at)[pair_back]
    grams, word = pair_ids[pair_back], np.where(ids >= 0, ids, model.n_words).astype(np.uint64)  # no gram ends with the begin mark
    for below, level in zip(model.levels, model.levels[1:], strict=False):
        contexts = _contexts(grams, sizes, below.n)
        at_known = np.flatnonzero(contexts >= 0)
        keys, key_back = np.unique(contexts[at_known].astype(np.uint64) << np.uint64(level.shift) | word[at_known], return_inverse=True)
        gram_ids, n = words.places(level, keys)
        own_contexts, of_context = np.unique((keys >> np.uint64(level.shift)).astype(np.int64), return_inverse=True)
        total, kept = (x[of_context] for x in words.context_sums(level, own_contexts))
        some = np.maximum(total, 1)
        direct, back_off = np.where(total > 0, _cut(n, level.discounts) / some, 0.0), np.where(total > 0, kept / some, 1.0)
        score[at_known] = direct[key_back] + back_off[key_back] * score[at_known]
        grams = np.full(len(ids), -1, np.int64)
        grams[at_known] = gram_ids[key_back]
    score = np.log10(score)
    sums = lambda x: np.add.reduceat(x, at) if len(at) else np.empty(0)
    return sizes, sums((ids >= 0).astype(np.int64)), sums(base[back]), sums(score)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score (log10 probability) and perplexity of every text.

    Null and empty texts are one end token. Null and repeated ids and rows are scored like any other. With no training
    text every token is unknown. Empty table: no rows. Other columns are not read.
    """
    rows = df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = [_score(model, t) for t in (_slices(texts) if len(model.levels) > 1 else [texts])] or [_score(model, [])]
            sizes, known, base, value = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(value, pa.float64())],
                names=["id", "n_tokens", "n_known", "base_score", "score"],
            )

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")
    return out.select(
        F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    )


def held_out(id_column: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % mod == rest


def op6_kneser_ney(spark, sf_dir: str) -> DataFrame:
    """Query: all documents by a model of order 3 of those whose crc32 mod 7 isn't 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.filter(~held_out(F.col("doc_id"), 7, 2)), order=3)
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id"), 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
