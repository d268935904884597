"""Operator 4: byte-level BPE. Distinct words are merged by Spark higher-order functions; decoding joins binary pieces."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import col, mounted, scratch, slices, small_batches
from quantspark.llm.hashstore import bucket_count, by_bucket, load, save

VOCABULARY = "byte_bpe_50k.tiktoken"
NONE = 1 << 30
#: Up to so many parts a step of the fold merges one pair; of more, every place of the best pair at once.
SHORT = 64
#: Words that a worker remembers having sent; what is forgotten is sent again.
KEPT = 120_000


@cache
def ranks(vocabulary: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def pieces(vocabulary: str) -> list[bytes]:
    """Bytes of each id."""
    known = ranks(vocabulary)
    out = [b""] * (max(known.values()) + 1)
    for piece, i in known.items():
        out[i] = piece
    return out


#: Two primes, not near a power of two: a pair of ids has one slot by the remainder of each.
SLOTS = (236_069, 261_823)


@cache
def rank_map(vocabulary: str) -> list[int]:
    """Pair of ids -> id (rank) of their merge: (first << 16 | second) << 16 | id at one of the pair's two slots, -1 elsewhere."""
    known = ranks(vocabulary)
    pairs = {known[p[:i]] << 16 | known[p[i:]]: r for p, r in known.items() for i in range(1, len(p)) if p[:i] in known and p[i:] in known}
    slots: list[int] = [-1] * max(SLOTS)
    for key in pairs:
        at = key % SLOTS[0]
        for _ in range(1000):
            key, slots[at] = slots[at], key
            if key < 0:
                break
            at = key % SLOTS[1] if at == key % SLOTS[0] else key % SLOTS[0]
        else:
            raise ValueError("the rank map needs more slots")
    return [k << 16 | pairs[k] if k >= 0 else -1 for k in slots]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merged(word: Column, vocabulary: str = VOCABULARY) -> Column:
    """Ids of one word: a fold of ranked merges over its bytes, with the rank map as a literal.

    The literal stands in the expression once and is bound to a name, as each copy would go to every task.
    """
    known = ranks(vocabulary)
    table = F.from_json(F.lit(json.dumps({"t": rank_map(vocabulary), "b": [known[bytes([b])] for b in range(256)]}, separators=(",", ":"))), "struct<t:array<bigint>,b:array<int>>")
    return _let(table, lambda t: _fold(word, t, len(known) + SHORT))


def _fold(word: Column, table: Column, max_steps: int) -> Column:
    """The state is ids, and the rank of each id with its right neighbour.

    A step merges the leftmost best pair. Among many parts it merges all its places, from the left, so that steps follow
    the distinct merges, not the length. That gives the library's ids where no pair that a merge makes with a neighbour
    ranks before the merged pair and takes a part of another of its places; no word is known where it does with these ranks.
    """
    nothing = F.array().cast("array<bigint>")

    def rank(a: Column, b: Column) -> Column:
        key = a * F.lit(1 << 16).cast("long") + b
        one, two = (F.get(table["t"], (key % F.lit(p).cast("long")).cast("int")) for p in SLOTS)
        there = lambda x: F.shiftright(x, 16) == key
        merge = lambda x: x.bitwiseAND(F.lit(0xFFFF).cast("long"))
        return F.when(there(one), merge(one)).when(there(two), merge(two)).otherwise(F.lit(NONE).cast("long"))

    def state(ids: Column, around: Column) -> Column:
        return F.struct(ids.alias("ids"), around.alias("ranks"))

    def all_ranks(ids: Column) -> Column:
        return F.transform(ids, lambda x, i: rank(x, F.get(ids, i + 1)))

    def put_one(ids: Column, r: Column, best: Column, at: Column) -> Column:
        before = F.when(at > 1, F.array(rank(F.get(ids, at - 2), best))).otherwise(nothing)
        around = F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), before, F.array(rank(best, F.get(ids, at + 1))), F.slice(r, at + 2, F.lit(SHORT)))
        return state(F.concat(F.slice(ids, F.lit(1), at - 1), F.array(best), F.slice(ids, at + 2, F.lit(SHORT))), around)

    def put_all(ids: Column, r: Column, best: Column) -> Column:
        # a run of equal ids is a run of best pairs, of which each second one is taken
        found = F.split(F.replace(F.array_join(F.transform(r, lambda x: F.when(x == best, "1").otherwise("0")), ""), F.lit("11"), F.lit("10")), "")

        def put(marks: Column) -> Column:
            stay = F.filter(F.sequence(F.lit(0), F.size(ids) - 1), lambda i: (i == 0) | (F.get(marks, i - 1) == "0"))
            return _let(F.transform(stay, lambda i: F.when(F.get(marks, i) == "1", best).otherwise(F.get(ids, i))), lambda new: state(new, all_ranks(new)))

        return _let(found, put)

    def step(acc: Column, _: Column) -> Column:
        ids, r = acc["ids"], acc["ranks"]

        def put(best: Column) -> Column:
            one = _let(F.array_position(r, best).cast("int"), lambda at: put_one(ids, r, best, at))
            return F.when(best == NONE, acc).when(F.size(ids) <= SHORT, one).otherwise(put_all(ids, r, best))

        return _let(F.array_min(r), put)

    n = F.octet_length(word)
    single = F.transform(F.split(F.decode(word, "ISO-8859-1"), ""), lambda x: F.get(table["b"], F.ascii(x)).cast("long"))
    single = F.when(n > 0, single).otherwise(nothing)
    start = _let(single, lambda ids: state(ids, all_ranks(ids)))
    # a rank that is merged at all its places doesn't come back, so a very long word needs a step for each rank at most
    steps = F.least(n, F.lit(max_steps))
    return F.aggregate(F.when(n > 1, F.sequence(F.lit(2), steps)).otherwise(F.array().cast("array<int>")), start, step, lambda acc: acc["ids"].cast("array<int>"))


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 1 white space, 2 letter, 3 number, 0 any other, as the expression library of the pattern has it."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, name in enumerate((r"\s", r"\p{L}", r"\p{N}"), 1):
        out[np.frombuffer("".join(regex.findall(name, every)).encode("utf-32-le"), np.uint32)] = kind
    return out


def matches(texts: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """All matches of the pattern in the texts, one after another, and how many of them stand before each text and after the last.

    Every character is in a match, so a match goes on to the start of the next. A match starts with each run of characters of one
    kind, but for three things: a run after a blank starts at the blank, white space before a run leaves its last character
    to another match, and an apostrophe that starts a match takes the letters of a contraction with it.
    """
    texts = texts.cast(pa.string())
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])) if ends[-1] > ends[0] else pa.py_buffer(b"")
    ends -= ends[0]
    raw = np.frombuffer(data, np.uint8)
    if (raw < 0x80).all():
        code, at = raw, None
    else:
        code = np.frombuffer(data.to_pybytes().decode().encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    n = len(code)
    bounds = ends if at is None else np.searchsorted(at, ends)
    kind = _kinds()[code]
    border = np.zeros(n + 4, bool)  # as long as a contraction more, so that those at the end need no other rule
    border[bounds] = border[n:] = True
    start = border.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    after = np.flatnonzero(start[1:n] & ~border[1:n] & (kind[1:] != 1) & (kind[:-1] == 1)) + 1
    start[after - 1] = True
    start[after[code[after - 1] == ord(" ")]] = False
    mark = np.flatnonzero(code == ord("'"))
    mark = mark[start[mark]]
    letters = np.append(code, np.zeros(3, code.dtype))
    for tail in ("s", "t", "re", "ve", "m", "ll", "d"):
        here, size = mark, len(tail)
        for i, letter in enumerate(tail, 1):
            here = here[(letters[here + i] == ord(letter)) & ~border[here + i]]
        start[here + 1] = False
        start[here + 1 + size] = True
    starts = np.flatnonzero(start[: n + 1])
    cells = (starts if at is None else at[starts]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(cells), data]), np.searchsorted(starts, bounds)


def distinct_words(rows: DataFrame) -> DataFrame:
    """word (bytes): every distinct word of the texts, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = pa.array([], pa.binary())  # only saves work: a word that is sent again is dropped by the grouping
        for part in chain.from_iterable(map(slices, batches)):
            words = matches(part.column("text"))[0].dictionary_encode().dictionary
            new = words.filter(pc.invert(pc.is_in(words, value_set=sent)))
            sent = pa.concat_arrays([sent.slice(max(0, len(sent) + len(new) - KEPT)), new])
            yield pa.RecordBatch.from_arrays([new], names=["word"])

    return rows.select("text").mapInArrow(run, "word binary").distinct()


class WordIds:
    """Ids of words from mapped files: hash-b (in order), word-b and ids-b (all one after another), and where each starts."""

    def __init__(self, folder: str, buckets: int):
        self.folder, self.buckets = folder, buckets
        self.files: dict[int, tuple[np.ndarray, pa.Array, pa.Array]] = {}

    def _bucket(self, b: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Hashes, words and ids of a bucket; the arrays stand on the mapped files."""
        if b not in self.files:
            keys = load(self.folder, f"hash-{b}")
            cells = [[pa.py_buffer(load(self.folder, f"{name}-{x}{b}", kind)) for x, kind in (("start-", np.int64), ("", np.uint8))] for name in ("word", "ids")]
            self.files[b] = keys, *(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(keys), [None, *c]) for c in cells)
        return self.files[b]

    def of(self, words: pa.BinaryArray) -> pa.LargeBinaryArray:
        """The ids of each of ``words``, as little-endian 32-bit numbers."""
        _, starts, data = words.buffers()
        whole, starts = memoryview(data or b""), np.frombuffer(starts, np.int32)[words.offset : words.offset + len(words) + 1].tolist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(whole[a:b], 42) for a, b in pairwise(starts)), np.uint64, len(words))
        order = np.argsort(hashes, kind="stable")
        asked, found = words.cast(pa.large_binary()), [pa.array([], pa.large_binary())]
        for b, part in by_bucket(hashes[order], self.buckets):
            keys, stored, ids = self._bucket(b)
            at = order[part]
            place, there = np.searchsorted(keys, hashes[at]), asked.take(pa.array(at))
            open_ = np.arange(len(at))
            while len(open_):  # on while another word with this hash stands here; beyond the last one it is an error
                same = pc.equal(stored.take(pa.array(place[open_])), there.take(pa.array(open_)))
                open_ = open_[~same.to_numpy(zero_copy_only=False)]
                place[open_] += 1
            found.append(ids.take(pa.array(place)))
        return pa.concat_arrays(found).take(pa.array(np.argsort(order)))


@lru_cache(maxsize=1)
def _word_ids(folder: str, buckets: int) -> WordIds:
    return WordIds(folder, buckets)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """id, ids (array of int) of every whole text.

    Each match of the pattern is merged separately. All distinct words are merged once, by the fold; their ids go to the
    shared folder as arrays sorted by hash, with the words beside them, which workers map into memory to look up each
    slice's words.
    Null and empty texts: no ids. Very long texts and words: as any other; a worker holds some arrays as long as one text. Null and
    repeated ids and rows are encoded each. Empty table: no rows. Other columns are not read.
    """
    small_batches(df.sparkSession)
    spark = df.sparkSession
    rows = df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    folder, nb = mounted(scratch(spark, "words")), bucket_count(spark)

    def write(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        hashes = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes, kind="stable")
        save(folder, f"hash-{b}", hashes[order])
        for name, kind in (("word", np.uint8), ("ids", np.int32)):
            cells = table.column(name).combine_chunks().take(pa.array(order))
            sizes = pc.binary_length(cells) if name == "word" else pc.multiply(pc.list_value_length(cells), 4)
            save(folder, f"{name}-start-{b}", np.cumsum([0, *sizes.to_pylist()], dtype=np.int64))
            flat = np.frombuffer(b"".join(cells.to_pylist()), kind) if name == "word" else cells.flatten().to_numpy(zero_copy_only=False).astype(kind)
            save(folder, f"{name}-{b}", flat.view(np.uint8))
        return pa.table({"bucket": pa.array([b], pa.int32()), "n": pa.array([len(hashes)], pa.int64())})

    h = F.xxhash64("word")
    bucket = F.shiftrightunsigned(F.shiftrightunsigned(h, 32) * nb, 32).cast("int")
    words = distinct_words(rows).select(bucket.alias("bucket"), h.alias("hash"), "word", merged(F.col("word"), vocabulary).alias("ids"))
    words.groupBy("bucket").applyInArrow(write, "bucket int, n long").agg(F.sum("n")).collect()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _word_ids(folder, nb)
        for part in chain.from_iterable(map(slices, batches)):
            words, before = matches(part.column("text"))
            coded = words.dictionary_encode()
            _, starts, ids = store.of(coded.dictionary).take(coded.indices).buffers()
            starts = np.frombuffer(starts, np.int64)[before] // 4 if len(words) else before
            ids = pa.array(np.frombuffer(ids or b"", np.int32)[: starts[-1]])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), ids)], names=["id", "ids"])

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")
    return out.select(F.col("id").alias(id_col), "ids")


def decoded(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The bytes that ids stand for, their pieces one after another (as raw bytes of a string, valid UTF-8 or not)."""
    table = F.from_json(F.lit(json.dumps([base64.b64encode(p).decode() for p in pieces(vocabulary)], separators=(",", ":"))), "array<binary>")
    return F.array_join(F.transform(ids, lambda i: F.get(table, i).cast("string")), "").cast("binary")


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, encoded and decoded again."""
    out = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"), F.sha2(decoded(F.col("ids")), 256).alias("decoded_sha256"))
