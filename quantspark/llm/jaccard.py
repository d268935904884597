"""Operator 5: exact Jaccard join of shingle sets with adaptive multi-match prefixes, as components of linked documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col, slices, small_batches, staged
from quantspark.llm.components import components
from quantspark.llm.hashstore import bucket_count, by_bucket

#: Hashes of shingles have so many bits; the five above them hold the frequency class, so that a token sorts by both.
BITS = 59
#: Frequencies are estimated in 2 ** SKETCH counters, whatever the input; they order tokens and choose prefixes only.
SKETCH = 20
#: Longest multi-match scheme: so many shared prefix tokens may be required.
MATCHES = 4
#: A table of ids of at most so many rows (8 bytes each) is broadcast; a larger one is joined by shuffling.
BROADCAST_ROWS = 500_000
#: Sizes are banded by this ratio where open tokens are joined, so that only bands of possible partners meet.
BAND = 1.05


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; the whole text as one where it has fewer words."""
    split = [t.lower().split() for t in texts]  # on bytes: A-Z, and the six ASCII blanks
    sizes = [len(w) for w in split]
    flat = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, sum(sizes))
    mixed = flat.copy() * np.uint64(0x9E3779B97F4A7C15)
    for i in range(1, k):
        mixed[: len(flat) - i] = (mixed[: len(flat) - i] ^ (mixed[: len(flat) - i] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + flat[i:]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    mixed = (mixed ^ (mixed >> np.uint64(29))) & np.uint64((1 << BITS) - 1)
    out, at = [], 0
    for w, n in zip(split, sizes, strict=True):
        if n >= k:
            out.append(np.unique(mixed[at : at + n - k + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) & ((1 << BITS) - 1)] if n else [], np.uint64))
        at += n
    return out


def _class_of(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def signature(s: np.ndarray) -> bytes:
    """Parity of how many of the set's hashes fall into each of 2 n slots or more (a power of two, from 64)."""
    slots = 1 << max(6, (2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """What two sets differ in at least: each slot of odd difference holds a hash that only one of them has."""
    x, y = (np.frombuffer(v, np.uint64) for v in sorted((a, b), key=len))
    while len(y) > len(x):  # slots are hashes modulo their number, so halves add up
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def required(n: int, percent: int) -> int:
    """Least overlap with any set that a set of n can be similar to."""
    return (percent * n + 99) // 100


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).cast("binary").alias("text"))


def _classes(rows: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """id, n, class and signature of every row (rows with equal sets share a class), and the counters of shingle frequencies."""
    kind = rows.schema["id"].dataType.simpleString()
    part = 1 << 14

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "class", "bits", "part", "counts"]
        counters = np.zeros(1 << SKETCH, np.uint32)
        id_type = None
        for whole in batches:
            id_type = whole.schema.field("id").type
            for batch in slices(whole):
                sets = shingle_sets(batch.column("text").to_pylist(), k)
                joined = np.concatenate([np.empty(0, np.uint64), *sets])
                counters += np.bincount((joined >> np.uint64(BITS - SKETCH)).astype(np.int64), minlength=1 << SKETCH).astype(np.uint32)
                n = len(sets)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(_class_of, sets), pa.int64()), pa.array(map(signature, sets), pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        if id_type is not None and counters.any():
            parts = range((1 << SKETCH) // part)
            cells = [np.minimum(counters[i * part : (i + 1) * part], 65535).astype(np.uint16).tobytes() for i in parts]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(parts), id_type), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.binary()), pa.array(parts, pa.int32()), pa.array(cells, pa.binary())], names=names)

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.uint16).astype(np.uint64) for x in table.column("counts").to_pylist()], axis=0)
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.astype(np.uint64).tobytes()], pa.binary())})

    found = staged(rows.mapInArrow(run, f"id {kind}, n long, class long, bits binary, part int, counts binary"), "classes")
    sketch = np.zeros(1 << SKETCH, np.uint64)
    for r in found.filter("part IS NOT NULL").select("part", "counts").groupBy("part").applyInArrow(add, "part int, counts binary").collect():  # 8 MB, whatever the input
        sketch[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(r["counts"], np.uint64)
    return found.filter("part IS NULL").select("id", "n", "class", "bits"), sketch


def frequency_classes(sketch: np.ndarray) -> np.ndarray:
    """0 for counters near the mean (what stray shingles leave anywhere), then one more for each doubling beyond."""
    mean = sketch.mean() + 3 * sketch.mean() ** 0.5 + 1
    return np.clip(np.ceil(np.log2(np.maximum(sketch / mean, 1))), 0, 31).astype(np.uint8)


def prefix(s: np.ndarray, classes: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The document's prefix tokens and how many of them a candidate must share.

    Tokens are ordered by frequency class, then hash: rare ones first. With the plain prefix (one more token than may
    be missing) one shared token makes a candidate. Each further token lets one more be required. The cost of each
    scheme is the lists that would be read plus the candidates that would be verified: list lengths by the frequency
    classes, divided by the matches required. Only lists count in which partners of the same size would be met, see
    ``_may_be_early``. A document with rare tokens keeps the plain prefix.
    """
    tokens = s | classes[(s >> np.uint64(BITS - SKETCH)).astype(np.int64)].astype(np.uint64) << np.uint64(BITS)
    shortest = len(s) - required(len(s), percent) + 1
    longest = min(len(s), shortest + MATCHES - 1)
    tokens = np.sort(np.partition(tokens, longest - 1)[:longest]) if longest < len(s) else np.sort(tokens)
    lists = np.cumsum(2.0 ** (tokens >> np.uint64(BITS)).astype(np.float64) - 1)
    schemes = np.arange(1, longest - shortest + 2)
    early = len(s) - -(-2 * percent * len(s) // (100 + percent))  # tokens that an equally large similar set may lack
    reads = lists[np.minimum(early + schemes, longest) - 1]
    best = int(np.argmin(reads + 8 * reads / schemes)) + 1
    return tokens[: shortest + best - 1], best


def _shared_tokens(rows: DataFrame, sketch: np.ndarray, k: int, percent: int) -> DataFrame:
    """token, class, n, need, pos, nth, df, weight: prefix tokens that stand in several classes.

    pos is the token's place in the class's order, nth its number among the class's shared tokens, weight the class's
    sum of list lengths df.

    Each Arrow batch sends its tokens as one packed cell for each range of tokens, copies of a set once; a range's task
    keeps those that at least two classes share.
    """
    spark = rows.sparkSession
    nb, classes = bucket_count(spark), spark.sparkContext.broadcast(frequency_classes(sketch))  # 1 MB, whatever the input
    spread = np.uint64(0x9E3779B97F4A7C15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for whole in batches:
            for batch in slices(whole):
                found: list[tuple] = []
                for s in shingle_sets(batch.column("text").to_pylist(), k):
                    if len(s) and (c := _class_of(s)) not in sent:
                        if len(sent) < 200_000:  # only saves work: later copies go again and are dropped there
                            sent.add(c)
                        tokens, need = prefix(s, classes.value, percent)
                        found.append((tokens, c, len(s), need))
                if not found:
                    continue
                sizes = [len(t) for t, *_ in found]
                tokens = np.concatenate([t for t, *_ in found])
                key = tokens * spread  # the range must not follow the frequency
                order = np.argsort(key, kind="stable")
                columns = [tokens[order], *(np.repeat(np.array([f[i] for f in found], kind), sizes)[order] for i, kind in ((1, np.int64), (2, np.uint32), (3, np.uint8)))]
                columns.append(np.concatenate([np.arange(n, dtype=np.uint32) for n in sizes])[order])
                out = [(b, *(c[at].tobytes() for c in columns)) for b, at in by_bucket(key[order], nb)]
                cells = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cells[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cells[1:])], names=["bucket", "token", "class", "n", "need", "pos"])

    def keep(table: pa.Table) -> pa.Table:
        kinds = {"token": np.uint64, "class": np.int64, "n": np.uint32, "need": np.uint8, "pos": np.uint32}
        found = {c: np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in kinds.items()}
        order = np.lexsort((found["class"], found["token"]))
        token, of = found["token"][order], found["class"][order]
        order = order[np.concatenate([[True], (token[1:] != token[:-1]) | (of[1:] != of[:-1])])]
        token, back, df = np.unique(found["token"][order], return_inverse=True, return_counts=True)
        several = df[back] > 1
        columns = {c: v[order].view(np.int64) if c == "token" else v[order].astype(np.int64) for c, v in found.items()} | {"df": df[back].astype(np.int64)}
        return pa.table({name: pa.array(c[several], pa.int64()) for name, c in columns.items()})

    of_class = Window.partitionBy("class")  # at most a prefix
    sent = rows.select("text").mapInArrow(run, "bucket int, token binary, class binary, n binary, need binary, pos binary")
    return staged(sent.groupBy("bucket").applyInArrow(keep, "token long, class long, n long, need long, pos long, df long").withColumns({"nth": F.row_number().over(of_class.orderBy("pos")).cast("long"), "weight": F.sum("df").over(of_class)}), "shared-tokens")


def _sets(rows: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """class, items (sorted hashes as bytes) of the ``wanted`` classes, from one document of each (rows without an id: all)."""
    ids = staged(classes.join(wanted, "class", "left_semi").select("id").dropna(), "wanted")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sets = shingle_sets(batch.column("text").to_pylist(), k)
                yield pa.RecordBatch.from_arrays([pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "items"])

    made = rows.join(ids, "id", "left_semi").unionByName(rows.filter("id IS NULL")).select("text").mapInArrow(run, "class long, items binary")
    return staged(made.join(wanted, "class", "left_semi").dropDuplicates(["class"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: whole sets are compared."""
    left, right = (sets.select(F.col("class").alias(x), F.col("items").alias(f"items_{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            ok = []
            for x, y in zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return staged(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long"), "links")


def _possible(classes: DataFrame, pairs: DataFrame, wanted: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can be similar by their signatures, a twentieth of the size of their sets."""
    bits = staged(classes.join(wanted, "class", "left_semi").select("class", "n", "bits"), "signatures")
    left, right = (bits.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            both = np.array([batch.column(c).to_numpy() for c in ("n_a", "n_b")]).sum(0)
            differ = np.fromiter(map(least_difference, batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()), np.int64, batch.num_rows)
            yield batch.select(["a", "b"]).filter(pa.array((100 + percent) * ((both - differ) // 2) >= percent * both))

    return staged(pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long"), "possible")


def _verified(rows: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The similar ones of candidate pairs (a, b): by signatures first, then by whole sets, made for their classes alone."""
    members = lambda p: p.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    pairs = staged(pairs.select("a", "b"), "candidates")
    if not pairs.isEmpty():
        pairs = _possible(classes, pairs, members(pairs), percent)
    if pairs.isEmpty():
        return pairs
    return _linked(pairs, _sets(rows, classes, members(pairs), k), percent)


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _overlap(a: str, b: str, percent: int) -> Column:
    """Least overlap of two similar sets, from the names of their sizes."""
    return F.expr(f"({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent}")


def _may_be_early(percent: int) -> Column:
    """Whether a shared token can be one of the first that a similar pair (suffixes _a, _b) must share.

    Of at least ``overlap`` common tokens the j-th has at least overlap - j after it, in both orders. With m matches
    required, j is at most m and at most the token's number among the shared ones; a token that stands later in either
    order isn't among the first m. So a class whose rare tokens are its own meets only partners that are small enough
    to do without them.
    """
    need = F.least("need_a", "need_b")
    late = lambda x: F.col(f"n_{x}") - F.col(f"pos_{x}") + F.least(need, f"nth_{x}") - 1 < _overlap("n_a", "n_b", percent)
    return _similar_sizes("n_a", "n_b", percent) & ~late("a") & ~late("b")


def _band(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(BAND))).cast("int")


def _partners(percent: int) -> tuple[Column, Column]:
    """Smallest and largest size of a partner for which the class's token (n, need, pos, nth) may be early."""
    least = F.expr(f"({percent} * n + 99) div 100")
    most = F.least(F.expr(f"100 * n div {percent}"), F.expr(f"({100 + percent} * (n - pos + least(need, nth) - 1)) div {percent}") - F.col("n"))
    return least, most


def jaccard_components(df: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (smallest linked id) and class of every row.

    Two rows link when 100 * |intersection| >= percent * |union| of their sets of k-word shingles.

    1. Rows with equal sets are one class, so that copies never become pairs.
    2. Every class sends its adaptive prefix; tokens of two or more classes stay. If two sets are similar, the first m
       common tokens stand in both m-match prefixes, at places that their sizes bound, so no link is lost.
    3. Most near copies are found by comparing each class with one leader, the most connected class of its tokens. What
       is linked then is connected already and needs no more pairs: so a large group costs as many comparisons as it
       has members.
       Signatures rule most dissimilar pairs out before any whole set is compared.
    4. All remaining candidates, pairs of classes that aren't connected yet, are verified. Each of them has a member
       outside its token's largest component; only those members are joined with the token's list, and there only
       with the bands of sizes at which the token may still be among the first that both must share. A pair is
       verified if it shares as many such tokens as the easier of both schemes requires, and if those and what is left
       after the last of them can make up the overlap.

    Null or blank texts: an empty set, linked with nothing. Null ids: rows like any other, but never a component's id
    (null if all its ids are null). Repeated ids and rows link like other rows. Empty table: no rows. Other columns are
    not read. Ties: none, all comparisons are exact integers.
    """
    small_batches(df.sparkSession)
    rows = _texts(df, id_col, text_col)
    found, sketch = _classes(rows, k)
    # copies meet before the shuffle
    classes = staged(found.filter("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "distinct-sets")
    shared = _shared_tokens(rows, sketch, k, percent)

    # one leader for each class: of the most connected classes of its tokens, the one that most tokens point to
    sides = lambda df, x: df.select("token", *(F.col(c).alias(f"{c}_{x}") for c in df.columns if c != "token"))
    lead = shared.groupBy("token").agg(F.max(F.struct("weight", "class", "n", "need", "pos", "nth")).alias("lead")).select("token", "lead.*")
    met = sides(shared, "a").join(sides(lead, "b"), "token").filter((F.col("class_a") != F.col("class_b")) & _may_be_early(percent))
    votes = met.groupBy("class_a", "class_b").agg(F.count(F.lit(1)).alias("votes"))
    stars = votes.groupBy("class_a").agg(F.max(F.struct("votes", "class_b")).alias("best")).select(F.least("class_a", "best.class_b").alias("a"), F.greatest("class_a", "best.class_b").alias("b")).distinct()
    links = _verified(rows, classes, stars, k, percent)
    joined = components(links)

    # what is left: candidates in different components
    least, most = _partners(percent)
    at = shared.filter(least <= most).join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    counts = at.groupBy("token", "component").agg(F.count(F.lit(1)).alias("members"))
    tops = counts.groupBy("token").agg(F.count(F.lit(1)).alias("several"), F.max(F.struct("members", "component")).alias("top")).filter("several > 1").select("token", F.col("top.component").alias("top"))
    open_ = staged(at.join(tops, "token").select("token", "class", "n", "need", "pos", "nth", "component", "top"), "open-tokens")
    left = sides(open_.filter("component <> top").withColumn("band", F.explode(F.sequence(_band(least), _band(most)))), "a")
    right = sides(open_.withColumn("band", _band(F.col("n"))), "b").drop("top_b")
    once = (F.col("component_b") == F.col("top_a")) | (F.col("class_a") < F.col("class_b"))
    met = left.withColumnRenamed("band_a", "band").join(right.withColumnRenamed("band_b", "band"), ["token", "band"]).filter((F.col("component_a") != F.col("component_b")) & once & _may_be_early(percent))
    ends = [F.struct(*(F.col(f"{c}_{x}").alias(c) for c in ("class", "n", "need", "pos"))) for x in "ab"]
    pair = met.select(F.least(*ends).alias("x"), F.greatest(*ends).alias("y"))  # by class
    flat = pair.select(*(F.col(f"{e}.{c}").alias(f"{c}_{s}") for e, s in (("x", "a"), ("y", "b")) for c in ("class", "n", "need", "pos")))
    rest = flat.groupBy(F.col("class_a").alias("a"), F.col("class_b").alias("b"), "n_a", "n_b", F.least("need_a", "need_b").alias("need")).agg(F.count(F.lit(1)).alias("met"), F.max("pos_a").alias("last_a"), F.max("pos_b").alias("last_b"))
    after = F.least(F.col("n_a") - F.col("last_a"), F.col("n_b") - F.col("last_b")) - 1
    rest = rest.filter((F.col("met") >= F.col("need")) & (F.col("met") + after >= _overlap("n_a", "n_b", percent)))
    more = _verified(rows, classes, rest, k, percent)

    final = components(links.unionByName(more))
    lowest = final.withColumnRenamed("node", "class").join(classes.select("class", "id"), "class").groupBy("component").agg(F.min("id").alias("lowest"))
    linked = final.join(lowest, "component").select(F.col("node").alias("class"), "lowest")
    own = staged(classes.join(linked, "class", "left").select("class", F.coalesce("lowest", "id").alias("component_id")), "own")
    found = found.select("id", "n", "class")
    out = found.filter("n > 0").join(own, "class").unionByName(found.filter("n = 0").withColumn("component_id", F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "class")


def op5_jaccard_components(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, 4-word shingles, 0.85."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("class")


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> ''] AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_in FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * both_in >= 85 * (x.n + y.n - both_in)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""
