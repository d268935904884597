"""Operator 11: cheapest repair of conversation structure by Four-Russians block tables.

A repaired conversation's role initials read ``(s?(ua)+)?``. The grammar has four states: 0 nothing yet, 1 after the
system turn, 2 after a user turn, 3 after an assistant turn; 0 and 3 may end. Before a row, the cheapest cost of the
rest is one number a state. Less their least, these vectors are few, so that the effect of a block of ``BLOCK`` rows
on each of them is a table: a conversation is then read block by block by lookup, from its end to its beginning, and
each block is expanded backward once more to write its edits. Tables depend on the costs alone, never on the data.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import col, meet, staged

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
STATES = 4
#: State after a turn of the role that the state asks for, the role that it asks for, and whether it may end.
NEXT, ASKS, ENDS = (2, 2, 3, 2), "uuau", (True, False, False, True)
ROLES = {"u": "user", "a": "assistant"}
#: Symbols: 0-3 whole rows of initial s, u, a, other; 4-7 the same truncated; 8 a row that must go; 9 fills up a block.
MUST_GO, FILL, SYMBOLS, BLOCK = 8, 9, 10, 4
KINDS = "sua"
SPACE = r"\x20\x09-\x0D"


def step(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cheapest cost before a row, for each state, from those after it."""
    if symbol == FILL:
        return after
    best = [DELETE + c for c in after]
    if symbol != MUST_GO:
        for state in range(STATES):
            best[state] = min([best[state], *(c + after[to] for _, c, to, _ in _turns(symbol, state))])
    for _ in range(STATES):
        best = [min(c, INSERT + best[NEXT[s]]) for s, c in enumerate(best)]
    return tuple(best)


def _turns(symbol: int, state: int) -> list[tuple[str, int, int, str]]:
    """Ways to let a row stand in a state: (letter, cost, next state, new role's initial or "")."""
    kind, extra = KINDS[symbol % 4] if symbol % 4 < 3 else "", TRUNCATED * (symbol >= 4)
    if kind == "s" and state == 0:
        return [("K", extra, 1, ""), ("R", REROLE + extra, NEXT[0], "u")]
    if kind == ASKS[state]:
        return [("K", extra, NEXT[state], "")]
    return [("R", REROLE + extra, NEXT[state], ASKS[state])]


def _end() -> tuple[int, ...]:
    cost = [0 if ENDS[s] else 1 << 20 for s in range(STATES)]
    for _ in range(STATES):
        cost = [min(c, INSERT + cost[NEXT[s]]) for s, c in enumerate(cost)]
    return tuple(cost)


class Tables:
    """All normalised cost vectors that can arise, and what each block of symbols makes of each of them."""

    def __init__(self) -> None:
        self.vectors = [_end()]  # the end's least is 0
        number, one = {self.vectors[0]: 0}, []
        for vector in self.vectors:  # grows while it is read
            line = []
            for symbol in range(SYMBOLS):
                before = step(symbol, vector)
                normal = tuple(c - min(before) for c in before)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                line.append(number[normal])
            one.append(line)
        self.trace = functools.cache(self._trace)
        first, n = np.array(one, np.int64).T, len(self.vectors)  # symbol x vector
        # a row in front, with fillers behind it that change nothing: what state it leaves
        leave = np.array([[[self.trace(self.blocks([s])[0], v, q)[1] for q in range(STATES)] for v in range(n)] for s in range(SYMBOLS)])
        before, leaves = np.arange(n)[None, :], np.broadcast_to(np.arange(STATES), (1, n, STATES))
        for _ in range(BLOCK):  # each new symbol stands in front of those that are there
            enters = leave[:, before]  # symbol x block x vector x state: the state before the rest of the block
            leaves = np.take_along_axis(np.broadcast_to(leaves, enters.shape), enters, axis=3).reshape(-1, n, STATES)
            before = first[:, before].reshape(-1, n)
        self.before, self.leaves = before, leaves  # by block and vector after it: the vector before it; by state before it: the state after it

    def _trace(self, block: int, vector: int, state: int) -> tuple[tuple[tuple[str, str, int], ...], int]:
        """A block expanded: for each row its edits' letters, its roles (inserted ones, then its own: "" kept, "-"
        gone) and their cost; and the state after the block. Of the cheapest edits the ASCII-least letters."""
        symbols = [block // SYMBOLS**i % SYMBOLS for i in reversed(range(BLOCK))]
        costs = [self.vectors[vector]]
        for symbol in reversed(symbols):
            costs.append(step(symbol, costs[-1]))
        costs.reverse()
        out = []
        for i, symbol in enumerate(symbols):
            if symbol == FILL:
                continue
            letters, inserted, paid, own = "", "", 0, None
            while own is None:
                here = costs[i][state]
                if DELETE + costs[i + 1][state] == here:
                    letters, paid, own = letters + "D", paid + DELETE, "-"
                elif INSERT + costs[i][NEXT[state]] == here:
                    letters, inserted, paid, state = letters + "I", inserted + ASKS[state], paid + INSERT, NEXT[state]
                else:
                    letter, cost, to, own = next(t for t in _turns(symbol, state) if t[1] + costs[i + 1][t[2]] == here)
                    letters, paid, state = letters + letter, paid + cost, to
            out.append((letters, inserted + "," + own, paid))
        return tuple(out), state

    def blocks(self, symbols: list[int]) -> list[int]:
        full = [*symbols, *[FILL] * (-len(symbols) % BLOCK)]
        return [functools.reduce(lambda n, s: n * SYMBOLS + s, full[i : i + BLOCK], 0) for i in range(0, len(full), BLOCK)]

    def back(self, blocks: list[int], vector: int) -> list[int]:
        """The vectors after each block, by lookup from the last to the first, and before all of them at index 0."""
        out = [vector]
        for block in reversed(blocks):
            out.append(int(self.before[block, out[-1]]))
        out.reverse()
        return out

    def run(self, blocks: list[int], vector: int, state: int) -> Iterator[tuple[str, str, int, int]]:
        """Edits row by row, each with the state after its block: after the last row, the last state."""
        after = self.back(blocks, vector)
        for i, block in enumerate(blocks):
            rows, state = self.trace(block, after[i + 1], state)
            yield from ((*row, state) for row in rows)

    def whole(self, blocks: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """What rows do for any vector after them: the vector before them, and for each state before them the state after."""
        n = len(self.vectors)
        after = [np.arange(n)]
        for block in reversed(blocks):
            after.append(self.before[block, after[-1]])
        state = np.broadcast_to(np.arange(STATES), (n, STATES))
        for block, vector in zip(blocks, reversed(after[:-1]), strict=True):
            state = self.leaves[block, vector[:, None], state]
        return after[-1], state


tables = functools.cache(Tables)


def last_inserts(state: int) -> str:
    """Roles to add at the end of a conversation."""
    out = ""
    while not ENDS[state]:
        out, state = out + ASKS[state], NEXT[state]
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[pa.RecordBatch]]]:
    """Each conversation's rows in one part, as slices of the batches that they came in."""
    key, held = None, []
    for batch in batches:
        conv, part = batch.column("conv"), batch.column("part").to_numpy(zero_copy_only=False)
        null, ids = conv.is_null().to_numpy(zero_copy_only=False), conv.fill_null(0).to_numpy(zero_copy_only=False)
        new = np.flatnonzero((ids[1:] != ids[:-1]) | (null[1:] != null[:-1]) | (part[1:] != part[:-1])) + 1
        for a, b in itertools.pairwise([0, *new.tolist(), batch.num_rows]):
            if a == b:
                continue
            here = int(part[a]), None if null[a] else int(ids[a])
            if held and here != key:
                yield key[1], held
                held = []
            key = here
            held.append(batch.slice(a, b - a))
    if held:
        yield key[1], held


def _symbols(slices: list[pa.RecordBatch]) -> list[int]:
    return [s for x in slices for s in x.column("symbol").to_pylist()]


def _gathered(rows: Iterator[tuple[dict, int]], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows with their weights in batches of about that weight."""
    held, weight = [], 0
    for row, w in rows:
        held.append(row)
        weight += w
        if weight >= most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The effect of each piece on every vector and state."""
    t = tables()
    for conv, slices in _pieces(batches):
        before, leaves = t.whole(t.blocks(_symbols(slices)))
        yield pa.RecordBatch.from_pylist([{"conv": conv, "part": slices[0].column("part")[0].as_py(), "before": before.tolist(), "leaves": leaves.ravel().tolist()}], schema=SUMMARY)


def _joined(pieces: pa.Table) -> pa.Table:
    """Pieces of one conversation, at most one for each part: the vector after each, from the last, and the state before each, from the first."""
    rows, after, vector, state, out = sorted(pieces.to_pylist(), key=itemgetter("part")), [], 0, 0, []
    for r in reversed(rows):
        after.append(vector)
        vector = r["before"][vector]
    for r, vector in zip(rows, reversed(after), strict=True):
        out.append({"conv": r["conv"], "part": r["part"], "after": vector, "enters": state, "last": r is rows[-1]})
        state = r["leaves"][STATES * vector + state]
    return pa.Table.from_pylist(out, schema=JOINED)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits, costs and the rows that stand after them, in chunks of rows of one conversation."""

    def chunks() -> Iterator[tuple[dict, int]]:
        t = tables()
        for conv, slices in _pieces(batches):
            state = slices[0].column("enters")[0].as_py()
            edits = t.run(t.blocks(_symbols(slices)), slices[0].column("after")[0].as_py(), state)
            parts = [x.slice(a, CHUNK) for x in slices for a in range(0, x.num_rows, CHUNK)]
            for part in parts:
                rows = part.to_pylist()
                audit, cost, stand, illegal, turns = [], 0, [], 0, 1 - (rows[0]["turn"] is None)
                for before, r in zip([None, *rows], rows, strict=False):
                    letters, roles, paid, state = next(edits)
                    inserted, own = roles.split(",")
                    audit.append(letters + "D" * (r["n"] - 1))  # repeats must go, which changes no state
                    cost += paid + DELETE * (r["n"] - 1)
                    illegal += r["n"] - 1 + (before is not None and before["role"][:1] + r["role"][:1] not in LEGAL)
                    turns += before is not None and before["turn"] != r["turn"]
                    stand.extend({"pos": r["pos"], "nth": k, "role": ROLES[x]} for k, x in enumerate(inserted))
                    if own != "-":
                        stand.append({"pos": r["pos"], "nth": len(inserted), "role": ROLES.get(own, r["role"]), "turn": r["turn"], "old": r["role"], "digest": r["digest"]})
                if part is parts[-1] and rows[-1]["last"]:
                    tail = last_inserts(state)
                    audit.append("I" * len(tail))
                    cost += INSERT * len(tail)
                    stand.extend({"pos": rows[-1]["pos"], "nth": STATES + k, "role": ROLES[x]} for k, x in enumerate(tail))
                ends = {"first": rows[0]["role"][:1], "final": rows[-1]["role"][:1], "first_turn": rows[0]["turn"], "final_turn": rows[-1]["turn"]}
                yield {"conv": conv, "pos": rows[0]["pos"], "audit": "".join(audit), "cost": cost, "illegal": illegal, "turns": turns, "stand": stand, **ends}, len(rows)

    return _gathered(chunks(), CHUNKS)


SUMMARY = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("before", pa.list_(pa.int32())), ("leaves", pa.list_(pa.int32()))])
JOINED = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("after", pa.int32()), ("enters", pa.int32()), ("last", pa.bool_())])
STAND = pa.struct([("pos", pa.int64()), ("nth", pa.int32()), ("role", pa.string()), ("turn", pa.int64()), ("old", pa.string()), ("digest", pa.binary())])
CHUNKS = pa.schema([
    ("conv", pa.int64()), ("pos", pa.int64()), ("audit", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("turns", pa.int64()), ("stand", pa.list_(STAND)),
    ("first", pa.string()), ("final", pa.string()), ("first_turn", pa.int64()), ("final_turn", pa.int64()),
])
CHUNK = 4096
LEGAL = ("su", "ua", "au")


def repair_conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(audits, repaired rows). Audits: one row a conversation with gaps, blank, duplicate, truncated, illegal, cost and
    audit. Repaired rows: id, pos and nth (their order), role, text.

    Rows go by turn, nulls first, equal turns by role and by the text's SHA-256. Equal rows are counted as one key, and
    all that decides the edits travels without texts: keys are sorted over all tasks, so that a conversation of any
    size is cut into one piece for each sorted part. A conversation in several parts (at most one begins and goes on
    in each) is joined from what each piece does to every cost vector; then all pieces write their edits on their own.
    Texts move twice: to meet their keys, and to the caller.
    Null role or text: one space; null id: a conversation of its own; empty table: no rows. Ties among cheapest edits:
    the ASCII-least letters. Texts are never read in Python here, so their length is no matter; other columns aren't read.
    """
    rows = df.select(col(id_col).cast("long").alias("conv"), col(turn_col).cast("long").alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    blank, cut = ~F.col("text").rlike(f"[^{SPACE}]"), ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    key = ["conv", "turn", "role", "digest"]
    keys = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max(blank).alias("blank"), F.max(cut).alias("cut"))
    earliest = keys.groupBy("conv", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("none"), F.min("turn").alias("least"))
    earliest = earliest.select("conv", F.when(~F.col("none"), F.col("least")).alias("turn"), "role", "digest", F.lit(True).alias("fresh"))
    marked = meet(keys, earliest, key, "left").withColumn("again", F.col("fresh").isNull()).drop("fresh")
    kind = F.instr(F.lit(KINDS), F.substring("role", 1, 1)) - 1
    kind = F.when(F.length("role") == 0, 3).when(kind < 0, 3).otherwise(kind)
    marked = marked.withColumn("symbol", F.when(F.col("blank") | F.col("again"), MUST_GO).otherwise(kind + F.when(F.col("cut"), 4).otherwise(0)).cast("int"))
    ordered = marked.orderBy("conv", F.asc_nulls_first("turn"), "role", "digest")
    ordered = staged(ordered.withColumn("pos", F.monotonically_increasing_id()), "turns").withColumn("part", F.shiftright("pos", 33))
    counts = ordered.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("again"), F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & ~F.col("again") & F.col("cut"), 1).otherwise(0)).alias("truncated"),
        (F.max("turn") - F.min("turn") + 1).alias("span"), F.min("part").alias("opens"), F.max("part").alias("closes"),
    )
    # a conversation that several parts share fills the end of one and the start of the next: fewer than there are parts
    split = counts.filter("opens < closes").select("conv")
    shared = meet(ordered, F.broadcast(split), ["conv"], "left_semi").select("part", "conv", "pos", "symbol")
    pieces = shared.repartition("part").sortWithinPartitions("part", "pos").mapInArrow(_summaries, "conv long, part long, before array<int>, leaves array<int>")
    joined = staged(pieces.groupBy("conv").applyInArrow(_joined, "conv long, part long, after int, enters int, last boolean"), "pieces")
    known = meet(ordered, F.broadcast(joined), ["conv", "part"], "left").select(
        "part", "conv", "pos", "turn", "role", "digest", "n", "symbol", *[F.coalesce(c, F.lit(x)).alias(c) for c, x in (("after", 0), ("enters", 0), ("last", True))]
    )
    stand = "array<struct<pos:long,nth:int,role:string,turn:long,old:string,digest:binary>>"
    chunks = known.repartition("part").sortWithinPartitions("part", "pos").mapInArrow(_edits, f"conv long, pos long, audit string, cost long, illegal long, turns long, stand {stand}, first string, final string, first_turn long, final_turn long")
    chunks = staged(chunks, "edits")
    by_pos = Window.partitionBy("conv").orderBy("pos")
    met = F.lag("final").over(by_pos)
    seamed = chunks.drop("stand").withColumns({
        "illegal": F.col("illegal") + F.when(met.isNotNull() & ~F.concat(met, "first").isin(*LEGAL), 1).otherwise(0),
        "turns": F.col("turns") - F.when(F.lag("final_turn").over(by_pos) == F.col("first_turn"), 1).otherwise(0),
    })
    per = seamed.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("turns").alias("turns"), F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("pos", "audit"))).alias("parts"))
    audits = meet(counts, per, ["conv"]).select(
        F.col("conv").alias(id_col), F.coalesce(F.col("span") - F.col("turns"), F.lit(0)).cast("long").alias("gaps"), *[F.col(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform("parts", lambda x: x["audit"]), "").alias("audit"),
    )
    left = chunks.select("conv", F.explode("stand").alias("_s")).select("conv", "_s.*")
    kept, texts = left.filter(F.col("digest").isNotNull()), rows.groupBy(*key).agg(F.any_value("text").alias("text"))
    kept = kept.withColumnsRenamed({"role": "new", "old": "role"})
    kept = meet(kept, texts, key).select("conv", "pos", "nth", F.col("new").alias("role"), "text")
    added = left.filter(F.col("digest").isNull()).select("conv", "pos", "nth", "role", F.lit("").alias("text"))
    return audits, kept.unionByName(added).withColumnRenamed("conv", id_col)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's rows as they pass by; one row's text is held at a time."""
    rows = ((c, t) for batch in batches for c, t in zip(batch.column(0), batch.column(1), strict=True))
    for conv, of in itertools.groupby(rows, key=lambda r: r[0].as_py()):
        digest = hashlib.sha256()
        for i, (_, text) in enumerate(of):
            digest.update(b"\n" if i else b"")
            digest.update(text.as_buffer() if text.is_valid else b"")
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of id and turn: dropped, emptied, stripped of full stops, repeated, role changed."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter("fault <> 0").select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))))
    return rows.select("conv_id", "turn", "role", "text")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Query: all conversations after damage, with faults, cost, audit and the repaired conversation's digest."""
    source = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    audits, repaired = repair_conversations(damaged(source))
    lines = repaired.select(F.col("conv_id").alias("conv"), "pos", "nth", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    hashes = lines.repartition("conv").sortWithinPartitions("conv", "pos", "nth").select("conv", "line").mapInArrow(_hashes, "conv long, repaired_sha256 string")
    ids = source.select(F.col("conv_id").cast("long").alias("id")).distinct()
    out = ids.join(audits, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(hashes, F.col("id").eqNullSafe(F.col("conv")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
