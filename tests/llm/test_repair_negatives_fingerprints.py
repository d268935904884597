"""Conversation repair, hard negatives and document fingerprints: against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm import frames

from quantspark.llm import conversation_repair as repair
from quantspark.llm import fingerprints as prints
from quantspark.llm import hard_negatives as negatives

SEEN = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def repaired_by_hand(rows):
    """All paths, kept by (cost, letters): no vectors, no blocks, no tables."""
    faults, earlier = [], set()
    for _, role, text in rows:
        faults.append("blank" if not SEEN.search(text) else "duplicate" if (role, text) in earlier else "truncated" if SEEN.findall(text)[-1] not in ".!?" else "")
        earlier.add((role, text))

    def with_inserts(best):
        for _ in range(4):
            for q, (role, to) in NEXT.items():
                if best[to] is not None:
                    c, a, r = best[to]
                    best[q] = min(filter(None, [best[q], (c + 5, "I" + a, (role + ":", r))]), key=lambda x: x[:2])
        return best

    best = with_inserts([(0, "", None), None, None, (0, "", None)])
    for (_, role, text), fault in zip(reversed(rows), reversed(faults)):
        now = []
        for q in range(4):
            ways = [(best[q][0] + 2, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                extra, (wanted, to) = 5 * (fault == "truncated"), NEXT[q]
                if role[:1] == "s" and q == 0:
                    ways.append((best[1][0] + extra, "K" + best[1][1], (f"{role}:{text}", best[1][2])))
                keep = role[:1] == wanted[0]
                ways.append((best[to][0] + extra + (not keep), "RK"[keep] + best[to][1], (f"{role if keep else wanted}:{text}", best[to][2])))
            now.append(min(ways, key=lambda x: x[:2]))
        best = with_inserts(now)
    cost, audit, chain = best[0]
    lines = []
    while chain:
        lines.append(chain[0])
        chain = chain[1]
    turns = [t for t, *_ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), "cost": cost, "audit": audit,
    }, lines


def conversations():
    r = random.Random(5)
    role = lambda: r.choices(["user", "assistant", "system", "tool", "", None], [9, 9, 2, 1, 1, 1])[0]
    text = lambda: r.choices([f"Said {r.randint(0, 30)}.", f"cut {r.randint(0, 9)}", " \n", "", None, "é? \t"], [9, 3, 1, 1, 1, 1])[0]
    rows = [(c, r.choice([None, *range(9)]) if c % 3 else t, role(), text()) for c in range(60) for t in range(r.randint(1, 12))]
    rows += [(900, t, role(), f"Line {t}." if t % 5 else "Again.") for t in range(600)]  # over several parts
    rows += [(901, None, "user", "Same.")] * 40 + [(None, 3, "user", "No id."), (None, 4, "assistant", "None."), (902, 0, "assistant", "x" * 50_000)]
    return [(*row, "clash", 1) for row in rows]


@pytest.mark.parametrize("parts", [1, 7])
def test_repair_is_the_cheapest(spark, parts):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, pos int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        audits, repaired = repair.repair_conversations(df)
        got, lines = {x.conv_id: x.asDict() for x in audits.collect()}, defaultdict(list)
        for x in sorted(repaired.collect(), key=lambda x: (x.pos, x.nth)):
            lines[x.conv_id].append(f"{x.role}:{x.text}")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    by = defaultdict(list)
    for c, t, role, text, *_ in rows:
        by[c].append((t, role if role is not None else " ", text if text is not None else " "))
    assert set(got) == set(by)
    for c, of in by.items():
        of.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
        want, kept = repaired_by_hand(of)
        assert {k: got[c][k] for k in want} == want, c
        assert lines[c] == kept, c
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in of)) for of in lines.values())


def test_repair_of_nothing(spark):
    audits, repaired = repair.repair_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert audits.count() == repaired.count() == 0


def test_repair_query_on_damage(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Words {c} {t}!") for c in range(40) for t in range(6)] + [(77, 17, "user", "gone?")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {x.conv_id: x for x in repair.op11_conversation_repair(spark, str(tmp_path)).collect()}
    by = defaultdict(list, {c: [] for c, *_ in rows})
    for x in repair.damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")).collect():
        by[x.conv_id].append((x.turn, x.role, x.text))
    assert set(got) == set(by)
    for c, of in by.items():
        of.sort(key=lambda x: (x[0], x[1], hashlib.sha256(x[2].encode()).digest()))
        want, kept = repaired_by_hand(of)
        assert {k: got[c][k] for k in want} == want
        assert got[c].repaired_sha256 == hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_block_tables_agree_with_single_steps():
    t, r = repair.tables(), random.Random(1)
    for _ in range(200):
        symbols = [r.randrange(9) for _ in range(r.randint(1, 30))]
        blocks = t.blocks(symbols)
        before, leaves = t.whole(blocks)
        for v, vector in enumerate(t.vectors):
            cost = vector
            for s in reversed(symbols):
                cost = repair.step(s, cost)
            assert t.vectors[before[v]] == tuple(c - min(cost) for c in cost)
            for q in range(repair.STATES):
                rows = list(t.run(blocks, v, q))
                assert len(rows) == len(symbols) and rows[-1][3] == leaves[v][q]
                assert sum(x[2] for x in rows) + vector[rows[-1][3]] == cost[q]


def mined_by_hand(rows, anchor, positives=5, k=5, scale=256):
    """All scores as Python integers."""
    usable = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v)
    whole = [(i, lab, tuple(int(np.floor(x * scale)) if abs(x) < 2**40 else int(x) * scale for x in v)) for i, lab, v in rows if i is not None and lab is not None and usable(v)]
    out = []
    for i, lab, q in {x for x in whole if anchor(x[0])}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in whole if j != i and len(v) == len(q))
        for place, (s, j, _) in enumerate([x for x in scored if x[2] == lab][:positives], 1):
            fits = [x for x in scored if x[2] != lab and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(i, place, j, rank, n, clamp(-s), clamp(-t)) for rank, (t, n, _) in enumerate(fits, 1)]
    return sorted(out)


def clamp(x):
    return max(-(1 << 63), min((1 << 63) - 1, x))


def vectors():
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 4)), rng.normal(0, 0.2, 20).tolist()) for i in range(300)]
    rows += [(i, i % 3, rng.normal(0, 1, 3).tolist()) for i in range(300, 330)] + [(400, 1, rows[0][2]), (401, 1, rows[0][2])]
    rows += [rows[5]] * 7 + [rows[7]] * 3 + [(10, 2, rows[3][2])]  # repeats, and an anchor's id under another label
    rows += [(500, None, rows[0][2]), (None, 1, rows[0][2]), (501, 1, None), (502, 1, []), (503, 1, [float("nan")] * 20), (504, 1, [None] * 20), (505, 1, [float("inf")] * 20)]
    rows += [(600 + i, i % 2, [1e17 * (1 + i % 5), -1e16, float(i)]) for i in range(12)] + [(620 + i, i % 2, [1e200, -1e150 * i, 3.0, 1.0]) for i in range(12)] + [(640, 0, [0.0] * 20)]
    return rows


def test_hard_negatives_match_all_scores(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, score int, place string").repartition(4)
    got, counts = negatives.mine_hard_negatives(df, F.col("vec_id") % 10 == 0, block_rows=90, block_anchors=20)
    want = mined_by_hand(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert sorted(map(tuple, got.collect())) == want
    assert all(0 <= c.scored <= c.pairs for c in counts.collect())


def test_hard_negatives_score_few_pairs(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, (20, 32))
    df = spark.createDataFrame([(i, i % 5, (centre[i % 20] + rng.normal(0, 0.3, 32)).tolist()) for i in range(2000)], "vec_id long, label int, embedding array<double>")
    _, counts = negatives.mine_hard_negatives(df, F.col("vec_id") % 50 == 0)
    assert all(c.scored < 0.05 * c.pairs for c in counts.collect())


def test_hard_negatives_of_nothing(spark):
    assert negatives.mine_hard_negatives(spark.createDataFrame([], "vec_id long, label int, embedding array<double>"), F.col("vec_id") % 10 == 0)[0].count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for d in (1, 3, 17, 64):
        x, y = np.floor(rng.normal(0, 100, (30, d))), np.floor(rng.normal(20, 50, (40, d)))
        make = lambda v: negatives.Summaries(np.arange(len(v)), np.zeros(len(v), int), np.ones(len(v), int), np.arange(len(v)), v)
        true = x @ y.T
        last = np.inf
        for low, high in negatives.bounds(make(x), make(y), np.ones((30, 40), bool)):
            assert (low <= true).all() and (true <= high).all()
            assert (high - low).max() <= last + 1e-6
            last = (high - low).max()


def edited_by_hand(rows):
    """(n_chars, digest of the edited text) of each row; rows of one id are one place, where the least digest stands."""
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is None, -(i or 0)))
    stands = {i: min((t or "" for j, t in rows if j == i), key=lambda t: hashlib.sha256(t.encode()).digest()) for i in ids}
    following = dict(zip(ids, [*ids[1:], *ids[:1]]))
    return Counter((i, len(t or ""), hashlib.sha256(((t or "")[: len(t or "") - len(t or "") // 3] + stands[following[i]][: len(t or "") // 3]).encode()).hexdigest()) for i, t in rows)


def test_fingerprints(spark):
    rows = [(r[0], r[1]) for r in frames.rows()]
    got = prints.document_fingerprints(frames.documents(spark)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == edited_by_hand(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    ranks = prints.rarity(frames.documents(spark))
    of = {r.text: r.fingerprint for r in prints.fingerprinted(frames.documents(spark).filter("text is not null"), ranks).collect()}
    assert {r.fingerprint for r in got} == set(of.values()) | {"0:"}
    plain = [r for r in got if r.doc_id is not None and r.doc_id < 60]
    assert np.mean([r.near_edited for r in plain]) > 0.55 and max(r.near_next for r in plain) < 0.3
    assert [r.near_next for r in got if r.doc_id == 104] == [1.0, 1.0]  # the next, 103, is a copy
    assert prints.document_fingerprints(frames.nothing(spark)).count() == 0


def test_hot_ids_are_dealt_and_keep_their_successor(spark):
    words = frames.texts(120, seed=8)
    rows = [(i, t) for i, t in enumerate(words[:30])] + [(12, t) for t in words[30:75]] + [(None, t) for t in words[75:]] + [(12, words[40])] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = prints.document_fingerprints(df, large=10).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == edited_by_hand(rows)
    assert all(r.near_next is not None for r in got)
    plain = prints.document_fingerprints(df).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, plain))


def test_single_document_is_its_own_next(spark):
    text = frames.texts(1)[0]
    [r] = prints.document_fingerprints(spark.createDataFrame([(7, text, "clash", 1, 2)], "doc_id long, text string, fingerprint string, need int, pos int")).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256((text[: len(text) - len(text) // 3] + text[: len(text) // 3]).encode()).hexdigest()


def classes_by_hand(data, window):
    plog = [round(c * log2(c) * 2**20) if c else 0 for c in range(window + 1)]
    return [(plog[window] - sum(plog[c] for c in Counter(data[i : i + window].tolist()).values())) * 1000 // plog[window] for i in range(len(data) - window + 1)]


def features_by_hand(text, ranks):
    found = set()
    for (window, least, below), rank in zip(prints.SCALES, ranks):
        if not max(1, least) <= len(text) < below:
            continue
        if len(text) < window:
            found.add(text.ljust(window, b"\0"))
            continue
        order = [rank[c] for c in classes_by_hand(np.frombuffer(text, np.uint8), window)]
        votes = Counter(min(range(max(0, s), min(len(order), s + window)), key=lambda p: (order[p], p)) for s in range(1 - window, len(order)))
        found |= {text[p : p + window] for p, n in votes.items() if n >= window // 4}
    return found


@pytest.mark.parametrize("seed", range(4))
def test_features_match_brute_force(seed):
    r = random.Random(seed)
    texts = [bytes(r.choices(b"abcdefgh ,.", k=n)) for n in (0, 1, 5, 8, 31, 32, 33, 63, 64, 70, 130, 255, 256, 300, 1000)] + [b"a" * 500, b""]
    r.shuffle(texts)
    ranks = [np.array(r.sample(range(1001), 1001)) for _ in prints.SCALES]
    owner, hashed = prints.features(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]), ranks)
    for i, text in enumerate(texts):
        want = {int(prints._hash(np.frombuffer(f, np.uint8)[None, :])[0]) for f in features_by_hand(text, ranks)}
        got = hashed[owner == i].tolist()
        assert len(got) == len(set(got)) and set(got) == want


def test_likeness_follows_shared_features():
    r = random.Random(9)
    ranks = [np.array(r.sample(range(1001), 1001)) for _ in prints.SCALES]
    text = lambda n: "".join(r.choices("abcdefghijklmnop ", k=n))
    a, b = text(40_000), text(40_000)
    one = lambda t: prints.fingerprint(pa.array([t]), ranks)[0]
    assert prints.likeness(one(a), one(b)) < 0.02
    for share in (0.25, 0.5, 0.75):
        n = int(share * len(a))
        assert abs(prints.likeness(one(a), one(a[:n] + b[n:])) - share) < 0.08
        assert abs(prints.likeness(one(a), one(b[n:] + a[:n])) - share) < 0.12  # chains cut at other places
    assert prints.likeness("0:", "0:") == 1.0 and prints.likeness(one(a), "0:") == 0.0
