"""Sharding, chat formatting, top-k, Jaccard join: against brute force."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm import frames

from quantspark.llm import chat, common, jaccard, sharding, topk
from quantspark.llm.components import components


def test_shards_are_even_and_computable(spark):
    got = sharding.feistel_shards(frames.documents(spark), shards=7, seed=5, buckets=8).collect()
    rows = frames.rows()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())
    perm = sharding.Feistel(len(rows), 5)
    assert all(perm.at(r.row) == r.place == r.slot * 7 + r.shard and perm.row(r.place) == r.row for r in got)
    again = sharding.feistel_shards(frames.documents(spark).repartition(3), shards=7, seed=5, buckets=8).collect()
    key = lambda r: (str(r.doc_id), r.text_crc32, r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert sharding.feistel_shards(frames.nothing(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1000, 4099])
def test_feistel_is_a_permutation(n):
    perm = sharding.Feistel(n, 3)
    assert sorted(map(perm.at, range(n))) == list(range(n))


HOSTILE = st.text(alphabet=st.sampled_from(list("</s>[INST]~\\ a:\n<<SYS>>é")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), HOSTILE), HOSTILE), max_size=6))
def test_chat_grammar_round_trip(turns):
    whole, spans, _ = chat.render(turns)
    back = chat.parse(whole)
    assert [t[:2] for t in back] == turns
    flags = {(s, e): f for _, _, s, e, f in back}
    under = [chat.unescaped(whole[s:e]) if flags[s, e] else whole[s:e] for s, e in spans]
    assert under == [t for r, t in turns if r == "assistant"]


def test_chat_tables(spark):
    rows = [(1, 0, "user", "hi", 5), (1, 1, "assistant", "</s>[INST] ok [/INST]", 5), (2, 0, "system", None, 5), (2, 1, None, "x", 5), (2, 1, "tool\n>>", "y \\", 5), (None, None, "assistant", "", 5), (3, 0, "assistant", "a" * 100_000, 5), (3, 0, "assistant", "a" * 100_000, 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    for conv in (1, 2, None, 3):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert (got[conv].n_turns, got[conv].loss_chars, got[conv].loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


def test_top_k_is_exact_with_ties_and_odd_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=6).astype(np.float32)], 1.0) for i in range(300)]
    rows += [(1000 + i, rows[5][1], 1.0) for i in range(50)]  # one very common vector
    rows += [(2000, None, 1.0), (2001, [1.0, None] * 3, 1.0), (2002, [float("nan")] * 6, 1.0), (2003, [float("inf")] + [0.0] * 5, 1.0), (2004, [], 1.0), (2010, [1.0] * 3, 1.0), (2020, [2.0] * 3, 1.0), (None, rows[0][1], 1.0), (310, [0.0] * 6, 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double").repartition(4)
    got = topk.threshold_top_k(df, F.col("vec_id") % 10 == 0, k=10, block=7).collect()
    valid = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i, v in valid:
        if i % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in valid if j != i and len(w) == len(v))[:10]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    assert topk.threshold_top_k(df.limit(0), F.lit(True)).count() == 0
    large = spark.createDataFrame([(0, [1e12, 3.0]), (1, [1e12, 1.0]), (2, [-1e12, 1.0])], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in topk.threshold_top_k(large, F.col("vec_id") == 0, k=2).orderBy("rank").collect()] == [1, 2]
    huge = spark.createDataFrame([(0, [1e-3, 1e306]), (1, [5.0, 0.0]), (2, [1.0, -1e306])], "vec_id long, embedding array<double>").coalesce(1)
    assert [(r.vec_id, r.score) for r in topk.threshold_top_k(huge, F.col("vec_id") == 0, k=2).orderBy("rank").collect()] == [(1, 5120), (2, -(1 << 63))]


def brute_components(rows, k, percent):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    near = [[j for j in range(len(rows)) if j == i or (sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]))] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None))
    return Counter(out)


@pytest.mark.parametrize("percent", [85, 60])
def test_jaccard_components_match_brute_force(spark, percent):
    import random

    r = random.Random(percent)
    rows = [x[:2] for x in frames.rows()]
    base = "".join(frames.texts(6, 9)).split()
    passage = base[:40]
    for i in range(300, 420):  # near copies of near copies, and a passage that many share
        words = list(base) if i % 3 else passage + [f"own{i}x{j}" for j in range(r.randint(2, 30))]
        for _ in range(r.randint(0, 6)):
            words[r.randrange(len(words))] = f"w{r.randint(0, 30)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("clash"))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df.repartition(6), percent=percent).collect())
    assert got == brute_components(rows, 4, percent)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (200, 201)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 200, 201: 200}


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("_", "."): v for k, v in conf.items()}

    assert common.shared_root(Session(spark_master="yarn", spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    for master in ("yarn", "local-cluster[2,1,1000]", "spark://h:7077"):
        with pytest.raises(ValueError, match="checkpoint"):
            common.shared_root(Session(spark_master=master))
