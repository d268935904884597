"""Licence scan, packing, BPE, language model: against brute force on small tables with odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from tests.llm import frames
from tokenizers import Tokenizer

from quantspark.llm import bpe, language_model, licenses, packing
from quantspark.llm.hashstore import save


def lower(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_license_scan_counts_every_place(spark):
    rows = licenses.license_scan(frames.documents(spark)).collect()
    assert len(rows) == len(frames.rows())
    got = {(r.doc_id, r.text_hash): r for r in rows}
    by_id = defaultdict(list)
    for (i, _), r in got.items():
        by_id[i].append(r)
    for i, text, *_ in frames.rows():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places = sorted((s, label) for phrase, label in licenses.PHRASES.items() for k in [phrase.split()] for s in range(len(words)) if words[s : s + len(k)] == k)
        want = (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({p[1] for p in places})))
        assert want in [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in by_id[i]]
        assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in by_id[i])
    assert len(got) == len({(i, t or "") for i, t, *_ in frames.rows()})
    assert licenses.license_scan(frames.nothing(spark)).count() == 0


def brute_notices(words):
    """Labels by the longest chain of word pairs in the template's order, tried from every place of the text."""
    labels = set()
    for notice, label in licenses.NOTICES.items():
        t = notice.split()
        pairs, best = list(zip(t, t[1:], strict=False)), 0
        for start in range(len(words)):
            window = words[start : start + 2 * len(t) + 1]
            there = list(zip(window, window[1:], strict=False))[: 2 * len(t)]
            row = [0] * (len(pairs) + 1)
            for w in there:  # longest common subsequence
                row = [0, *row[1:]] if not row else row
                new = [0]
                for j, p in enumerate(pairs):
                    new.append(max(row[j + 1], new[j], row[j] + 1 if p == w else 0))
                row = new
            best = max(best, row[-1])
        if best >= licenses.COVER * len(pairs):
            labels.add(label)
    return labels


def test_license_notices_need_the_order_of_words(spark):
    import random

    r = random.Random(12)
    shuffled = "2 0 version 2 license version apache license the apache under the licensed under"
    texts = [shuffled]
    for notice in [*licenses.NOTICES] * 3:
        w = notice.split()
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(w))
            w[i : i + r.randint(0, 2)] = [r.choice("so it is".split())] * r.randint(0, 2)
        if r.random() < 0.3:
            r.shuffle(w)
        texts.append(" ".join(["some", "words", *w, "and", "more"]))
    got = {x.doc_id: x for x in licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].labels == ""
    for i, t in enumerate(texts):
        assert set(filter(None, got[i].labels.split(","))) - set(got[i].base_labels.split(",")) <= brute_notices(t.split()), t
        exact = {label for n, label in licenses.NOTICES.items() if n in t}
        assert exact <= set(got[i].labels.split(",")), t


def test_license_notices_match_with_gaps(spark):
    rows = [(1, "Licensed, as it were, under the Apache License, Version 2.0"), (2, "licensed under the apache"), (3, "Released under the  MIT license!"), (4, "GNU General Public License General Public License")]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in (1, 2, 3)] == ["apache-2.0", "", "mit"]
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (2, 1, 4)


@pytest.mark.parametrize("most", [32, 2048])
def test_packing_places_every_piece_once(spark, most):
    special = [(500, "a <|endoftext|> b"), (501, "<|endoftext|>"), (502, "<|endoftext |> <|endoftext|><|endoftext|>x")]
    docs = frames.documents(spark).select("doc_id", "text").union(spark.createDataFrame(special, "doc_id long, text string"))
    got = packing.pack(docs.withColumns({c: F.lit(1) for c in ("piece", "length", "offset", "salt")}), most=most, window=5).collect()
    own = library()
    assert own.encode(special[0][1], add_special_tokens=False).ids == [64, 220, 50256, 275]
    want = Counter()
    for i, text, *_ in [*frames.rows(), *special]:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        for k, (start, length) in enumerate(packing.cut(len(ids), most)):
            assert 1 <= length <= most and (k == 0 or length == most)
            want[i, k, start, length, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[start : start + length]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    sizes = Counter(r.length for r in got)
    assert len(sequences) <= len_of(packing.best_fit(sizes, most)) and len(sequences) >= -(-sum(k * n for k, n in sizes.items()) // most)
    assert packing.pack(frames.nothing(spark)).count() == 0


def len_of(plan):
    return sum(n for _, n in plan)


def test_plans_serve_the_histogram_exactly():
    import random

    r = random.Random(5)
    for _ in range(20):
        h = Counter(r.choice([r.randint(1, 64), r.randint(1, 9), 64, 33]) for _ in range(r.randint(1, 500)))
        plan = packing.plan_packs(dict(h), 64)
        assert Counter({k: sum(p.count(k) * n for p, n in plan) for k in h}) == h
        assert all(sum(p) <= 64 for p, _ in plan) and len_of(plan) <= len_of(packing.best_fit(dict(h), 64))


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_words_of_equal_hash_keep_their_own_ids(tmp_path):
    folder, wanted = str(tmp_path), "wanted"
    h = np.uint64(xxhash.xxh64_intdigest(wanted.encode(), 42))
    save(folder, "hash-0", np.array([h, h], np.uint64))
    for name, cells in (("word", [b"another", wanted.encode()]), ("ids", [b"\1\0\0\0", b"\2\0\0\0\3\0\0\0"])):
        save(folder, f"{name}-start-0", np.cumsum([0, *map(len, cells)], dtype=np.int64))
        save(folder, f"{name}-0", np.frombuffer(b"".join(cells), np.uint8))
    store = bpe.WordIds(folder, 1)
    words = lambda *x: pa.array([w.encode() for w in x], pa.binary())
    assert store.of(words(wanted)).to_pylist() == [b"\2\0\0\0\3\0\0\0"]
    assert store.of(words()).to_pylist() == []
    with pytest.raises(IndexError):
        store.of(words("absent"))


def test_words_of_texts_are_the_matches_of_the_pattern():
    import random

    r, pattern = random.Random(1), regex.compile(public_tokenizers.PATTERN)
    kinds = ["'srevlmdtX 1.\n", "ab' \t1", "é漢'\u3000 \x85\xa0s²\U0001f600l\u0301", "'sl ", " \n", "'"]
    for _ in range(3000):
        texts = ["".join(r.choice(r.choice(kinds)) for _ in range(r.randint(0, 12))) for _ in range(r.randint(0, 5))]
        words, before = bpe.matches(pa.array([*texts, "left out"], pa.string()).slice(0, len(texts)))
        words = [w.decode() for w in words.to_pylist()]
        assert [words[a:b] for a, b in zip(before, before[1:])] == [pattern.findall(t) for t in texts]


def test_bpe_round_trip(spark):
    import base64

    import tiktoken

    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe.encode(frames.documents(spark))
    got = Counter((r.doc_id, tuple(r.ids), hashlib.sha256(bytes(r.back)).hexdigest()) for r in out.withColumn("back", bpe.decoded(out["ids"])).collect())
    want = Counter()
    for i, text, *_ in frames.rows():
        # one very long word takes that library's splitter too long
        ids = tuple(own.encode_ordinary(text or "")) if i != 107 else tuple(library().encode(text, add_special_tokens=False).ids)
        want[i, ids, hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want
    assert bpe.encode(frames.nothing(spark)).count() == 0


def test_every_distinct_word_is_folded_as_the_library_merges(spark):
    import random

    r = random.Random(6)
    odd = ["a" * 500, "ab" * 333, "thethethe" * 50, "漢字" * 100, "Ünïcödé" * 40, "aab" * 90, "é", "\0"]
    odd += ["".join(r.choice(x) for _ in range(r.randint(1, 200))) for x in ("ab", "the", "aeinst", "abcdefghijklmnopqrstuvwxyz", "äöüßé") for _ in range(30)]
    df = spark.createDataFrame([(w.encode(),) for w in odd], "word binary").select("word", bpe.merged(F.col("word")).alias("ids"))
    own = library()
    for r in df.collect():
        assert r.ids == own.encode(bytes(r.word).decode(), add_special_tokens=False).ids, r.word
    docs = frames.documents(spark).fillna("", ["text"])
    assert bpe.distinct_words(docs).count() == len({w for _, t, *_ in frames.rows() for w in regex.findall(public_tokenizers.PATTERN, t or "")})


def test_kneser_ney_is_a_distribution_and_matches_brute_force(spark):
    docs = frames.documents(spark)
    model = language_model.train(docs.filter(~language_model.held_out(docs["doc_id"], 7, 2)), buckets=3)
    got = language_model.score(docs, model).collect()
    tokens = lambda t: (t or "").encode().lower().split() + [b" end"]
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    train = [tokens(t) for i, t, *_ in frames.rows() if not held(i)]
    n, pairs = Counter(w for d in train for w in d), Counter(p for d in train for p in zip([b" begin", *d], d, strict=False))
    total, words = sum(n.values()), len(n)
    d, before = model.discounts, Counter(b for _, b in pairs)
    e, context = model.low_discounts, defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), k in pairs.items():
        context[a][0] += k
        context[a][min(k, 3)] += 1
    mass = sum(e[min(k, 3) - 1] for k in before.values()) / len(pairs)

    def p(a, b):
        low = (max(0, before[b] - e[min(before[b], 3) - 1]) if before[b] else 0) / len(pairs) + mass / (words + 1)
        if a not in context:
            return low
        k, c = pairs.get((a, b), 0), context[a]
        return ((max(0, k - d[min(k, 3) - 1]) if k else 0) + sum(d[i - 1] * c[i] for i in (1, 2, 3)) * low) / c[0]

    assert abs(sum(p(train[0][0], w) for w in n) + p(train[0][0], b"??") - 1) < 1e-9
    want = Counter()
    for i, text, *_ in frames.rows():
        w = tokens(text)
        base = sum(math.log10((n[x] + 1) / (total + words + 1)) for x in w)
        want[i, len(w), sum(x in n for x in w), total, round(base, 6), round(sum(math.log10(p(a, b)) for a, b in zip([b" begin", *w], w, strict=False)), 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    empty = language_model.train(frames.nothing(spark))
    assert language_model.score(docs, empty).filter("n_known > 0 OR train_tokens > 0 OR isnan(score)").count() == 0
    assert language_model.score(frames.nothing(spark), model).count() == 0


@pytest.mark.parametrize("order", [3, 4])
def test_kneser_ney_of_higher_orders_matches_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(language_model, "SLICE", 5_000)
    docs = frames.documents(spark)
    model = language_model.train(docs.filter(~language_model.held_out(docs["doc_id"], 7, 2)), buckets=3, order=order)
    got = language_model.score(docs, model).collect()
    tokens = lambda t: (t or "").encode().lower().split() + [b" end"]
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    grams = lambda w, k: list(zip(*([*[b" begin"] * (k - 1), *w][j:] for j in range(k)), strict=False))
    train = [tokens(t) for i, t, *_ in frames.rows() if not held(i)]
    words = {w for d in train for w in d}
    seen = {order: Counter(g for d in train for g in grams(d, order))}
    for k in range(order - 1, 0, -1):
        distinct = {g for d in train for g in grams(d, k + 1)}
        seen[k] = Counter(g[1:] for g in distinct)
    cut = {k: language_model.discounts([sum(n == j for n in c.values()) for j in (1, 2, 3, 4)]) for k, c in seen.items()}
    assert model.low_discounts == cut[1] and [x.discounts for x in model.levels] == [cut[k] for k in range(2, order + 1)]
    after = {k: defaultdict(list) for k in seen}
    for k, c in seen.items():
        for g, n in c.items():
            after[k][g[:-1]].append(n)

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(words) + 1)
        if not (own := after[k].get(g[:-1])):
            return p(g[1:])
        d = lambda n: cut[k][min(n, 3) - 1] if n else 0
        n = seen[k].get(g, 0)
        return (max(0, n - d(n)) + sum(map(d, own)) * p(g[1:])) / sum(own)

    for context in (grams(train[0], order)[0][:-1], grams(train[0], order)[5][:-1]):
        assert abs(sum(p((*context, w)) for w in [*words, b"??"]) - 1) < 1e-9
    want = Counter((i, len(w), round(sum(math.log10(p(g)) for g in grams(w, order)), 6)) for i, t, *_ in frames.rows() for w in [tokens(t)])
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in got) == want
    empty = language_model.train(frames.nothing(spark), order=order)
    assert language_model.score(docs, empty).filter("n_known > 0 OR isnan(score)").count() == 0
    assert language_model.score(frames.nothing(spark), model).count() == 0
