"""Toxicity, quality rules and the pipeline: held-out accuracy, exact rules, odd rows."""

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tests.llm import frames

from quantspark.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def test_statistics_are_exact():
    r = random.Random(2)
    odd = ["a b c d e f a b c d e", "x\ny\nx\n \n \nx ", "\x1c\x85\u00a0 é#*$", "w " * 50, None, ""]
    for text in [*odd, *(t for _, t, *_ in frames.rows()), *(" ".join(r.choice("ab") for _ in range(r.randint(0, 40))) for _ in range(200))]:
        assert quality.statistics(text)[0] == brute_statistics(text), text


def test_quality_on_odd_rows(spark):
    docs, labels = frames.documents(spark), spark.createDataFrame([(i, i % 7 and 1, None) for i in range(60)] + [(None, 1, 1), (0, None, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(docs, labels).collect()
    assert len(got) == len(frames.rows())
    assert all(not (r.kept and r.base_failed) for r in got)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    assert quality.quality_rules(frames.nothing(spark), labels).count() == 0
    plain = quality.quality_rules(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in plain)


def test_quality_separates_labelled_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = quality.quality_rules(spark.read.parquet(f"{SF}/documents.parquet"), labels).join(labels, "doc_id").filter("NOT base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in good.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]


def test_toxicity_on_odd_rows(spark):
    docs = frames.documents(spark)
    labels = spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(60)] + [(None, None, None), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(frames.rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert toxicity.toxicity(frames.nothing(spark), labels).count() == 0
    assert all(r.predicted == 0 for r in toxicity.toxicity(docs, labels.limit(0)).collect())


def test_quality_under_other_names_and_as_a_stage(spark):
    docs = frames.documents(spark)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(60)], "doc_id long, quality int")
    verdict = lambda rows: sorted((r[0], r[1], r.base_failed, r.kept) for r in rows.drop("score").collect() if r[0] is not None)
    plain = verdict(quality.quality_rules(docs, labels))
    named = docs.select(F.col("doc_id").alias("k"), F.col("text").alias("body"))
    assert verdict(quality.quality_rules(named, labels.toDF("k", "good"), "k", "body", "good")) == plain
    assert quality.quality_rules(frames.nothing(spark), labels).count() == 0
    assert all(r[3] != r[2] for r in verdict(quality.quality_rules(docs, labels.limit(0))))


def toxic_rows():
    r = random.Random(4)
    texts = frames.texts(900, 8)
    toxic = [i % 8 == 0 for i in range(900)]
    bad = [f"grulv{e}" for e in ("", "en", "ta", "ig", "os")]
    rows = []
    for i, t in enumerate(texts):
        words = t.split()
        for _ in range(r.randint(2, 5) if toxic[i] else 0):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), 1, int(toxic[i])))
    return rows


def test_label_model_finds_accuracies_without_labels():
    rng = np.random.default_rng(3)
    truth = rng.random(200_000) < 0.15
    toxic, clean = np.array([0.7, 0.6, 0.5, 0.8]), np.array([0.02, 0.01, 0.0, 0.05])
    votes = (rng.random((len(truth), 4)) < np.where(truth[:, None], toxic, clean)).astype(float)
    seen, counts = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.label_model(seen, counts.astype(float), 0.15)
    assert np.abs(model.if_toxic - toxic).max() < 0.03 and np.abs(model.if_clean - clean).max() < 0.01
    assert np.abs(model.correlations - np.eye(4)).max() < 0.05
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.92  # always clean: 0.85
    # the same voter twice counts about once
    twice = toxicity.label_model(np.hstack([seen, seen[:, :1]]), counts.astype(float), 0.15)
    assert twice.weights[0] + twice.weights[4] < 1.35 * model.weights[0]


def test_posteriors_outvote_a_wrong_label(spark):
    docs = spark.createDataFrame(toxic_rows(), "doc_id long, text string, quality int, toxic int")
    train = docs.filter(~F.col("toxic").isNull()).select("doc_id", F.when(F.col("doc_id") == 880, 0).otherwise(F.col("toxic")).alias("toxic"))
    assert docs.filter("doc_id = 880 AND toxic = 1").count() == 1
    got = {r.doc_id: r for r in toxicity.toxicity(docs.drop("toxic"), train).collect()}
    assert not got[880].held_out and got[880].predicted == 1


def test_toxicity_held_out(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    got = toxicity.toxicity(docs.drop("toxic", "quality"), docs.select("doc_id", "toxic").filter("doc_id % 2 = 0")).join(docs, "doc_id").filter("held_out").collect()
    assert all(r.predicted == r.toxic for r in got) and len(got) > 200


def test_pipeline_matches_its_stages(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert clean.columns == docs.columns
    rejected = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - rejected
    small = docs.filter("doc_id < 300")
    kept = corpus_pipeline.drop_near_copies(spark, small, SF)
    from tests.llm.test_table_operators import brute_components

    want = {i for i, _, c in brute_components([(r.doc_id, r.text) for r in small.collect()], 5, 80) if i == c}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == want
    out = corpus_pipeline.run(spark, SF)
    totals = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert totals.filter("n > 2048").count() == 0 and out.select("doc_id").distinct().count() > 500
