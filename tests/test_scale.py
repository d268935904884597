"""Steps that grow with the features: ties, bins, classes of equal features, whatever the layout."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantspark.operators import differential, filters, impute, normalize, reshape, rollup
from quantspark.plans import fixtures, queries


@pytest.mark.parametrize("peptides", ["AB", "BA"])
def test_first_value_of_tied_places_is_the_least(spark, peptides):
    rows = [("f", 1, 1, p) for p in peptides] + [("f", 1, 2, "0"), ("f", 0, 9, None)]
    df = spark.createDataFrame(rows, "INDEX string, ORDERKEY long, CHARGE int, PEPTIDE_LSEQ string").coalesce(1)
    assert rollup.features(df, ["PEPTIDE_LSEQ"], ["ORDERKEY", "CHARGE"]).first().PEPTIDE_LSEQ == "A"


@pytest.mark.parametrize("bin_most", [10**6, 3])
def test_binned_correction_sorts_each_row_once(spark, bin_most):
    r = np.random.default_rng(11)
    p = np.concatenate([np.zeros(5), r.uniform(0, 1, 300), np.full(90, 0.25), r.uniform(0, 1e-4, 60), np.ones(40)])
    df = spark.createDataFrame([(c, i, float(v)) for c in ("a", None) for i, v in enumerate(p)] + [("a", -1, None)], "contrast string, i int, p double").repartition(5)
    got = differential.bh(df, bins=20, most=0, bin_most=bin_most)
    plan = got._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert "hashpartitioning" not in plan or bin_most == 3  # what is left to do moves no row
    order = np.sort(p)
    share = np.minimum.accumulate((order * len(p) / np.searchsorted(order, order, "right"))[::-1])[::-1]
    for x in got.collect():
        assert x.q is None if x.p is None else math.isclose(x.q, min(1.0, share[np.searchsorted(order, x.p)]), rel_tol=1e-12)
    assert got.count() == df.count()


def test_grid_keeps_features_together(spark):
    cells = spark.createDataFrame([("f", "s1", 1.0, 2), ("f", "s1", 3.0, 4), ("g", "s2", None, 5), (None, "s1", 6.0, 7), ("h", "else", 8.0, 9)], "INDEX string, Sample string, raw double, n int")
    samples = spark.createDataFrame([("s1",), ("s2",)], "Sample string")
    got = reshape.complete_grid(cells, samples)
    assert got.columns == ["INDEX", "Sample", "raw", "n"] and [x.dataType for x in got.schema] == [x.dataType for x in cells.schema]
    key = lambda x: tuple((v is None, v) for v in x)
    want = [("f", "s1", 1.0, 2), ("f", "s1", 3.0, 4), ("f", "s2", None, None), ("g", "s1", None, None), ("g", "s2", None, 5), ("h", "s1", None, None), ("h", "s2", None, None), (None, "s1", None, None), (None, "s2", None, None)]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    plan = got.groupBy("INDEX", "Sample").count()._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert plan.count("hashpartitioning") == 1


def test_contrasts_need_no_join_of_conditions(spark):
    groups = spark.createDataFrame([("f", "A", 1.0, 3), ("f", "B", 2.0, 3), ("g", "A", 1.0, 2), ("f", None, 9.0, 1)], "INDEX string, CONDITION string, mean double, n long")
    pooled = spark.createDataFrame([("f", 0.5, 4), ("g", 0.5, 1)], "INDEX string, s2 double, df long")
    contrasts = spark.createDataFrame([("A_vs_B", "A", "B")], "contrast string, A string, B string")
    got = differential.contrasts_of(groups, pooled, contrasts)
    x = got.collect()
    assert [(r.INDEX, r.contrast, r.log2fc, r.df) for r in x] == [("f", "A_vs_B", -1.0, 4)] and x[0].t == pytest.approx(-1 / math.sqrt(0.5 * 2 / 3))
    seen = differential.missing_mask(groups.select("INDEX", "CONDITION", (F.col("n") - 3).alias("n_observed")), contrasts)
    assert seen._jdf.queryExecution().toString().split("Physical Plan")[-1].count("hashpartitioning") == 1
    assert [(r.INDEX, r.n_a, r.n_b, r.masked) for r in seen.collect()] == [("f", 0, 0, True)]


def spread_cells(spark, features, samples=3, seed=12):
    r = np.random.default_rng(seed)
    v = r.normal(20, 3, (features, samples)) + np.arange(samples)
    v[r.random(v.shape) < 0.2] = np.nan
    rows = [(f"f{i:04d}", f"s{j}", None if np.isnan(x) else float(x)) for i, of in enumerate(v) for j, x in enumerate(of)]
    return v, spark.createDataFrame(rows, "INDEX string, Sample string, v double").repartition(5)


def test_no_cell_meets_a_grid_or_a_line_as_a_row(spark):
    """Grids, curves and lines are looked up in place: no join carries an array or a hundred lines to each cell, no window holds a sample."""
    _, c = spread_cells(spark, 40)
    s = spark.createDataFrame([(f"s{j}", "A") for j in range(3)], "Sample string, CONDITION string")
    for out in (normalize.quantile_uniform(c, most=7), normalize.linear_robust(c, s), normalize.loess(c, s, exact=10, knots=9)):
        plan = out._jdf.queryExecution().toString().split("Physical Plan")[-1]
        assert "array<double>" not in plan and "lambda" not in plan and "percent_rank" not in plan and "hashpartitioning(Sample" not in plan


def test_ranks_over_all_tasks(spark):
    _, c = spread_cells(spark, 200)
    points = c.filter("v IS NOT NULL").select("INDEX", "Sample", F.round("v").alias("M"), "v")
    got = {(r.Sample, r.INDEX): (r["rank"], r.n) for r in normalize._ranks(points).collect()}
    rows = sorted((r.Sample, r.M, r.INDEX) for r in points.collect())
    for s in ("s0", "s1", "s2"):
        own = [x for x in rows if x[0] == s]
        assert all(got[s, x[2]] == (i, len(own)) for i, x in enumerate(own, 1))


@pytest.mark.parametrize(("impute_by", "k"), [(impute.knn_features, 3), (impute.knn_correlated, 3)])
def test_equal_features_are_looked_up_once(spark, monkeypatch, impute_by, k):
    """Copies of features are one class; every gap has what a search among all features gives it."""
    v, c = spread_cells(spark, 14, 5)
    x = np.repeat(v, [1, 5, 2, 1, 3, 1, 1, 6, 1, 1, 2, 1, 1, 1], axis=0)
    x[6] = [np.nan, 2.0, np.nan, np.nan, np.nan]  # without spread
    r = np.random.default_rng(3)
    names = [f"g{i:03d}" for i in r.permutation(len(x))]
    c = spark.createDataFrame([(n, f"s{j}", None if np.isnan(w) else float(w)) for n, row in zip(names, x) for j, w in enumerate(row)], "INDEX string, Sample string, v double").repartition(4)
    seen, search = [], impute.feature_donors
    monkeypatch.setattr(impute, "feature_donors", lambda cells, *rest: seen.append(cells.select("INDEX").distinct().count()) or search(cells, *rest))
    got = {(q.INDEX, q.Sample): q.v for q in impute_by(c, k).collect()}
    assert seen == [len({str(row) for row in x})]
    euclid = impute_by is impute.knn_features
    low, z = np.nanmin(x), x
    mu, sd = np.nanmean(x, 1, keepdims=True), np.nanstd(x, 1, keepdims=True)
    sd = np.where(sd > 0, sd, 1e-8)
    if not euclid:
        z = (x - mu) / sd
    d = (impute.EUCLIDEAN if euclid else impute.CORRELATION).distances(z, z)
    d = np.round(d, 12)
    np.fill_diagonal(d, np.inf)
    for i, j in zip(*np.nonzero(np.isnan(x))):
        order = [o for _, _, o in sorted((d[i, o], names[o], o) for o in range(len(x))) if np.isfinite(d[i, o]) and (not euclid or not np.isnan(x[o, j]))][:k]
        if euclid:
            want = np.mean([x[o, j] for o in order]) if order else np.nanmean(x[:, j])
        else:
            w = [(1 / (d[i, o] + 1e-6), z[o, j]) for o in order if not np.isnan(z[o, j])]
            want = sum(a * b for a, b in w) / sum(a for a, _ in w) * sd[i, 0] + mu[i, 0] if w else low
        assert got[names[i], f"s{j}"] == pytest.approx(want, rel=1e-6), (i, j)


def test_few_parents_gather_no_cells(spark):
    cells = spark.createDataFrame([(f"f{i}", "s", float(i)) for i in range(9)], "INDEX string, Sample string, v double").repartition(3)
    parents = cells.select("INDEX", F.lit("p").alias("PARENT_PROTEIN"))
    own = spark.createDataFrame([("p", "s", 1.0)], "PARENT_PROTEIN string, Sample string, covariate double").groupBy("PARENT_PROTEIN", "Sample").agg(F.sum("covariate").alias("covariate"))
    out = rollup.with_covariate(cells, parents, own)
    assert "hashpartitioning(PARENT_PROTEIN" not in out._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert out.filter("covariate = 1").count() == 9


SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().toString().split("Physical Plan")[-1]


def test_line_items_are_dealt_by_feature_once(spark, monkeypatch):
    """A large input has tasks of bounded size, and what goes on by feature moves no row again."""
    small = fixtures.long_table(spark, SF)
    lines = fixtures.read(spark, SF, "lineitem").count()
    monkeypatch.setattr(fixtures, "TASK_ROWS", lines // 9)
    large = fixtures.long_table(spark, SF)
    assert large.rdd.getNumPartitions() == -(-lines // (lines // 9)) and large.columns == small.columns
    assert large.exceptAll(small).isEmpty() and large.count() == small.count()
    cells = fixtures.grid(spark, SF).groupBy("INDEX", "Sample").agg(F.max("raw"))
    assert physical(cells).count("hashpartitioning(INDEX") == 1 and "hashpartitioning(l_partkey" not in physical(cells)


@pytest.mark.parametrize("name", ["f11_localization", "j14_peptide_table", "w4_first_sample", "i3_condition_median", "i5_knn_samples"])
def test_queries_on_dealt_line_items_give_the_same(spark, monkeypatch, name):
    rows = lambda df: sorted((tuple(x) for x in df.collect()), key=str)
    want = rows(queries.QUERIES[name](spark, SF))
    spark.catalog.clearCache()
    monkeypatch.setattr(fixtures, "TASK_ROWS", 400)
    got = queries.QUERIES[name](spark, SF)
    plan = physical(got).split("InMemoryRelation")[0]
    assert "hashpartitioning(FILENAME" not in plan and "hashpartitioning(CONDITION" not in plan and "hashpartitioning(Sample" not in plan
    for a, b in zip(rows(got), want, strict=True):
        assert all(x == y or x == pytest.approx(y, abs=2e-6) for x, y in zip(a, b))
    spark.catalog.clearCache()


@pytest.mark.parametrize("mode", ["soft", "strict"])
def test_localization_joins_no_cells(spark, mode):
    cells = spark.createDataFrame([("f", "a", 0.9), ("f", "b", 0.2), ("g", "a", 0.8), ("g", "b", None), ("h", "a", None), (None, "a", 0.9), ("i", "a", 0.1)], "INDEX string, Sample string, LOC_PROB double")
    got = filters.localization_filter(cells, 0.75, mode)
    assert "Join" not in physical(got) and got.columns == cells.columns
    assert {(r.INDEX, r.Sample) for r in got.collect()} == {("g", "a"), ("g", "b")} | ({("f", "a"), ("f", "b")} if mode == "soft" else set())


def by_feature(cells):
    return cells.repartition(6, "INDEX")


def test_gaps_meet_no_donors_by_join(spark):
    v, cells = spread_cells(spark, 60, 6)
    cells = cells.withColumn("raw", F.pow(F.lit(2.0), "v")).filter("INDEX <> 'f0003' OR Sample <> 's1'")
    v[3, 1] = np.nan
    more = [("same", f"s{j}", 0.1 if j < 5 else None, None) for j in range(6)] + [("none", f"s{j}", None, None) for j in range(6)] + [(None, "s0", None, None), (None, "s0", 4.0, 16.0)]
    cells = by_feature(cells.unionByName(spark.createDataFrame(more, "INDEX string, Sample string, v double, raw double")))
    out = impute.knn_samples(cells, 3)
    plan = physical(out)
    assert out.columns == ["INDEX", "Sample", "v", "raw", "imputed"] and "SortMergeJoin" not in plan and "hashpartitioning(INDEX, dst" not in plan and "hashpartitioning(INDEX, Sample" not in plan
    x = np.vstack([v, [0.1] * 5 + [np.nan]])
    sd = np.nanstd(x, 1, keepdims=True)
    sd[-1] = 1
    z = (x - np.nanmean(x, 1, keepdims=True)) / sd
    d = np.sqrt([[np.nanmean((z[:, a] - z[:, b]) ** 2) for b in range(6)] for a in range(6)])
    np.fill_diagonal(d, np.inf)
    found = {(q.src, q.dst): q.dist for q in impute.sample_distances(cells).collect()}
    assert len(found) == 30 and all(math.isclose(found[f"s{a}", f"s{b}"], d[a, b], rel_tol=1e-9) for a in range(6) for b in range(6) if a != b)
    low = np.nanmin(x, 1)
    rows = out.collect()
    assert len(rows) == cells.count() and all(q.raw is None or q.raw == pytest.approx(2**q.v) for q in rows if not q.imputed)
    for q in rows:
        if q.INDEX is None or q.INDEX == "none":
            assert q.v == (0.0 if q.imputed else 4.0)
            continue
        i, j = (60 if q.INDEX == "same" else int(q.INDEX[1:])), int(q.Sample[1:])
        near = np.argsort(d[j], kind="stable")[:3]
        want = x[i, j] if not q.imputed else np.mean([low[i] if np.isnan(x[i, o]) else x[i, o] for o in near])
        assert q.imputed == np.isnan(x[i, j]) and q.v == pytest.approx(want, rel=1e-9)


def test_conditions_meet_their_cells_in_one_row(spark):
    v, cells = spread_cells(spark, 30, 6)
    unknown = spark.createDataFrame([("f0000", "s9", None), (None, "s0", None), (None, "s1", 7.0)], "INDEX string, Sample string, v double")
    samples = spark.createDataFrame([(f"s{j}", "AB"[j > 2]) for j in range(6)] + [("s9", None)], "Sample string, CONDITION string")
    cells = by_feature(cells.unionByName(unknown))
    out = impute.condition_median(cells, samples)
    plan = physical(out)
    assert "SortMergeJoin" not in plan and "hashpartitioning(INDEX, CONDITION" not in plan and out.columns == ["INDEX", "Sample", "v", "imputed"]
    rows, lod = out.collect(), np.median(sorted([*v[~np.isnan(v)], 7.0])[:10])
    assert len(rows) == 30 * 6 + 3
    bounds = {(b.INDEX, b.CONDITION): b for b in impute.condition_bounds(cells, samples).collect()}
    for q in rows:
        known = q.INDEX is not None and q.Sample != "s9"
        own = v[int(q.INDEX[1:]), slice(0, 3) if q.Sample < "s3" else slice(3, 6)] if known else np.array([])
        own = own[~np.isnan(own)]
        if not q.imputed:
            continue
        if not len(own):
            assert q.v <= lod
            continue
        b = bounds[q.INDEX, "A" if q.Sample < "s3" else "B"]
        assert (b.n, b.center, b.lower, b.upper) == (len(own), *(pytest.approx(np.quantile(own, p), rel=1e-12) for p in (0.5, 0.25, 0.75)))
        assert b.lower <= q.v <= b.upper


def test_first_sample_needs_no_grid_and_no_windows(spark, monkeypatch):
    """One reader, which leaves unknown cells out: no cell is persisted, gathered or completed, each is sorted once by its condition."""
    monkeypatch.setattr(fixtures, "TASK_ROWS", 400)
    plan = physical(queries.QUERIES["w4_first_sample"](spark, SF))
    assert "InMemoryRelation" not in plan and "collect_list" not in plan and "Window [min_by" not in plan
    assert plan.count("hashpartitioning(INDEX") == 1 and len(re.findall(r"Sort \[INDEX#\d+ ASC NULLS FIRST, CONDITION", plan)) == 1


def test_first_values_and_references_agree(spark):
    v, cells = spread_cells(spark, 40, 6)
    more = spark.createDataFrame([("none", "s0", None), ("f0000", "s9", 5.0), (None, "s1", 7.0), (None, "s0", None)], "INDEX string, Sample string, v double")
    samples = spark.createDataFrame([(f"s{j}", "AB"[j % 2]) for j in range(6)], "Sample string, CONDITION string")
    cells = by_feature(cells.unionByName(more))
    got = {(q.INDEX, q.CONDITION): q.ref for q in normalize.first_values(cells, samples).collect()}
    known = ~np.isnan(v)
    want = {(f"f{i:04d}", "AB"[c]): next(v[i, j] for j in range(c, 6, 2) if known[i, j]) for i in range(40) for c in (0, 1) if known[i, c::2].any()}
    assert got == want | {("f0000", None): 5.0, (None, "B"): 7.0}
    at = normalize.reference_values(cells, samples, "local")
    plan = physical(at)
    assert plan.count("Sort [") == 1 and plan.count("hashpartitioning") == 1 and at.columns == ["Sample", "INDEX", "v", "ref"]
    rows = at.collect()
    assert len(rows) == 40 * 6 + 4
    for q in rows:
        if q.INDEX and q.INDEX != "none" and q.Sample != "s9":
            i, c = int(q.INDEX[1:]), int(q.Sample[1:]) % 2
            mean = np.mean([*v[i, known[i]], *([5.0] if i == 0 else [])])
            assert q.ref == (v[i, c] if known[i, c] else pytest.approx(mean, rel=1e-12)), q
        else:
            assert q.ref == {"none": None, "f0000": 5.0, None: 7.0}[q.INDEX]


def test_parts_of_a_large_input_are_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_ROWS", 400)
    plan = physical(fixtures.cells(spark, SF))
    assert "hashpartitioning(part" in plan and plan.count("hashpartitioning(INDEX") == 1
    assert "BroadcastHashJoin [INDEX" not in plan and "SortMergeJoin [INDEX" in plan
