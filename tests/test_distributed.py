"""Quantiles, sample products, feature neighbours and covariate fits: forced to split, against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantspark.operators import covariate, differential, embed, impute, local_fits, neighbours, normalize, products, quantiles


def frame(spark, groups):
    return spark.createDataFrame([(g, float(v) if v is not None else None) for g, of in groups.items() for v in of], "g string, v double").repartition(5)


def awkward():
    r = np.random.default_rng(1)
    return {
        "normal": r.normal(size=700), "spread": 10.0 ** r.uniform(-300, 300, 600), "ties": r.integers(0, 4, 800), "one value": [7.0] * 500, "hot value": [*[1.0] * 480, *r.normal(size=60)],
        "small": [3.0, 1.0], "alone": [5.0], "signed": [*(-(10.0 ** r.uniform(-5, 5, 300))), *(10.0 ** r.uniform(-5, 5, 300)), 0.0, -0.0], "nothing": [None] * 9,
    }


@pytest.mark.parametrize("most", [5, 10_000])
def test_quantiles_are_those_of_a_sort(spark, most):
    groups, shares = awkward(), [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    got = {(r.g, r.k): r.q for r in quantiles.quantile_table(frame(spark, groups), ["g"], "v", shares, most).collect()}
    assert {g for g, _ in got} == set(groups) - {"nothing"}
    for (g, k), q in got.items():
        assert q == pytest.approx(np.quantile(np.array(groups[g], float), shares[k]), rel=1e-12, abs=1e-300)


def test_no_window_holds_more_than_a_bin(spark, monkeypatch):
    """All rows that are sorted together are counted: one bin of at most ``most`` rows each."""
    seen = []
    number = quantiles.F.row_number

    def spy():
        seen.append(True)
        return number()

    monkeypatch.setattr(quantiles.F, "row_number", spy)
    df = spark.range(20_000).select(F.lit("all").alias("g"), F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("double").alias("v"))
    calls = []
    stored = quantiles.stored

    def keep(frame, name):
        out = stored(frame, name)
        if name == "quantile-bins":
            calls.append(out)
        return out

    monkeypatch.setattr(quantiles, "stored", keep)
    got = {r.k: r.q for r in quantiles.quantile_table(df, ["g"], "v", [i / 20 for i in range(21)], 100).collect()}
    values = np.sort([r.v for r in df.collect()])
    assert all(got[i] == pytest.approx(np.quantile(values, i / 20)) for i in range(21)) and seen
    assert calls[0].count() == 20_000 and calls[-1].count() < 20_000  # each pass keeps the wanted bins alone
    sizes = calls[-1].groupBy("_bin", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100


def test_named_quantiles_without_groups(spark):
    df = frame(spark, {"a": [1.0, 2.0, 3.0, 4.0]})
    assert quantiles.quantiles(df, [], "v", m=0.5).collect() == quantiles.quantiles(df, [], "v", most=2, m=0.5).collect()
    assert quantiles.quantiles(df.filter("v > 9"), [], "v", m=0.5).first().m is None and quantiles.quantiles(df.filter("v > 9"), ["g"], "v", m=0.5).count() == 0


def cells(spark, x, gaps=0.0, seed=3):
    r = np.random.default_rng(seed)
    x = np.where(r.random(x.shape) < gaps, np.nan, x)
    rows = [(f"f{i:03d}", f"s{j:02d}", None if np.isnan(v) else float(v)) for i, row in enumerate(x) for j, v in enumerate(row)]
    return x, spark.createDataFrame(rows, "INDEX string, Sample string, v double").repartition(6)


def test_normalizers_agree_with_small_bins(spark, monkeypatch):
    _, c = cells(spark, np.random.default_rng(2).normal(20, 3, (90, 4)), 0.2)
    run = lambda: [{(r.INDEX, r.Sample): r.v for r in f(c).collect()} for f in (normalize.median_equalization, lambda x: normalize.quantile_uniform(x, most=30), impute.min_det, impute.min_prob)]
    plain = run()
    monkeypatch.setattr(quantiles.quantile_table, "__defaults__", (20,))
    monkeypatch.setattr(quantiles.quantiles, "__defaults__", (20,))
    for a, b in zip(plain, run(), strict=True):
        assert a.keys() == b.keys() and all((v is None and b[k] is None) or math.isclose(v, b[k], rel_tol=1e-12) for k, v in a.items())


def test_products_against_numpy(spark):
    x, c = cells(spark, np.random.default_rng(4).normal(1000, 1, (60, 5)), 0.3)
    known, zero = ~np.isnan(x), np.nan_to_num(x)
    got = {(r.a, r.b): r for r in products.sample_products(c).collect()}
    for i in range(5):
        for j in range(5):
            r, both = got[f"s{i:02d}", f"s{j:02d}"], known[:, i] & known[:, j]
            assert r.n == both.sum() and r.x == pytest.approx(zero[both, i].sum()) and r.xy == pytest.approx((zero[both, i] * zero[both, j]).sum())
    dist = {(r.a, r.b): r.dist for r in embed.euclidean(c).collect()}
    corr = {(r.a, r.b): r.dist for r in embed.correlation_distance(c).collect()}
    for i in range(5):
        for j in range(5):
            both, key = known[:, i] & known[:, j], (f"s{i:02d}", f"s{j:02d}")
            assert dist[key] == pytest.approx(math.sqrt(((x[both, i] - x[both, j]) ** 2).sum()), rel=1e-9)
            assert corr[key] == pytest.approx(0 if i == j else 1 - np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)
    assert products.sample_products(c.limit(0)).count() == 0


def test_products_join_no_feature_with_itself(spark):
    _, c = cells(spark, np.ones((3, 2)))
    plan = embed.gram(c.withColumnRenamed("v", "centred"))._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan.split("Physical Plan")[-1] and "Generate explode" not in plan


@pytest.mark.parametrize(("measure", "needs"), [(neighbours.EUCLIDEAN, True), (neighbours.CORRELATION, False)])
def test_neighbours_of_blocks_are_those_of_all_pairs(spark, measure, needs):
    r = np.random.default_rng(6)
    base = r.normal(0, 1, (4, 8))
    x, c = cells(spark, np.vstack([base[i % 4] * (1 + i % 3) + 10 * (i % 4) + r.normal(0, 0.05, 8) for i in range(120)]), 0.15)
    found, pairs = neighbours.feature_donors(c, 3, measure, needs, block=15)
    d = measure.distances(x, x)
    np.fill_diagonal(d, np.inf)
    want = set()
    for i in range(len(x)):
        for j in np.flatnonzero(np.isnan(x[i])):
            order = [int(k) for k in np.lexsort((np.arange(len(x)), d[i])) if np.isfinite(d[i, k]) and (not needs or not np.isnan(x[k, j]))]
            want |= {(f"f{i:03d}", f"s{j:02d}", f"f{k:03d}", n) for n, k in enumerate(order[:3], 1)}
    assert {(r.INDEX, r.Sample, r.donor, r["rank"]) for r in found.collect()} == want
    p = pairs.first()
    assert p.pairs == 8 * 7 and p.met <= p.pairs
    if needs:
        assert p.met < 0.7 * p.pairs  # features of other levels never meet


def fits_by_hand(v, c, side, slope=1.0):
    r = v - slope * (c - c.mean())
    out = {}
    for name, y in (("", r), ("raw_", v), ("covariate_", c)):
        a, b = y[side], y[~side]
        s2 = (((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()) / (len(y) - 2)
        out[f"{name}log2fc"], out[f"{name}t"] = a.mean() - b.mean(), (a.mean() - b.mean()) / math.sqrt(s2 * (1 / side.sum() + 1 / (~side).sum()))
    return out


@pytest.mark.parametrize("mode", covariate.MODES)
def test_three_fits_from_one_pass(spark, mode):
    r = np.random.default_rng(7)
    v, c = r.normal(20, 1, (30, 6)), r.normal(0, 1, (30, 6))
    c[3], v[5] = 2.0, v[5, 0]  # a flat covariate, a flat feature
    rows = [(f"f{i}", f"s{j}", float(v[i, j]), float(c[i, j]), None if i == 1 else 1.0, None if i == 2 and j < 3 else 1.0) for i in range(30) for j in range(6)]
    df = spark.createDataFrame(rows, "INDEX string, Sample string, v double, c double, raw double, rc double")
    s = spark.createDataFrame([(f"s{j}", "AB"[j > 2]) for j in range(6)], "Sample string, CONDITION string")
    out, fitted = covariate.covariate_differential(df, s, differential.contrast_table(s), raw="raw", raw_covariate="rc", mode=mode)
    got, slopes = {x.INDEX: x for x in out.collect()}, {x.INDEX: x for x in fitted.collect()}
    side = np.arange(6) < 3
    ridge = 1e-6 * np.median([((row - row.mean()) ** 2).sum() for i, row in enumerate(c) if i != 3])
    for i in range(30):
        x, k, centred = got[f"f{i}"], slopes[f"f{i}"], c[i] - c[i].mean()
        b1 = 0.0 if i == 3 else float((centred * v[i]).sum() / ((centred**2).sum() + ridge))
        assert k.b1 == pytest.approx(b1, abs=1e-9) and k.slope == pytest.approx({"fixed1": 1.0, "nonneg": max(b1, 0.0), "free": b1}[mode], abs=1e-9)
        want = fits_by_hand(v[i], c[i], side, k.slope) if i not in (3, 5) else {}
        if i == 1:
            assert x.masked and (x.log2fc, x.t, x.p, x.q, x.se) == (0.0, 0.0, 1.0, 1.0, math.inf) and x.raw_p == 1.0
            continue
        for name, value in want.items():
            expect = want["raw_log2fc"] if i == 2 and name == "log2fc" else value
            assert x[name] == pytest.approx(expect, rel=1e-7), (i, name)
        assert x.informed == (i != 2) and x.covariate_part == pytest.approx(0.0 if i == 2 else k.slope * (c[i, :3].mean() - c[i, 3:].mean()), abs=1e-9)
        assert x.log2fc + x.covariate_part == pytest.approx(x.raw_log2fc, abs=1e-9)
        if i == 2:
            assert (x.p_mod, x.q_mod) == (x.raw_p_mod, x.raw_q_mod)


def test_covariate_with_gaps(spark):
    r = np.random.default_rng(8)
    v, c = r.normal(20, 1, 8), r.normal(0, 1, 8)
    c[[1, 6]] = np.nan
    df = spark.createDataFrame([("f", f"s{j}", float(v[j]), None if np.isnan(c[j]) else float(c[j])) for j in range(8)], "INDEX string, Sample string, v double, c double")
    s = spark.createDataFrame([(f"s{j}", "AB"[j > 3]) for j in range(8)], "Sample string, CONDITION string")
    x = covariate.covariate_differential(df, s, differential.contrast_table(s))[0].first()
    y = v - np.nan_to_num(c - np.nanmean(c))
    a, b = y[:4], y[4:]
    s2 = (a.var(ddof=1) + b.var(ddof=1)) / 2
    assert x.log2fc == pytest.approx(a.mean() - b.mean()) and x.t == pytest.approx((a.mean() - b.mean()) / math.sqrt(s2 / 2))
    assert {r.Sample: r.adjusted for r in covariate.adjusted(df, covariate.slopes(covariate.group_moments(df, s))).collect()} == pytest.approx({f"s{j}": y[j] for j in range(8)})


def test_priors_of_several_kinds(spark):
    r = np.random.default_rng(9)
    rows = [(k, f"f{i}", float(0.5 / r.chisquare(8) * 8 * r.chisquare(4) / 4 * scale), 4) for k, scale in (("x", 1.0), ("y", 9.0)) for i in range(500)]
    df = spark.createDataFrame(rows, "series string, INDEX string, s2 double, df long")
    both = {p["series"]: (p["d0"], p["s0"]) for p in differential.priors(df, ["series"])}
    for k in "xy":
        assert both[k] == pytest.approx(differential.moderation(df.filter(F.col("series") == k)))


def test_store_is_sorted_and_opens_again(spark, tmp_path):
    from quantspark.plans.pipeline import Results
    from quantspark.sources import store

    rows = [(f"f{i:04d}", f"s{j}", float(i * j)) for i in range(2000) for j in range(4)]
    cells = spark.createDataFrame(rows, "INDEX string, Sample string, v double").repartition(7)
    samples = spark.createDataFrame([(f"s{j}", "A") for j in range(4)], "Sample string, CONDITION string")
    stats = cells.select("INDEX", F.lit("A_vs_B").alias("contrast"), F.col("v").alias("p"))
    folder = str(tmp_path / "store")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        Results(cells, samples, cells.select("INDEX").distinct(), stats=stats, extra={"diagnostics": spark.range(3).toDF("n")}).save(folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(f"{folder}/cells").groupBy(F.input_file_name().alias("f")).agg(F.min("INDEX").alias("a"), F.max("INDEX").alias("b")).orderBy("a").collect()
    assert len(files) > 1 and all(x.b <= y.a for x, y in zip(files, files[1:]))
    again = Results.open(spark, folder)
    assert sorted(map(tuple, again.cells.collect())) == sorted(rows) and again.extra["diagnostics"].count() == 3 and again.contrasts is None
    one = again.feature("f0007")
    assert {r.Sample for r in one["cells"].collect()} == {"s0", "s1", "s2", "s3"} and one["stats"].count() == 4
    assert "PushedFilters: [IsNotNull(INDEX), EqualTo(INDEX,f0007)]" in one["cells"]._jdf.queryExecution().toString()
    store.check_store(spark, folder)
    spark.createDataFrame(rows[:5], "INDEX string, Sample string, v double").write.mode("overwrite").parquet(f"{folder}/cells")
    with pytest.raises(ValueError, match="should be there"):
        store.check_store(spark, folder)
    spark.createDataFrame([], "name string").write.mode("overwrite").json(f"{folder}/manifest")
    with pytest.raises(ValueError, match="finished store"):
        Results.open(spark, folder)


@pytest.mark.parametrize("span", [0.9, 0.2])
def test_loess_of_large_samples_is_the_fit_on_all_points(spark, monkeypatch, span):
    """A sample's size decides where it is fitted, not what: blocks give what one task gives, with ties, a tail and few distinct values too."""
    monkeypatch.setattr(local_fits, "BLOCK", 40)
    r = np.random.default_rng(8)
    v = np.stack([r.normal(20, 2, 500), np.round(r.normal(20, 2, 500)), 20 - r.exponential(1, 500) ** 2, r.integers(0, 2, 500) * 3.0], 1)
    v[r.random(v.shape) < 0.1] = np.nan
    _, c = cells(spark, v)
    s = spark.createDataFrame([(f"s{j:02d}", "A") for j in range(4)], "Sample string, CONDITION string")
    one, blocks = ({(x.INDEX, x.Sample): x.v for x in normalize.loess(c, s, span=span, exact=n).collect()} for n in (500, 100))
    assert len(one) == 2000 and one.keys() == blocks.keys()
    assert all((one[k] is None) == (blocks[k] is None) and (one[k] is None or abs(one[k] - blocks[k]) < 1e-8) for k in one)


def test_search_moves_no_candidates(spark, monkeypatch):
    """What a block finds is done: no pair of blocks and no candidate is shuffled, and k rows a gap are all that there is."""
    _, c = cells(spark, np.random.default_rng(4).normal(0, 1, (90, 6)), 0.2)
    found, _ = neighbours.feature_donors(c, 3, neighbours.EUCLIDEAN, True, block=15)
    assert "Exchange" not in found._jdf.queryExecution().toString().split("Physical Plan")[-1]
    assert found.count() == 3 * c.filter("v IS NULL").count()


@pytest.mark.parametrize("fill", [impute.knn_features, impute.knn_correlated])
def test_fills_are_a_row_a_feature(spark, monkeypatch, fill):
    _, c = cells(spark, np.random.default_rng(4).normal(0, 1, (90, 6)), 0.2)
    rows, store = {}, neighbours.stored

    def counted(df, name):
        out = store(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neighbours, "stored", counted)
    monkeypatch.setattr(impute, "stored", counted)
    out = fill(c, 3)
    assert out.filter("v IS NULL").count() == 0 and out.filter("imputed").count() == c.filter("v IS NULL").count()
    assert max(rows.values()) <= 2 * 90  # features, and a mark a block


def test_q_values_are_found_where_p_values_lie(spark, monkeypatch):
    """Files of five p-values give what a sort of each code gives, with ties, zeros, ones and nulls."""
    monkeypatch.setattr(differential, "PART", 5)
    r = np.random.default_rng(2)
    p = {0: r.random(40), 1: np.round(r.random(40), 1), 2: np.array([0.0, 0.0, 1e-300, 0.3, 1.0, 1.0]), 3: np.array([0.2])}
    rows = [(i * 4 + c, float(x)) for c, of in p.items() for i, x in enumerate(of)] + [(1_000, None)]
    got = {x.key: x.q for x in differential.bh_values(spark.createDataFrame(rows, "key long, p double").repartition(3), 4, len(rows)).collect()}
    for c, of in p.items():
        share = of * len(of) / np.array([(of <= x).sum() for x in of])
        for i, x in enumerate(of):
            assert (i * 4 + c in got) == (0 < x < 1) and (not 0 < x < 1 or got[i * 4 + c] == pytest.approx(min(1.0, share[of >= x].min()), rel=1e-12))


def test_three_fits_store_a_row_a_feature(spark, monkeypatch):
    """Fits and contrasts are neither written nor sorted: of them p-values alone move."""
    r = np.random.default_rng(7)
    _, c = cells(spark, r.normal(20, 2, (60, 6)))
    fanned = spark.createDataFrame([(f"f{i:03d}", f"s{j:02d}", float(r.normal()), 1.0) for i in range(60) for j in range(6)], "INDEX string, Sample string, c double, raw_covariate double")
    s = spark.createDataFrame([(f"s{j:02d}", "ABC"[j % 3]) for j in range(6)], "Sample string, CONDITION string")
    at = covariate.with_imputed(c, fanned)
    assert at.count() == 360
    rows, store = {}, covariate.stored

    def counted(df, name):
        out = store(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(covariate, "stored", counted)
    out, _ = covariate.covariate_differential(at, s, differential.contrast_table(s), moderate=False)
    assert rows == {"moments": 60} and out.count() == 60 * 3
    assert "Window" not in out._jdf.queryExecution().toString().split("Physical Plan")[-1]
