"""Hand-computed frames of a few rows, and invariants where draws or iterations decide."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantspark.operators import annotate, covariate, differential, embed, filters, impute, lfq, normalize, quality, reshape, rollup, sites


def cells(spark, table):
    """{feature: [values over samples a, b, ...]} as cells."""
    return spark.createDataFrame([(f, "abcdefgh"[i], v) for f, of in table.items() for i, v in enumerate(of)], "INDEX string, Sample string, v double")


def samples(spark, conditions):
    return spark.createDataFrame([("abcdefgh"[i], c, i + 1) for i, c in enumerate(conditions)], "Sample string, CONDITION string, REPLICATE long")


def values(df, *columns):
    return {(r.INDEX, r.Sample): tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def close(a, b):
    return a.keys() == b.keys() and all((v is None) == (b[k] is None) and (v is None or math.isclose(v, b[k], rel_tol=1e-9, abs_tol=1e-9)) for k, v in a.items())


def long(spark, rows):
    return spark.createDataFrame(rows, "INDEX string, FILENAME string, SIGNAL double, PEPTIDE_LSEQ string, CHARGE int")


def test_roll_ups(spark):
    df = long(spark, [("p", "r", 1.0, "_A_", 1), ("p", "r", 5.0, "B", 1), ("p", "r", 5.0, "C", 2), ("p", "r", 2.0, "D", 2), ("p", "r", None, "E", 2), ("q", "r", None, "A", 1)])
    got = {m: {r.INDEX: r.raw for r in rollup.roll_up(df, m).collect()} for m in rollup.AGGREGATES}
    assert {m: g["p"] for m, g in got.items()} == {"sum": 13.0, "mean": 3.25, "min": 1.0, "max": 5.0, "median": 3.5, "count": 5.0}
    assert all(g["q"] is None for g in got.values())
    assert rollup.top_n(df).first().raw == 13.0  # 5 and 5 share the first rank
    with pytest.raises(ValueError):
        rollup.aggregate_of("mode")


def test_features_and_peptides(spark):
    df = spark.createDataFrame([("p", "b", 2.0, "A", 1, "NA", "1;3"), ("p", "a", 4.0, "A", 1, None, "x"), ("p", "a", 6.0, "A", 2, "g2", None)], "INDEX string, FILENAME string, SIGNAL double, PEPTIDE_LSEQ string, CHARGE int, GENE_NAMES string, IBAQ string")
    f = rollup.features(df, ["GENE_NAMES"], ["FILENAME", "SIGNAL"]).first()
    assert (f.GENE_NAMES, f.PRECURSORS_USED, f.IBAQ_MEAN) == ("g2", 2, 2.0)
    pep = {r.Sample: (r.PEPTIDE_ID, r.raw, round(r.centred, 4)) for r in rollup.peptide_cells(df).collect()}
    assert pep == {"a": ("p|A", 10.0, 1.6667), "b": ("p|A", 2.0, 0.3333)}


def test_lfq_keeps_totals_and_ratios(spark):
    df = long(spark, [("p", s, base * f, ion, 2) for ion, base in (("A", 100.0), ("B", 7.0), ("C", 30.0)) for s, f in (("r1", 1.0), ("r2", 2.0), ("r3", 4.0)) if (ion, s) != ("C", "r1")])
    got = {r.Sample: r.raw for r in lfq.lfq(df).collect()}
    assert math.isclose(got["r2"] / got["r1"], 2, rel_tol=1e-9) and math.isclose(got["r3"] / got["r2"], 2, rel_tol=1e-9)
    assert math.isclose(sum(got.values()), df.agg(F.sum("SIGNAL")).first()[0], rel_tol=1e-9)
    assert lfq.lfq(long(spark, [("p", "r", None, "A", 1), ("p", "r", -1.0, "B", 1)])).count() == 0


def test_filters(spark):
    df = spark.createDataFrame([("a; bad", 0.001, 5, 1.0), ("ok", 0.02, 9, 9.0), (None, None, None, 3.0), ("fine", 0.01, 2, None)], "INDEX string, QVALUE double, PRECURSORS_EXP long, SIGNAL double")
    bad = spark.createDataFrame([("bad",)], "accession string")
    assert {r.INDEX for r in filters.contaminants(df, bad).collect()} == {"ok", "fine"}
    assert {r.INDEX for r in filters.score_filter(df, "QVALUE", 0.01).collect()} == {"a; bad", "fine"}
    assert filters.score_filter(df, "ABSENT", 1).count() == 4 and filters.evidence_filter(df, 0).count() == 4 and filters.evidence_filter(df, 5).count() == 2
    assert filters.evidence_filter(df.withColumn("PRECURSORS_EXP", F.lit(None).cast("long")), 5).count() == 4
    assert filters.censor(df, 2.0).filter("SIGNAL IS NULL").count() == 2
    main, cov = filters.split_covariate(df.withColumn("IS_COVARIATE", F.when(F.col("INDEX") == "ok", True)))
    assert (main.count(), cov.count()) == (3, 1)
    with pytest.raises(ValueError):
        filters.score_filter(df, "QVALUE", 1, "sideways")


def test_reshaping(spark):
    wide = spark.createDataFrame([("x", 1.0, None, 3, 4), ("y", 2.0, 5.0, 1, 1)], "ID string, `A_2 Intensity` double, `A_9 Intensity` double, `A_2 Spectral Count` int, `A_9 Spectral Count` int")
    rows = {(r.ID, r.FILENAME): (r.SIGNAL, r.SPECTRAL_COUNTS, r.CONDITION, r.REPLICATE) for r in reshape.unpivot_labels(wide, counts="Spectral Count").collect()}
    assert rows == {("x", "A_2"): (1.0, 3.0, "A", 1), ("x", "A_9"): (None, 4.0, "A", 2), ("y", "A_2"): (2.0, 1.0, "A", 1), ("y", "A_9"): (5.0, 1.0, "A", 2)}
    odd = reshape.unpivot_labels(wide.select("ID", "A_2 Intensity", F.col("A_9 Intensity").alias("pool Intensity")))
    assert {(r.CONDITION, r.REPLICATE) for r in odd.collect()} == {("NA", 1)}
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("2", 3.5), ("z", 1.0)], "i string, d double")
    assert [tuple(r) for r in reshape.relaxed_union([a, b]).orderBy("d").collect()] == [(1, "x", None), (None, None, 1.0), (2, None, 3.5)]
    with pytest.raises(ValueError):
        reshape.rename(spark.createDataFrame([(1, 2)], "q int, QVALUE int"), {"qvalue_column": "q"})


def test_annotation(spark):
    note = spark.createDataFrame([("f1", "A", None), ("f2", "A", None), ("f3", "B", "7")], "FILENAME string, CONDITION string, REPLICATE string")
    assert {(r.FILENAME, r.REPLICATE) for r in annotate.infer_replicates(note).collect()} == {("f1", 1), ("f2", 2), ("f3", 7)}
    with pytest.raises(ValueError, match="f4"):
        annotate.check_runs(spark.createDataFrame([("f1",), ("f4",)], "FILENAME string"), note)
    with pytest.raises(ValueError, match="REPLICATE"):
        annotate.check_complete(note, "CONDITION", "REPLICATE")


def site_rows(spark):
    row = lambda start, places, positions, probs, declared="x": ("P1", "PEP", start, places, positions, probs, declared)
    rows = [row("10", "(S12,T14)(C3)", "3;5", "0.9;20"), row("471;471", "(S473)", "3", "1.0"), row("10", "(S12)", "4", "0.9"), row("10", "(S12)", "3", " "), row("10", "(S12)", "3", "0.0"), row("10", "(S12)", "3", "0.5", " ")]
    return spark.createDataFrame(rows, "UNIPROT string, PEP_SEQUENCE string, PEPTIDE_START string, PTM_PROTEINLOCATIONS string, PTM_POSITIONS_STR string, PTM_PROBS_STR string, PTM_SITES_STR string")


def test_sites(spark):
    show = lambda df: sorted((r.INDEX, r.PEPTIDE_INDEX, r.LOC_PROB) for r in df.collect())
    key = lambda x: [(a, b, -1 if c is None else c) for a, b, c in x]
    cross = key(show(sites.site_index(site_rows(spark).filter("PTM_PROBS_STR <> ' '"))))
    assert cross == [("P1|S12", "PEP|p3", 0.2), ("P1|S12", "PEP|p3", 0.9), ("P1|T14", "PEP|p5", 0.2), ("P1|T14", "PEP|p5", 0.9)]
    own = key(show(sites.site_index(site_rows(spark).filter("PTM_PROBS_STR <> ' '"), pairing="aligned")))
    assert own == [("P1|S12", "PEP|p3", 0.9), ("P1|S473", "PEP|p3", 1.0), ("P1|T14", "PEP|p5", 0.2)]
    retain = {(r.INDEX, r.PEPTIDE_INDEX) for r in sites.site_index(site_rows(spark), "retain").collect()}
    assert retain == {("P1|S12,T14", "PEP|p3,5"), ("P1|S473", "PEP|p3"), ("P1|S12", "PEP|p3")}
    with pytest.raises(ValueError):
        sites.site_index(site_rows(spark), "split")


def test_normalization(spark):
    c = cells(spark, {"x": [1.0, 2.0, None], "y": [3.0, 6.0, None], "z": [5.0, 10.0, None]})
    got = values(normalize.median_equalization(c), "v")
    assert got["x", "a"] == pytest.approx(1.0 * 4.0 / 3.0) and got["z", "b"] == pytest.approx(10.0 * 4.0 / 6.0) and got["x", "c"] is None
    assert values(normalize.log_transform(cells(spark, {"x": [8.0, 0.0, None]})), "v")["x", "a"] == 3.0
    q = values(normalize.quantile_uniform(cells(spark, {f: [v] for f, v in zip("stuvw", (5.0, 1.0, 3.0, 3.0, 9.0), strict=True)})), "v")
    assert [round(q[f, "a"], 3) for f in "tuvsw"] == [0.0, 0.375, 0.375, 0.75, 1.0]
    few = values(normalize.quantile_uniform(cells(spark, {f: [v] for f, v in zip("stu", (0.0, 1.0, 10.0), strict=True)})), "v")
    assert [few[f, "a"] for f in "stu"] == [0.0, 0.5, 1.0]
    with pytest.raises(ValueError):
        normalize.normalize(c, "zscore", samples(spark, "AAB"))


def noisy(spark, n=60):
    r = np.random.default_rng(3)
    level = r.uniform(10, 20, n)
    tilt = [0.0, 0.1, -0.05, 0.02, 0.0, 0.07]
    return cells(spark, {f"f{i}": [None if r.random() < 0.15 else float(level[i] * (1 + t) + r.normal(0, 0.05)) for t in tilt] for i in range(n)}), samples(spark, "AAABBB")


@pytest.mark.parametrize("method", ["global_linear", "local_linear", "global_loess"])
def test_regression_takes_out_a_trend(spark, method):
    c, s = noisy(spark)
    spread = lambda df: df.groupBy("INDEX").agg(F.stddev_samp("v").alias("d")).agg(F.avg("d")).first()[0]
    done = normalize.normalize(c, method, s)
    assert spread(done) < 0.6 * spread(c) and done.filter("v IS NULL").count() == c.filter("v IS NULL").count()
    assert close(values(done, "v"), values(normalize.normalize(c.repartition(7), method, s), "v"))


@pytest.mark.parametrize("method", [m for m in impute.IMPUTERS if m not in ("rf", "randomforest")])
def test_imputers_fill_gaps_and_keep_the_rest(spark, method):
    c, s = noisy(spark, 30)
    c = c.unionByName(cells(spark, {"empty": [None] * 6, "flat": [12.0, 12.0, None, 12.0, 12.0, 12.0]})).persist()
    before, after = values(c, "v"), values(impute.impute(c, s, method), "v", "imputed")
    assert before.keys() == after.keys()
    assert all(v is not None and math.isfinite(v) for v, _ in after.values())
    assert all((v, f) == (before[k], False) if before[k] is not None else f for k, (v, f) in after.items())
    assert close({k: v for k, (v, _) in after.items()}, values(impute.impute(c.repartition(7), s, method), "v"))


def test_condition_median_stays_in_bounds(spark):
    c, s = noisy(spark, 40)
    bounds = {(r.INDEX, r.CONDITION): r for r in impute.condition_bounds(c, s).collect()}
    lod = impute.detection_limit(c).first().lod
    for (f, sample), (v, imputed) in values(impute.condition_median(c, s), "v", "imputed").items():
        b = bounds[f, "A" if sample in "abc" else "B"]
        assert not imputed or (b.lower <= v <= b.upper if b.n else v <= lod)


def test_boosted_trees_fill(spark):
    c, s = noisy(spark, 40)
    done = values(impute.boosted(c, rounds=1, depth=2, trees=3), "v", "imputed")
    assert all(v is not None for v, _ in done.values())


def test_bh_with_ties_nulls_and_bins(spark):
    rng = np.random.default_rng(5)
    groups = {"c": [0.01, 0.01, 0.04, 0.03, None, 0.9, 1.0, 1.0], "one": [0.2], "none": [None, None], None: [0.5, 0.001]}
    groups["many"] = [0.0, 0.0, 1e-305, *(10 ** -rng.uniform(0, 12, 300)), *[1.0] * 150, *rng.uniform(0, 1, 200).round(2)]
    df = spark.createDataFrame([(c, i, v, v and v / 2) for c, ps in groups.items() for i, v in enumerate(map(lambda v: v if v is None else float(v), ps))], "contrast string, i int, p double, r double")

    def want(ps):
        known = np.sort([p for p in ps if p is not None])
        share = known * len(known) / np.searchsorted(known, known, "right")
        low = np.minimum(1, np.minimum.accumulate(share[::-1])[::-1]) if len(known) else known
        return dict(zip(known.tolist(), low.tolist()))

    for q in (differential.bh(df), differential.bh(df, ("p", "r"), ("q", "s")), differential.bh(df, bins=1, most=0), differential.bh(df, ("p", "r"), ("q", "s"), bins=3, most=0)):
        assert q.count() == df.count()
        for c, ps in groups.items():
            of = want(ps)
            for r in q.filter(F.col("contrast").eqNullSafe(F.lit(c))).collect():
                assert r.q is None if r.p is None else r.q == pytest.approx(of[r.p], abs=1e-12)
                if "s" in q.columns and r.p is not None:
                    assert r.s == pytest.approx(of[r.p] / 2 if of[r.p] < 1 else r.s, abs=1e-12)


def test_bh_bins_hold_few_distinct_values(spark):
    df = spark.range(20_000).select(F.lit("c").alias("contrast"), F.when(F.col("id") % 3 == 0, 1.0).otherwise((F.col("id") + 1) / 20_001).alias("p"))
    bins = df.distinct().groupBy(F.floor(F.ln("p") * 1000)).count().agg(F.max("count")).first()[0]
    assert bins < 60  # a third of all rows is one value, and no bin has more than a thousandth of the others' range
    assert differential.bh(df, most=0).filter("p = 1").select("q").distinct().collect() == [(1.0,)]


def test_differential_against_numpy(spark):
    table = {"x": [1.0, 1.2, 0.9, 2.0, 2.2, 2.1], "y": [5.0, 5.0, 5.0, 5.0, 5.0, 5.0], "z": [3.0, 4.0, 5.0, 3.5, 4.5, 5.5]}
    c, s = cells(spark, table), samples(spark, "AAABBB")
    contrasts = differential.contrast_table(s)
    got = {r.INDEX: r for r in differential.contrast_stats(c, s, contrasts).collect()}
    for f in ("x", "z"):
        a, b = np.array(table[f][:3]), np.array(table[f][3:])
        s2 = (a.var(ddof=1) + b.var(ddof=1)) / 2
        assert got[f].log2fc == pytest.approx(a.mean() - b.mean()) and got[f].t == pytest.approx((a.mean() - b.mean()) / math.sqrt(s2 * 2 / 3))
    assert got["y"].t is None and got["y"].p is None and got["y"].log2fc == 0
    none = spark.createDataFrame([(f, k, 0 if f == "z" else 3) for f in table for k in "AB"], "INDEX string, CONDITION string, n_observed long")
    done = {r.INDEX: r for r in differential.differential(c, s, contrasts, none).collect()}
    assert (done["z"].log2fc, done["z"].p, done["z"].q, done["z"].se) == (0.0, 1.0, 1.0, math.inf) and done["x"].q_mod <= 1
    assert differential.differential(c, samples(spark, "AAABBC"), contrasts).columns == ["INDEX", "contrast", "log2fc"]


def test_contrast_names():
    pairs = differential.contrast_pairs
    assert [p[0] for p in pairs(["b", "a", "c"])] == ["a_vs_b", "a_vs_c", "b_vs_c"]
    assert pairs(["a", "b"], only_contrasts=["b_v_a"]) == [("b_vs_a", "b", "a")] and pairs(["a", "b", "c"], only_against="b") == [("a_vs_b", "a", "b"), ("c_vs_b", "c", "b")]
    with pytest.raises(ValueError):
        pairs(["a"], only_against="z")


def test_moderation_shrinks_towards_the_prior(spark):
    r = np.random.default_rng(1)
    df = 4
    true = 0.5 / r.chisquare(8, 4000) * 8
    s2 = true * r.chisquare(df, 4000) / df
    d0, s0 = differential.moderation(spark.createDataFrame([(str(i), float(v), df) for i, v in enumerate(s2)], "INDEX string, s2 double, df long"))
    assert 6 < d0 < 11 and 0.42 < s0 < 0.58
    assert math.isinf(differential.moderation(spark.createDataFrame([("a", 1.0, 4), ("b", 1.0, 4)], "INDEX string, s2 double, df long"))[0])


def test_covariate_parts_add_up(spark):
    r = np.random.default_rng(5)
    rows = [(f"f{i}", "abcdef"[j], float(r.normal()), float(r.normal()) if i else None) for i in range(12) for j in range(6)]
    c, s = spark.createDataFrame(rows, "INDEX string, Sample string, v double, c double"), samples(spark, "AAABBB")
    for mode in covariate.MODES:
        for x in covariate.covariate_differential(c, s, differential.contrast_table(s), mode=mode)[0].collect():
            assert x.raw_log2fc == pytest.approx(x.log2fc + x.covariate_part) and (x.INDEX != "f0" or x.covariate_part == 0)


def test_pca_reproduces_the_gram_matrix(spark):
    r = np.random.default_rng(7)
    x = r.normal(size=(40, 6))
    x -= x.mean(1, keepdims=True)
    c = cells(spark, {f"f{i}": [float(v) for v in row] for i, row in enumerate(x)})
    scores, shares = embed.pca(embed.feature_centred(c))
    z = np.zeros((6, 5))
    for q in scores.collect():
        z["abcdef".index(q.Sample), q.pc - 1] = q.score
    assert np.allclose(z @ z.T, x.T @ x) and sum(shares) == pytest.approx(1)
    assert embed.pca(cells(spark, {"f": [1.0, 2.0, 3.0]}), value="v")[0].count() == 0


def test_quality(spark):
    df = long(spark, [("p", "a", 1.0, "AKC", 1), ("p", "a", 3.0, "ACK", 1), ("p", "b", 1.0, "AKC", 1)])
    got = {r.Sample: (r.fraction, r.weighted) for r in quality.missed_cleavages(df).collect()}
    assert got == {"a": (0.5, 0.25), "b": (1.0, 1.0)}
    grid = cells(spark, {"x": [1.0, None, None, None]}).withColumnRenamed("v", "raw")
    assert {r.CONDITION: (r.n_missing, r.n_observed) for r in quality.missing_counts(grid, samples(spark, "AABB")).collect()} == {"A": (1, 1), "B": (2, 0)}
