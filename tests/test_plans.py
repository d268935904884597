"""The configured pipeline, sources, sinks, streams and the registered queries against DuckDB."""

import glob
import math
from decimal import Decimal
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quantspark.operators import normalize
from quantspark.operators.filters import FilterSettings
from quantspark.plans import pipeline, queries
from quantspark.sources import readers, sinks
from quantspark.streaming.stateless import harmonize_stream, running_roll_up

SF = "/root/testdata/sf0.001"
COLUMNS = {"index_column": "prot", "signal_column": "sig", "qvalue_column": "PG.Qvalue", "filename_column": "run", "condition_column": "cond", "replicate_column": "rep", "peptide_seq_column": "pep", "charge_column": "z", "fasta_column": "fasta", "gene_names_column": "gene"}


def raw(spark):
    rows = [(f"p{i}", float(100 * (i + 1) * (1 + (r > 2)) + 7 * r + j), 0.001 if j else 0.5, f"run{r}.raw", "AB"[r > 2], r % 3 + 1, f"_PEP{j}K_", 2, "TAG" if i < 5 else "x", "NA") for i in range(12) for r in range(6) for j in range(3) if (i + r + j) % 7]
    return spark.createDataFrame(rows, "prot string, sig double, `PG.Qvalue` double, run string, cond string, rep int, pep string, z int, fasta string, gene string")


@pytest.mark.parametrize("method", ["sum", "directlfq"])
def test_pipeline_end_to_end(spark, tmp_path, method):
    config = {
        "dataset": {"frame": raw(spark).withColumnRenamed("PG.Qvalue", "qv"), **COLUMNS, "qvalue_column": "qv"},
        "preprocessing": {"protein_rollup_method": method, "normalization": {"method": ["log2"]}, "imputation": {"method": "lc_conmed"}},
        "exports": {"path_tables": str(tmp_path / "out")},
    }
    got = pipeline.run_pipeline(spark, config)
    assert got.cells.count() == 12 * 6 and got.cells.filter("processed IS NULL").count() == 0
    assert got.stats.count() == 12 and got.stats.filter("log2fc > -0.3").count() == 0
    assert spark.read.parquet(str(tmp_path / "out/stats")).filter("contrast = 'A_vs_B'").count() == 12
    assert got.extra["pca"].select("Sample").distinct().count() == 6


def test_pipeline_rejects_unknown_names(spark):
    for pre in ({"protein_rollup_method": "mode"}, {"imputation": {"method": "guess"}}, {"normalization": {"method": "zscore"}}):
        with pytest.raises(ValueError):
            pipeline.validate({"dataset": {}, "preprocessing": pre})


def test_injected_covariate_runs(spark):
    frame = raw(spark).withColumnRenamed("PG.Qvalue", "qv").withColumn("UNIPROT", F.col("prot"))
    own = {"frame": frame, **COLUMNS, "qvalue_column": "qv"}
    df = pipeline.inject(spark, pipeline.load(spark, own), {"ft": {**own, "is_covariate": True}})
    assert {(r.IS_COVARIATE, r["count"]) for r in df.groupBy("IS_COVARIATE").count().collect()} == {(False, frame.count()), (True, frame.count())}


def test_delimited_files_and_contaminants(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("prot\tPG.Qvalue\tsig\nA\t0.01\tNA\nB\tN/A\t3\n\tNaN\tx\n")
    df = readers.read_table(spark, str(tmp_path / "t.tsv"), ["sig"])
    assert [tuple(r) for r in df.orderBy("sig").collect()].count(("B", None, 3.0)) == 1 and df.filter("prot IS NULL AND sig IS NULL").count() == 1
    (tmp_path / "c.fasta").write_text(">sp|P1|X desc\nMK\n>plain name\nAA\n>sp|P1|X\n")
    assert {r.accession for r in readers.read_contaminants(spark, [str(tmp_path / "c.fasta")]).collect()} == {"P1", "plain"}
    (tmp_path / "a.tsv").write_text("File Name\tCondition\tReplicate\nx.raw\tA\t\ny.RAW\tA\t\n")
    assert {tuple(r) for r in readers.read_annotation(spark, str(tmp_path / "a.tsv")).select("FILENAME", "CONDITION", "REPLICATE").collect()} == {("x", "A", 1), ("y", "A", 2)}
    with pytest.raises(ValueError):
        readers.read_table(spark, "x.xlsx")
    sinks.write_tables({"t": df}, str(tmp_path / "o"), "csv")
    assert glob.glob(str(tmp_path / "o/t/*.csv"))


def test_streams_give_what_batches_give(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.read.parquet(f"{SF}/lineitem.parquet").repartition(4).write.parquet(src)
    names = {"index_column": "l_partkey", "signal_column": "l_extendedprice", "qvalue_column": "l_discount", "pep_column": "l_tax", "filename_column": "l_returnflag"}
    settings = FilterSettings(0.05, 0.04)
    batch = {(r.INDEX, r.Sample): r.raw for r in running_roll_up(harmonize_stream(spark.read.parquet(src), names, settings)).collect()}
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = running_roll_up(harmonize_stream(stream, names, settings)).writeStream.outputMode("complete").format("memory").queryName("cells").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.INDEX, r.Sample): r.raw for r in spark.table("cells").collect()}
    assert got.keys() == batch.keys() and all(math.isclose(v, batch[k], rel_tol=1e-9) for k, v in got.items())


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(5).count() == 5


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def shown(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return f"{float(v) + 0.0:.5f}" if isinstance(v, int | float | Decimal) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.ORACLES])
def test_query_equals_its_sql(spark, duck, name):
    mine = queries.QUERIES[name](spark, SF)
    cursor = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(mine.columns) == sorted(names)
    theirs = sorted(tuple(shown(r[names.index(c)]) for c in sorted(names)) for r in cursor.fetchall())
    assert sorted(tuple(shown(r[c]) for c in sorted(names)) for r in mine.collect()) == theirs
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_other_queries_have_rows(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0
    spark.catalog.clearCache()


def test_loess_query_fits_every_point(spark, monkeypatch):
    r = np.random.default_rng(5)
    v = r.normal(20, 3, (2_100, 4)) + np.sin(np.arange(2_100) / 300)[:, None] * np.arange(4)
    rows = [(f"f{i}", f"s{j}", float(v[i, j])) for i in range(len(v)) for j in range(4)]
    monkeypatch.setattr(queries.fx, "logged", lambda spark, sf_dir: spark.createDataFrame(rows, "INDEX string, Sample string, v double"))
    got = {(x.INDEX, x.Sample): x.v for x in queries.QUERIES["n9_loess"](spark, SF).collect()}
    ref = v.mean(1)
    for j in range(4):
        m, a = (v[:, j] + ref) / 2, v[:, j] - ref
        for i in range(0, len(v), 60):
            near = np.argsort(np.abs(m - m[i]), kind="stable")[: math.ceil(0.9 * len(v))]
            d = m[near] - m[i]
            w = (1 - (np.abs(d) / np.abs(d).max()) ** 3) ** 1.5
            curve = np.linalg.lstsq(np.stack([w, w * d, w * d * d], 1), w * a[near], rcond=None)[0][0]
            assert math.isclose(got[f"f{i}", f"s{j}"], v[i, j] - curve, abs_tol=1e-5)


def test_large_samples_take_knots(spark):
    c = spark.createDataFrame([(f"f{i}", f"s{j}", float(10 + i / 30 + j * (i / 100) ** 2)) for i in range(300) for j in range(3)], "INDEX string, Sample string, v double")
    s = spark.createDataFrame([(f"s{j}", "A") for j in range(3)], "Sample string, CONDITION string")
    exact, by_knots = ({(x.INDEX, x.Sample): x.v for x in normalize.loess(c, s, knots=150, exact=n).collect()} for n in (300, 299))
    assert exact.keys() == by_knots.keys() and max(abs(exact[k] - by_knots[k]) for k in exact) < 0.05 and exact != by_knots


def test_component_queries_keep_all_components(spark):
    x = np.array([r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()], float).T
    x = x - x.mean(0)
    scores = queries.QUERIES["c2_pca"](spark, SF)
    assert scores.select("pc").distinct().count() == 63
    own = np.zeros((64, 63))
    for r in scores.collect():
        own[int(r.Sample[1:]), r.pc - 1] = r.score
    assert np.allclose(own @ own.T, x @ x.T, rtol=1e-3, atol=1e-2)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    got = queries.QUERIES["c3_neighbours"](spark, SF).collect()
    assert len(got) == 64 * 10 and all(abs(dist[int(r.src[1:]), int(r.dst[1:])] - r.dist) < 1e-3 for r in got)
    for i in range(64):
        last = np.sort(np.delete(dist[i], i))[9]
        assert max(r.dist for r in got if r.src == f"p{i:02d}") <= last + 1e-3
