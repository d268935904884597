import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantspark.functions import numeric, sequence
from quantspark.schema import analysis_type, nan_to_null, require


def one(spark, column, *values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_sequences(spark):
    assert one(spark, sequence.strip_modifications, "_n[42.0106]PEPM[Oxidation (M)]Kc[-0.9840]_", "A(ph)C", None) == ["PEPMK", "AphC", None]
    assert one(spark, sequence.peptide_index, "_AM[Oxidation (M)]C[57.0215]_", None) == ["AMC[57.0215]", None]
    assert one(spark, lambda c: sequence.peptide_index(c, collapse_all=True), "_n[42.0106]AM[Oxidation (M)]C[57.0215]_") == ["AMC"]
    named = one(spark, sequence.name_numeric_modifications, "n[42.010565]AM[15.99490]C[57.021464]S[79.9663]K[x]", "PEP", "", None)
    assert named == ["n[Acetyl (Protein N-term)]AM[Oxidation (M)]C[Carbamidomethyl (C)]S[79.9663]K[x]", "PEP", "", None]
    assert one(spark, sequence.missed_cleavage, "PEPKPR", "PEPKAR", "_AR[x]K_", "K", None) == [False, True, True, None, None]
    assert one(spark, sequence.strip_extension, " a.raw ", "b.mzML", "c.D", "d.raw.d", "e.txt") == ["a", "b", "c", "d.raw", "e.txt"]
    assert one(spark, sequence.clean_label, "MIDDLE EAST", " 1x", "  ", None, "a-b") == ["MIDDLE_EAST", "C_1x", "C_UNLABELED", "C_UNLABELED", "a_b"]


def test_lists(spark):
    assert one(spark, sequence.first_double, "1.5;2", "", "x;1", None) == [1.5, None, None, None]
    assert one(spark, sequence.first_long, "471;471", "3.0") == [471, 3]
    assert one(spark, sequence.doubles, "1;x;2.5") == [[1.0, None, 2.5]]
    assert one(spark, lambda c: sequence.array_mean(sequence.doubles(c)), "1;x;3", "x", None) == [2.0, None, None]
    assert one(spark, sequence.sites, "(S12,T5)(C3)", "none") == [["S12", "T5"], []]


def test_t_tail_against_known_values(spark):
    assert abs(numeric.t_tail(np.array(2.5), np.array(20.0)) - 0.0212335) < 1e-6
    assert abs(numeric.t_tail(np.array(12.706), np.array(1.0)) - 0.05) < 1e-4
    assert abs(numeric.t_tail(np.array(1.959964), np.array(np.inf)) - 0.05) < 1e-6
    assert np.isnan(numeric.t_tail(np.array(1.0), np.array(0.0)))
    t = [0.0, 0.1, -1.3, 2.5, 40.0]
    for df in (2, 4, 20):
        closed = one(spark, lambda c, df=df: numeric.even_t_tail(c, df), *t, None, kind="double")
        assert closed[-1] is None and np.allclose(closed[:-1], numeric.t_tail(np.array(t), np.array(float(df))), atol=1e-9)


def test_gamma_functions():
    assert abs(numeric.digamma(1.0) + 0.5772156649015329) < 1e-12 and abs(numeric.trigamma(1.0) - math.pi**2 / 6) < 1e-12
    for x in (0.05, 0.7, 3.0, 40.0):
        assert abs(numeric.inverse_trigamma(numeric.trigamma(x)) / x - 1) < 1e-8


def test_noise_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    a, b = (sorted((r.k, r.z) for r in d.select("k", numeric.noise("k").alias("z")).collect()) for d in (df.repartition(1), df.repartition(8)))
    z = np.array([x for _, x in a])
    assert a == b and abs(z.mean()) < 0.06 and abs(z.std() - 1) < 0.06


def test_schema(spark):
    assert [analysis_type(x) for x in (None, " ", "Protein", "peptido", "phosphoproteomics")] == ["proteomics", "proteomics", "proteomics", "peptidomics", "phospho"]
    with pytest.raises(ValueError):
        analysis_type("dia")
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert nan_to_null(df).filter("x IS NULL").count() == 2
    with pytest.raises(ValueError):
        require(df, "y")
