"""Numeric functions: Student-t tails, seeded noise, digamma and its kin."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def even_t_tail(t: Column, df: int) -> Column:
    """Two-sided Student-t p-value for an even whole number of degrees of freedom, in closed form."""
    if df <= 0 or df % 2:
        raise ValueError("the closed form is for even degrees of freedom")
    theta_cos2 = F.lit(float(df)) / (F.lit(float(df)) + t * t)
    total, term = F.lit(1.0), F.lit(1.0)
    for k in range(1, df // 2):
        term = term * theta_cos2 * ((2 * k - 1) / (2 * k))
        total = total + term
    inside = F.abs(t) / F.sqrt(F.lit(float(df)) + t * t) * total
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - inside)) + F.lit(0.0) * t  # null stays null


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + top / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h *= c * d
        if np.all(np.abs(c * d - 1) < 1e-14):
            break
    return h


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma, once for each distinct value: a batch has few distinct degrees of freedom."""
    values, back = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in values])[back]


def t_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided Student-t p-values for any degrees of freedom; the normal tail where they are infinite."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(t) & (df > 0)
    large = ok & ~(df < 1e7)
    out[large] = np.vectorize(math.erfc, otypes=[float])(np.abs(t[large]) / 2**0.5) if large.any() else out[large]
    ok &= ~large
    if ok.any():
        a, b = df[ok] / 2, np.full(ok.sum(), 0.5)
        x = df[ok] / (df[ok] + t[ok] ** 2)
        front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(np.maximum(x, 1e-300)) + b * np.log(np.maximum(1 - x, 1e-300)))
        left = x < (a + 1) / (a + b + 2)
        value = np.empty_like(x)  # each side by the fraction that converges fast there
        value[left] = front[left] * _beta_fraction(a[left], b[left], x[left]) / a[left]
        value[~left] = 1 - front[~left] * _beta_fraction(b[~left], a[~left], 1 - x[~left]) / b[~left]
        out[ok] = np.clip(value, 0, 1)
    out[np.isinf(t) & (df > 0)] = 0.0
    return out


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """``t_tail`` over Arrow batches; null where t is null or the degrees of freedom aren't positive."""
    return pd.Series(t_tail(t.to_numpy(float, na_value=np.nan), df.to_numpy(float, na_value=np.nan)))


def noise(*keys: str, seed: int = 42) -> Column:
    """Standard normal noise that depends on the keys and the seed alone, not on partitions (Box-Muller of two hashes)."""

    def unit(salt: int) -> Column:
        digest = F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(str(seed)), F.lit(str(salt))))
        return (F.conv(F.substring(digest, 1, 10), 16, 10).cast("long") + 0.5) / float(1 << 40)

    return F.sqrt(-2 * F.ln(unit(1))) * F.cos(2 * math.pi * unit(2))


def digamma(x: float) -> float:
    total = 0.0
    while x < 10:
        total -= 1 / x
        x += 1
    y = 1 / (x * x)
    return total + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def trigamma(x: float) -> float:
    total = 0.0
    while x < 10:
        total += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return total + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def inverse_trigamma(value: float) -> float:
    """x with trigamma(x) = value, by Newton steps on 1 / trigamma."""
    if value > 1e7:
        return value**-0.5
    if value < 1e-6:
        return 1 / value
    x = 0.5 + 1 / value
    for _ in range(60):
        t = trigamma(x)
        h = 1e-5 * x
        step = t * (1 - t / value) / ((trigamma(x + h) - trigamma(x - h)) / (2 * h))
        x += step
        if abs(step / x) < 1e-12:
            break
    return x
