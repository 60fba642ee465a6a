"""Tail probabilities as Arrow-batched functions of columns.

Spark has no error function, incomplete beta or log-gamma; these are the only parts of the
statistics that leave the JVM, and they do so on aggregated rows (one per group and gene).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_erfc = np.frompyfunc(math.erfc, 1, 1)
_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def _gamma(x: np.ndarray) -> np.ndarray:
    return _lgamma(x).astype(float)


def normal_tail(z: np.ndarray) -> np.ndarray:
    """P(|Z| >= |z|)."""
    return _erfc(np.abs(z) / math.sqrt(2)).astype(float)


@pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """P(|Z| >= |z|); null for null."""
    return pd.Series(normal_tail(z.to_numpy(float, na_value=np.nan)), index=z.index)


def beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function by its continued fraction (Lentz's method)."""
    flip = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    with np.errstate(all="ignore"):
        front = np.exp(_gamma(a + b) - _gamma(a) - _gamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
        c, d = np.ones_like(x), 1 / _away(1 - (a + b) * x / (a + 1))
        f = d.copy()
        for m in range(1, 300):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            d, c = 1 / _away(1 + even * d), _away(1 + even / c)
            f *= c * d
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            d, c = 1 / _away(1 + odd * d), _away(1 + odd / c)
            f *= c * d
            if np.all(np.abs(c * d - 1) < 1e-13):
                break
        out = np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, front * f))
    return np.where(flip, 1 - out, out)


def _away(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 1e-300, 1e-300, x)


def student_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) with ``df`` degrees of freedom."""
    with np.errstate(all="ignore"):
        return beta_fraction(df / 2, np.full_like(df, 0.5), df / (df + t * t))


@pandas_udf(DoubleType())
def student_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """P(|T| >= |t|); null where either is null or df is not positive."""
    a, b = t.to_numpy(float, na_value=np.nan), df.to_numpy(float, na_value=np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & (b > 0)
    out = np.full(len(a), np.nan)
    out[ok] = student_tail(a[ok], b[ok])
    return pd.Series(out, index=t.index).where(ok, None)


#: Terms of a hypergeometric tail summed at once.
TERMS = 1 << 16


def _hypergeometric_run(j: int, last: int, u: int, m: int, n: int) -> float:
    """The probabilities from ``j``, away from the mode, to ``last``; ends where they no longer
    count, so its length follows the deviation and not the counts."""
    f = lambda v: math.lgamma(v + 1)
    log = f(m) - f(j) - f(m - j) + f(u - m) - f(n - j) - f(u - m - n + j) - f(u) + f(n) + f(u - n)
    step, total = (1 if last >= j else -1), 0.0
    while True:
        x = (j + step * np.arange(min(TERMS, abs(last - j) + 1))).astype(float)
        with np.errstate(divide="ignore"):
            if step > 0:
                ratio = np.log(m - x) + np.log(n - x) - np.log(x + 1) - np.log(u - m - n + x + 1)
            else:
                ratio = np.log(x) + np.log(u - m - n + x) - np.log(m - x + 1) - np.log(n - x + 1)
        terms = np.exp(log + np.r_[0.0, np.cumsum(ratio[:-1])])
        total += float(terms.sum())
        j += step * len(x)
        if (j - last) * step > 0 or terms[-1] <= 1e-18 * total:
            return total
        log += float(ratio.sum())


def hypergeometric_tail(k: np.ndarray, u: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.ones(len(k))
    for i, (kk, uu, mm, nn) in enumerate(zip(*(v.tolist() for v in (k, u, m, n)))):
        lo, hi = max(0, nn - (uu - mm)), min(mm, nn)
        if kk <= lo:
            continue
        if kk > hi:
            out[i] = 0.0
        elif kk > (nn + 1) * (mm + 1) // (uu + 2):
            out[i] = min(1.0, _hypergeometric_run(kk, hi, uu, mm, nn))
        else:
            out[i] = max(0.0, 1.0 - _hypergeometric_run(kk - 1, lo, uu, mm, nn))
    return out


@pandas_udf(DoubleType())
def hypergeometric_upper(k: pd.Series, universe: pd.Series, successes: pd.Series, draws: pd.Series) -> pd.Series:
    """P(X >= k) for ``draws`` of ``successes`` among ``universe``."""
    a = [s.to_numpy(np.int64) for s in (k, universe, successes, draws)]
    return pd.Series(hypergeometric_tail(*a), index=k.index)


@pandas_udf(DoubleType())
def fisher_greater(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """One-sided Fisher exact test that the odds of [[a, b], [c, d]] are greater than one."""
    a, b, c, d = (s.to_numpy(np.int64) for s in (a, b, c, d))
    return pd.Series(hypergeometric_tail(a, a + b + c + d, a + c, a + b))
