"""Test statistics as column expressions."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.text import as_col

# Fixed value: the 97.5 % point of the normal distribution, as published.
Z_95 = 1.96


def _erfc(x: Column) -> Column:
    # Spark has no erf; this runs on a handful of aggregated rows only. The function is local, so
    # that it travels to the workers by value and they need no copy of this package.
    def erfc(values: pd.Series) -> pd.Series:
        return values.map(math.erfc, na_action="ignore").astype("float64")

    return F.pandas_udf(erfc, T.DoubleType())(x)


def normal_sf(z: Column | str) -> Column:
    """Upper tail of the standard normal distribution."""
    return F.lit(0.5) * _erfc(as_col(z) / F.lit(math.sqrt(2)))


def _d(c: Column | str) -> Column:
    return as_col(c).cast("double")


def srm_chi_square(n_control: Column | str, n_treatment: Column | str, ratio: float = 0.5) -> Column:
    """G1: chi-square of the observed split against the planned one."""
    a, b = _d(n_control), _d(n_treatment)
    want_a, want_b = (a + b) * F.lit(ratio), (a + b) * F.lit(1 - ratio)
    return (a - want_a) ** 2 / want_a + (b - want_b) ** 2 / want_b


def chi_square_p(chi2: Column | str) -> Column:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    return _erfc(F.sqrt(as_col(chi2) / 2))


def pooled_z(x_c, n_c, x_t, n_t) -> Column:
    """Two-proportion z with the pooled standard error."""
    x_c, n_c, x_t, n_t = (_d(c) for c in (x_c, n_c, x_t, n_t))
    pooled = (x_c + x_t) / (n_c + n_t)
    return (x_t / n_t - x_c / n_c) / F.sqrt(pooled * (1 - pooled) * (1 / n_c + 1 / n_t))


def lift_interval(x_c, n_c, x_t, n_t, z: float = Z_95) -> tuple[Column, Column, Column]:
    """Difference of two proportions in points, with its interval from the unpooled error."""
    x_c, n_c, x_t, n_t = (_d(c) for c in (x_c, n_c, x_t, n_t))
    p_c, p_t = x_c / n_c, x_t / n_t
    diff = p_t - p_c
    margin = F.lit(z) * F.sqrt(p_c * (1 - p_c) / n_c + p_t * (1 - p_t) / n_t)
    return 100 * diff, 100 * (diff - margin), 100 * (diff + margin)


def binomial_z(hits: Column | str, n: Column | str, base_rate: Column | str) -> Column:
    """How many standard errors a group's rate lies above the base rate.

    NULL where the base rate leaves no variance (0 or 1).
    """
    hits, n, base = _d(hits), _d(n), _d(base_rate)
    return (hits / n - base) / F.nullif(F.sqrt(base * (1 - base) / n), F.lit(0.0))
