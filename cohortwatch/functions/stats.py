"""Distribution tail functions as Spark expressions (no SciPy, no UDF).

They run on one row per (group, column) after the heavy aggregation, but stay
in Catalyst so the verdict tables never pass through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chebyshev fit of erfc with fractional error below 1.2e-7
# (Numerical Recipes, "erfcc"), coefficients in evaluation order.
ERFC_COEFFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
SERIES_TERMS = 20


def erfc(x: Column) -> Column:
    z = F.abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(2.0 - ans)


def normal_two_sided_p(z: Column) -> Column:
    """2 * (1 - Phi(|z|))."""
    return erfc(F.abs(z) / math.sqrt(2.0))


def kolmogorov_q(lam: Column, terms: int = SERIES_TERMS) -> Column:
    """P(K > lam) for the Kolmogorov distribution (asymptotic two-sample K-S p-value)."""
    ks = F.sequence(F.lit(1), F.lit(terms))
    alt = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    small = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + F.exp(
        -((2.0 * k - 1.0) * (2.0 * k - 1.0)) * (math.pi ** 2) / (8.0 * lam * lam)))
    q = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.18, 1.0 - math.sqrt(2.0 * math.pi) / lam * small).otherwise(2.0 * alt)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def ks_p_value(d: Column, n1: Column, n2: Column) -> Column:
    en = F.try_divide(n1.cast("double") * n2, n1 + n2)
    return kolmogorov_q(F.sqrt(en) * d)


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution for integer degrees of freedom."""
    h = x / 2.0
    # even df: exp(-h) * sum_{i<df/2} h^i / i!
    n_even = F.greatest((df / 2).cast("int"), F.lit(1))
    even = F.exp(-h) * F.aggregate(
        F.sequence(F.lit(0), n_even - 1), F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("t")),
        lambda acc, i: F.struct((acc["s"] + F.when(i == 0, F.lit(1.0)).otherwise(acc["t"] * h / i)).alias("s"),
                                F.when(i == 0, F.lit(1.0)).otherwise(acc["t"] * h / i).alias("t")),
        lambda acc: acc["s"])
    # odd df: erfc(sqrt(h)) + exp(-h) * sum_{i=1}^{(df-1)/2} h^(i-1/2) / Gamma(i+1/2)
    n_odd = ((df - 1) / 2).cast("int")
    first = 2.0 * F.sqrt(h) / math.sqrt(math.pi)
    odd_sum = F.when(n_odd <= 0, F.lit(0.0)).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.greatest(n_odd, F.lit(1))), F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("t")),
        lambda acc, i: F.struct(
            (acc["s"] + F.when(i == 1, first).otherwise(acc["t"] * h / (i - 0.5))).alias("s"),
            F.when(i == 1, first).otherwise(acc["t"] * h / (i - 0.5)).alias("t")),
        lambda acc: acc["s"]))
    odd = erfc(F.sqrt(h)) + F.exp(-h) * odd_sum
    q = F.when(x.isNull() | df.isNull(), F.lit(None)).when(x == float("inf"), F.lit(0.0)).when(
        x <= 0, F.lit(1.0)).when(df % 2 == 0, even).otherwise(odd)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))
