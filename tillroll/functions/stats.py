"""Normal-distribution helpers as Spark column expressions.

Spark SQL has no ``erf``. It is evaluated with the all-positive series
(Abramowitz & Stegun 7.1.6)

    erf(x) = 2/sqrt(pi) * exp(-x^2) * sum_k 2^k x^(2k+1) / (2k+1)!!

as a higher-order ``aggregate`` over ``sequence(1, N)`` carrying
(term, partial sum); each term is the previous one times 2x^2/(2k+1).
From |x| >= 2.5 the tail is taken from erfc's continued fraction

    erfc(x) = exp(-x^2)/sqrt(pi) / (x + (1/2)/(x + 1/(x + (3/2)/(x + ...))))

evaluated bottom-up, and erf = 1 - erfc: this keeps the last bit of erf
right, which matters for 2 * (1 - Phi(|t|)) at large t. For |x| >= 6,
erf is +-1 to double precision.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 200
CF_TERMS = 100
CF_FROM = 2.5
ERF_SATURATION = 6.0

# Two-sided critical z per confidence level.
Z_CRITICAL = {0.90: 1.6449, 0.95: 1.9600, 0.99: 2.5758}


def z_critical(conf_level: float) -> float:
    """Critical z for a supported confidence level; other levels are refused
    (instead of silently falling back to 1.96)."""
    for level, z in Z_CRITICAL.items():
        if abs(level - conf_level) < 1e-12:
            return z
    raise ValueError(f"unsupported confidence level {conf_level}; use one of {sorted(Z_CRITICAL)}")


def _erf_series(ax: Column) -> Column:
    two_x2 = ax * ax * F.lit(2.0)

    def step(acc, k):
        t = acc["t"] * two_x2 / (k.cast("double") * 2.0 + 1.0)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.struct(ax.alias("t"), ax.alias("s")),
        step,
        lambda acc: acc["s"],
    )
    return F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-(ax * ax)) * series


def erfc_tail(ax: Column) -> Column:
    """erfc(x) for x >= CF_FROM by the continued fraction (bottom-up)."""
    denom = F.aggregate(
        F.sequence(F.lit(CF_TERMS), F.lit(1), F.lit(-1)),
        ax,
        lambda acc, k: ax + (k.cast("double") / 2.0) / acc,
    )
    return F.exp(-(ax * ax)) / F.lit(math.sqrt(math.pi)) / denom


def erf(x: Column) -> Column:
    ax = F.abs(x)
    mag = (F.when(ax >= ERF_SATURATION, F.lit(1.0))
           .when(ax >= CF_FROM, F.lit(1.0) - erfc_tail(ax))
           .otherwise(_erf_series(ax)))
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(x), F.lit(float("nan")))
            .otherwise(F.signum(x) * mag))


def normal_cdf(z: Column) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(z / F.lit(math.sqrt(2.0))))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def two_sided_p(t: Column) -> Column:
    """2 * (1 - Phi(|t|)), NaN when t is not finite. Very small p-values
    print as 0, as in the source (no complement trick)."""
    return F.when(is_finite(t), F.lit(2.0) * (F.lit(1.0) - normal_cdf(F.abs(t)))) \
        .otherwise(F.lit(float("nan")))


def ieee_div(num: Column, den: Column) -> Column:
    """num / den with floating-point semantics (x/0 -> +-inf, 0/0 -> NaN),
    as NumPy computes it; ANSI mode would raise instead."""
    n, d = num.cast("double"), den.cast("double")
    return (F.when(d != 0, n / d)
            .when(n > 0, F.lit(float("inf")))
            .when(n < 0, F.lit(float("-inf")))
            .otherwise(F.lit(float("nan"))))
