"""Statistical expressions as SQL text (Hoeffding bound, normal distribution) and normal quantiles."""

from __future__ import annotations

import math
import statistics


def hoeffding_bound_sql(value_range: float, delta: float, n: str) -> str:
    """SQL text of √(R² ln(1/δ) / 2n)."""
    return f"sqrt({value_range**2 * math.log(1.0 / delta)!r}D / (2 * {n}))"


# Rational approximation of the error function, absolute error below 1.5e-7
# (Abramowitz & Stegun, Handbook of Mathematical Functions, formula 7.1.26).
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_cdf_sql(z: str) -> str:
    """SQL text of the standard normal distribution function."""
    t = f"(1D / (1D + {ERF_P / math.sqrt(2.0)!r}D * abs({z})))"
    poly = "0D"
    for a in reversed(ERF_A):
        poly = f"(({poly} + {a!r}D) * {t})"
    tail = f"({poly} * exp(-({z} * {z}) / 2D) / 2D)"
    return f"(CASE WHEN {z} >= 0 THEN 1D - {tail} ELSE {tail} END)"


def z_value(confidence: float) -> float:
    """Two-sided normal quantile for a confidence level such as 0.95."""
    if not 0.0 < confidence < 1.0:
        raise ValueError(f"ci: required a level between 0 and 1 but found {confidence}")
    return statistics.NormalDist().inv_cdf(0.5 + confidence / 2.0)
