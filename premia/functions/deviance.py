"""Unit deviances and their weighted means, as column expressions.

``y`` is the target, ``mu`` the prediction, ``w`` the weight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def poisson_unit(y: Column, mu: Column) -> Column:
    log_part = F.when(y > 0, y * F.log(y / mu)).otherwise(F.lit(0.0))
    return 2 * (log_part - y + mu)


def gamma_unit(y: Column, mu: Column) -> Column:
    return 2 * (F.log(mu / y) + y / mu - 1)


def tweedie_unit(y: Column, mu: Column, power: float) -> Column:
    """Compound Poisson-gamma deviance, 1 < power < 2."""
    if not 1 < power < 2:
        raise ValueError("tweedie power must lie strictly between 1 and 2")
    one, two = 1.0 - power, 2.0 - power
    from_y = F.when(y > 0, F.pow(y, F.lit(two))).otherwise(F.lit(0.0)) / (one * two)
    return 2 * (from_y - y * F.pow(mu, F.lit(one)) / one + F.pow(mu, F.lit(two)) / two)


def unit_deviance(kind: str, y: Column, mu: Column, power: float | None = None) -> Column:
    if kind == "poisson":
        return poisson_unit(y, mu)
    if kind == "gamma":
        return gamma_unit(y, mu)
    if kind == "tweedie":
        if power is None:
            raise ValueError("power is required for the tweedie deviance")
        return tweedie_unit(y, mu, power)
    raise ValueError(f"unknown deviance {kind!r}")


def weighted_mean(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.sum(w)


def mean_deviance(kind: str, y: Column, mu: Column, w: Column, power: float | None = None) -> Column:
    return weighted_mean(unit_deviance(kind, y, mu, power), w)
