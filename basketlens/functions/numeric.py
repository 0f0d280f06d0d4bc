"""Exact half-up percentages and means.

Ratios are computed on integers so that the result is the correctly
rounded (half away from zero) value of the true rational, whatever engine
evaluates it; rounding a binary double is not the same thing (1.005).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up_units(num, den, units: int) -> Column:
    """round(num * units / den) half away from zero, as DECIMAL(38,0); NULL if den is 0 or NULL.

    ``num`` and ``den`` must be integral (counts, or amounts in cents) of at
    most 25 digits.  All steps are exact: the dividend is made a multiple of
    the divisor first, so no quotient is rounded by its scale.
    """
    n = _c(num).cast("decimal(25,0)")
    d = F.nullif(_c(den).cast("decimal(25,0)"), F.lit(0).cast("decimal(25,0)"))
    twice = F.abs(n) * F.lit(2 * units).cast("decimal(12,0)") + F.abs(d)
    by = F.abs(d) * F.lit(2).cast("decimal(1,0)")
    mag = ((twice - twice % by) / by).cast("decimal(38,0)")
    return F.when((n < 0) != (d < 0), -mag).otherwise(mag)


def half_up_ratio(num, den, factor: int = 1, digits: int = 2) -> Column:
    """``round(num / den * factor, digits)`` exactly, as DOUBLE."""
    units = factor * 10 ** digits
    return round_half_up_units(num, den, units).cast("double") / F.lit(float(10 ** digits))


def pct(num, den, digits: int = 2) -> Column:
    """Percentage ``round(num / den * 100, digits)`` for integral num/den."""
    return half_up_ratio(num, den, factor=100, digits=digits)


def cents(amount) -> Column:
    """DECIMAL(., 2) amount -> cents (exact, 25 digits)."""
    return (_c(amount).cast("decimal(28,2)") * 100).cast("decimal(25,0)")


def money_pct(num_amount, den_amount, digits: int = 2) -> Column:
    """Percentage of two 2-dp amounts, exact half-up."""
    return pct(cents(num_amount), cents(den_amount), digits)


def money_mean(sum_amount, count, digits: int = 2) -> Column:
    """Mean of 2-dp amounts rounded half-up to ``digits`` (exact)."""
    return half_up_ratio(cents(sum_amount), _c(count) * 100, factor=1, digits=digits)


def money_mean_dec(sum_amount, count, scale: int = 6) -> Column:
    """Exact half-up mean of 2-dp amounts as DECIMAL(20, scale) (sums of it stay exact)."""
    units = round_half_up_units(cents(sum_amount), _c(count) * 100, 10 ** scale)
    return (units.cast("decimal(20,0)") * F.lit(1 / 10 ** scale).cast(f"decimal({scale},{scale})")
            ).cast(f"decimal(20,{scale})")
