"""Sums of amounts that do not depend on the order of the rows.

A floating sum changes with the order in which tasks deliver their parts, so amounts are
added as decimals. An amount of up to four decimals, as nearly all are, is added as a whole
number of 1/10000, which costs no more than an integer sum; any other goes in as a wide
decimal. Nothing is cut, down to 1e-15. A total that does not fit fails the job, and not-a-
number or an infinite amount shows in the total.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

_WIDE = "decimal(38,16)"
_UNITS = 10_000.0


def exact_total(amount: Column) -> Column:
    """Sum of the finite amounts as a decimal; null without any."""
    finite = _is_finite(amount)
    units = F.floor(amount * _UNITS + 0.5)
    # Small enough to be exact as a double, and the same amount when turned back.
    whole = finite & (F.abs(amount) < 1e11) & (units.cast("double") / _UNITS == amount)
    in_units = F.sum(F.when(whole, units)).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))
    others = F.sum(F.when(finite & ~whole, amount.cast(_WIDE)))
    zero = F.lit(0).cast(_WIDE)
    return F.when(F.count(F.when(finite, 1)) > 0, F.coalesce(in_units, zero) + F.coalesce(others, zero))


def odd_total(amount: Column) -> Column:
    """What the amounts that are no finite numbers add up to; null without any."""
    return F.sum(F.when(~_is_finite(amount), amount))


def as_double(total: Column, odd: Column) -> Column:
    return F.coalesce(odd, total.cast("double"))


def exact_sum(amount: Column) -> Column:
    return as_double(exact_total(amount), odd_total(amount))


def exact_mean(amount: Column) -> Column:
    """Mean of the non-null values; null when there is none."""
    return exact_sum(amount) / F.nullif(F.count(amount), F.lit(0))


def _is_finite(amount: Column) -> Column:
    return ~F.isnan(amount) & (F.abs(amount) < float("inf"))
