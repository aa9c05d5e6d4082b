"""Money arithmetic with the rounding rules of the ledger queries and of the output table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int = 2) -> Column:
    """Round a double half away from zero.

    Written with floor, because the engines' own ``round`` disagree on doubles
    that sit a hair below a tie.
    """
    scale = 10.0 ** digits
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def half_even(value: Column, digits: int = 2) -> Column:
    """Round a double half to even, the rule of the prediction output."""
    scale = 10.0 ** digits
    return F.rint(value * scale) / scale


def exact(value: Column) -> Column:
    """Money as a decimal of ten digits after the point, so that sums do not depend on their order."""
    return value.cast("decimal(38,10)")


def net_amount(amount: Column, discount: Column) -> Column:
    return amount - discount


def in_base_currency(amount: Column, rate: Column) -> Column:
    """Local amount divided by the day's rate; NULL when there is no rate."""
    return half_up(amount / rate)


def net_of_return(revenue: Column, returned: Column) -> Column:
    """Order revenue with a (negative) return added where there is one."""
    return F.when(returned.isNotNull(), half_up(revenue + returned)).otherwise(revenue)
