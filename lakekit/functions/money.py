"""Exact money and ratio expressions.

Amounts arrive as doubles. They are summed as decimals, so that a sum does not depend on the order in which
partitions are merged, and become doubles again only at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,3)"


def money(amount: str | Column) -> Column:
    """The amount in exact cents."""
    return (F.col(amount) if isinstance(amount, str) else amount).cast(MONEY)


def exact_sum(amount: str | Column) -> Column:
    """Sum in cents, still a decimal; for further arithmetic."""
    return F.sum(money(amount))


def total(amount: str | Column, digits: int = 2) -> Column:
    """Rounded sum of amounts."""
    return F.round(exact_sum(amount), digits).cast("double")


def mean(amount: str | Column, digits: int = 2) -> Column:
    """Rounded mean of the amounts that are not NULL."""
    cents = money(amount)
    return ratio(F.sum(cents), F.count(cents), digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole, rounded half up; NULL where the whole is zero.

    The widths leave the quotient 14 exact digits after the point, so that rounding decides on the true value.
    """
    return F.round(F.try_divide(part.cast("decimal(24,2)"), whole.cast("decimal(20,2)")), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """part as a percentage of whole; both decimals."""
    return ratio(part * F.lit(100), whole, digits)


def graded(value: Column, limits: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label of the first limit that the value exceeds; NULL values get the lowest label."""
    label = F.lit(lowest)
    for limit, name in sorted(limits):
        label = F.when(value > F.lit(limit), F.lit(name)).otherwise(label)
    return label
