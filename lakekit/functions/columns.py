"""Column expressions for keys, dates, validity and masks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(at: datetime) -> Column:
    """A fixed point in time without a zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def pad_key(c: str | Column, width: int = 10) -> Column:
    """Key as text, zero-padded on the left; keys that are longer than the width stay whole."""
    key = col(c).cast("string")
    return F.when(F.length(key) < width, F.lpad(key, width, "0")).otherwise(key)


def parse_yyyymmdd(c: str | Column) -> Column:
    """Eight-digit text or number to a date; NULL where it is no date."""
    return F.try_to_date(col(c).cast("string"), "yyyyMMdd")


def clean_text(c: str | Column) -> Column:
    return F.trim(col(c))


def clean_code(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def is_blank(c: str | Column) -> Column:
    """True for NULL and for text of blanks only."""
    return col(c).isNull() | (F.trim(col(c)) == "")


def not_empty(c: str | Column) -> Column:
    return col(c).isNotNull() & (col(c) != "")


def not_positive(c: str | Column) -> Column:
    """True for NULL and for values of zero or less."""
    return col(c).isNull() | (col(c) <= 0)


def valid_unless(*reasons: Column) -> Column:
    """False where any reason holds; a reason that is NULL does not hold."""
    broken = reduce(lambda a, b: a | b, (F.coalesce(r, F.lit(False)) for r in reasons))
    return ~broken


def period_label(year: str | Column, month: str | Column) -> Column:
    """'YYYY-MM'."""
    return F.concat(col(year).cast("string"), F.lit("-"), F.lpad(col(month).cast("string"), 2, "0"))


def safe_ratio(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Rounded ratio of two numbers of one row; NULL where the divisor is zero."""
    return F.round(F.try_divide(col(part), col(whole)), digits)


def active_since(last_year: str | Column, as_of_year: int, years: int = 2) -> Column:
    """True if the last year is within the given number of years; NULL counts as inactive."""
    return F.coalesce(col(last_year) >= F.lit(as_of_year - years), F.lit(False))


def mask_prefix(c: str | Column, keep: int = 3, mask: str = "***") -> Column:
    """First characters followed by a mask."""
    return F.concat(F.substring(col(c), 1, keep), F.lit(mask))


def is_return(order_type: str | Column, return_types: Iterable[str]) -> Column:
    return F.coalesce(col(order_type).isin(list(return_types)), F.lit(False))


def labelled_text(parts: Mapping[str, str | Column], separator: str = ", ") -> Column:
    """'label=value' pairs joined to one text; NULL values are shown as 'N/A'."""
    shown = [
        F.concat(F.lit(f"{label}="), F.coalesce(col(value).cast("string"), F.lit("N/A")))
        for label, value in parts.items()
    ]
    return F.concat_ws(separator, *shown)
