"""Date guards and date arithmetic as JVM-side Column expressions.

Dirty text dates never abort a job: the ``try_`` forms return NULL, and
NULL means "absent" everywhere downstream.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DATE_FORMAT, DAYS_PER_MONTH


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d: _dt.date | str | None) -> Column | None:
    if d is None:
        return None
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


# Exactly ``yyyy-MM-dd``: four digits, dash, two digits, dash, two digits.
_ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _parse_day(c: Column, fmt: str) -> Column:
    if fmt == DATE_FORMAT:
        # Layout check + cast: the same results as a strict formatter parse
        # (impossible days such as 2014-02-31 give NULL), at half the cost.
        return F.when(c.rlike(_ISO_DAY), c.try_cast(T.DateType()))
    return F.try_to_date(c, fmt)


def valid_date(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """B2: a 10-character text that parses as a real calendar date, else NULL.

    The length rule is the surveyed one; the parse additionally rejects
    ten-character garbage and impossible days such as ``2014-02-31``.
    """
    c = col(c)
    return F.when(F.length(c) == 10, _parse_day(c, fmt))


def day_of(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """The day part of a timestamp text longer than 10 characters, else NULL."""
    c = col(c)
    return F.when(F.length(c) > 10, _parse_day(F.substring(c, 1, 10), fmt))


def in_order(earlier: str | Column, later: str | Column) -> Column:
    """``earlier <= later``; an absent date on either side counts as in order."""
    return F.coalesce(col(earlier) <= col(later), F.lit(True))


def min_date(a: str | Column, b: str | Column) -> Column:
    """Earliest of two dates, skipping absent ones; NULL when both are absent."""
    return F.least(col(a), col(b))


def within_period(
    start: str | Column,
    end: str | Column,
    months: str | Column,
    days_per_month: int = DAYS_PER_MONTH,
) -> Column:
    """``'1'`` if ``end`` is at most ``months`` x 30 days after ``start``
    (an end before the start counts as within), ``'2'`` if later, and ``'4'``
    when a date is absent or the period is not positive."""
    start, end, months = col(start), col(end), col(months).cast("bigint")  # any period, no overflow
    ok = start.isNotNull() & end.isNotNull() & (months > 0)
    inside = F.date_diff(end, start) <= months * F.lit(days_per_month)
    return F.when(ok, F.when(inside, F.lit("1")).otherwise(F.lit("2"))).otherwise(F.lit("4"))


def parse_dates(df: DataFrame, *names: str, timestamp: bool = False) -> DataFrame:
    """Replace text date columns by ``DateType`` (B2, or B3 with ``timestamp``).

    Columns that already are dates are left alone, so operators accept both
    raw text feeds and typed tables.
    """
    types = dict(df.dtypes)
    out = df
    for n in names:
        if types[n] == "date":
            continue
        expr = day_of(n) if timestamp else valid_date(n)
        out = out.withColumn(n, expr)
    return out


def as_int(c: str | Column) -> Column:
    """Text to int, NULL when not numeric (``Column.try_cast``)."""
    return col(c).try_cast(T.IntegerType())
