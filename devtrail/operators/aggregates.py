"""Per-group date aggregates.

All are ``groupBy().agg()`` over ``DateType`` / numeric columns, so Spark
plans a hash aggregate with a map-side partial step: a model or device with a
third of all rows is pre-reduced in every map task before the shuffle.
Never ``min().over(Window.partitionBy(model))`` -- that would put a whole model
into one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHECKIN_CAP, HI, LO
from ..functions.dates import col, lit_date


def _clamped_min(c: Column, hi: Column | None) -> Column:
    m = F.min(c)
    # A group with no date at all stays NULL (rendered "NA"), not the ceiling.
    return m if hi is None else F.when(m.isNotNull(), F.least(hi, m))


def first_date_by(
    df: DataFrame,
    group: str | Sequence[str],
    dates: Mapping[str, str | Column],
    hi: _dt.date | str | None = HI,
) -> DataFrame:
    """Earliest date per group, capped at ``hi``, one output column per
    entry of ``dates`` (``{output_name: date column}``) in a single pass."""
    keys = [group] if isinstance(group, str) else list(group)
    hi_c = lit_date(hi)
    aggs = [_clamped_min(col(c), hi_c).alias(name) for name, c in dates.items()]
    return df.groupBy(*keys).agg(*aggs)


def last_date_by(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    lo: _dt.date | str | None = LO,
    name: str | None = None,
) -> DataFrame:
    """C4: latest date per key, floored at ``lo`` (a key whose dates are all
    below ``lo`` reports ``lo``).  Keys without any date are absent."""
    keys = [key] if isinstance(key, str) else list(key)
    lo_c = lit_date(lo)
    m = F.max(F.col(date))
    agg = m if lo_c is None else F.greatest(lo_c, m)
    return df.filter(F.col(date).isNotNull()).groupBy(*keys).agg(agg.alias(name or date))


def first_launch_date(
    df: DataFrame,
    group: str,
    first_a: str,
    first_b: str,
    hi: _dt.date | str | None = HI,
    name: str = "first_launch_date",
) -> DataFrame:
    """Per group, the earlier of ``min(first_a)`` and ``min(first_b)``,
    capped at ``hi``; absent values never win.  With ``hi=None`` a group
    without either date gets NULL."""
    hi_c = lit_date(hi)
    parts = [F.min(F.col(first_a)), F.min(F.col(first_b))]
    if hi_c is not None:
        parts.insert(0, hi_c)
    return df.groupBy(group).agg(F.least(*parts).alias(name))


def checkin_count(
    pairs: DataFrame,
    key: str = "imei",
    other: str = "imsi",
    cap: int = CHECKIN_CAP,
    name: str = "checkin_count",
) -> DataFrame:
    """Number of distinct ``other`` values per ``key``, capped at
    ``cap`` (1 = one SIM, 2 = several).  Distinct + count run as two partial
    aggregations, so a hot key is combined map-side."""
    distinct = pairs.select(key, other).distinct()
    counted = distinct.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return counted.select(key, F.least(F.col(name), F.lit(cap).cast("bigint")).alias(name))
