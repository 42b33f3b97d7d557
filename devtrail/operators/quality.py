"""Data-quality side outputs (B4 staleness, B6 chronology, E4 re-exported)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import STALE_DAYS
from ..functions.dates import col, in_order, lit_date
from .joins import not_in

__all__ = ["chronology_exceptions", "not_in", "stale"]


def stale(df: DataFrame, date: str | Column, days: int = STALE_DAYS, as_of: _dt.date | str | None = None) -> DataFrame:
    """Rows last seen more than ``days`` whole days before ``as_of``
    (default: today's date -- pass an explicit date for reproducible runs)."""
    ref = lit_date(as_of) if as_of is not None else F.current_date()
    return df.filter(F.date_diff(ref, col(date)) > F.lit(days))


def chronology_exceptions(df: DataFrame, earlier: str | Column, later: str | Column) -> DataFrame:
    """Rows where ``earlier`` is after ``later`` (both present).  The rows
    are *copied* here; callers keep them in their main output too."""
    return df.filter(~in_order(earlier, later))
