"""One record per key (C1 latest, C2 earliest, C2b composite-key dedup).

All three are ``row_number() == 1`` over a window with a *total* order: the
date, then every other column.  Spark plans a partial ``WindowGroupLimit``
before the shuffle, so each map task ships at most one row per key -- a key
holding a third of all rows (or a group of copies) is reduced map-side
instead of landing in one reducer.

Bounds: a latest fold only accepts dates ``>= lo``, an earliest fold only
dates ``< hi``.  A key without any acceptable date is not given a placeholder
row; its best row goes to the ``rejects`` frame instead.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import HI, LO
from ..functions.dates import lit_date

_RN = "__rn"


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key group under ``order`` (row_number == 1)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def best_per_key(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    latest: bool = True,
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """The best record per key with no bound: latest (or earliest) ``date``,
    ties broken by ``tie`` (default: every other column, ascending).  Rows
    with an absent date are not candidates."""
    rest = list(tie) if tie is not None else [c for c in df.columns if c not in set(keys) | {date}]
    # absent dates sort last, so a key's best row has a date whenever any of
    # its rows has one; filtering after the window keeps a parsed date column
    # from being evaluated twice (once in a pushed-down filter)
    first = F.col(date).desc_nulls_last() if latest else F.col(date).asc_nulls_last()
    best = top1_per_key(df, keys, [first] + [F.col(c).asc_nulls_first() for c in rest])
    return best.filter(F.col(date).isNotNull())


def split_bound(best: DataFrame, date: str, lo=None, hi=None) -> tuple[DataFrame, DataFrame]:
    """Split best rows into ``(good, rejects)`` by a floor ``lo`` (dates
    ``>= lo`` are good) or a ceiling ``hi`` (dates ``< hi`` are good).

    Because the order starts with the date, a key's best row is inside the
    bound exactly when the key has any row inside it, and then it is also the
    best of those rows -- so one window serves both outputs."""
    if lo is not None:
        inside = F.col(date) >= lit_date(lo)
    elif hi is not None:
        inside = F.col(date) < lit_date(hi)
    else:
        return best, best.limit(0)
    return best.filter(inside), best.filter(~inside)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    lo: _dt.date | str | None = LO,
    tie: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The record with the latest ``date`` per key.

    Rows with an absent date are not candidates.  Ties on the date are broken
    by ``tie`` (default: every other column, ascending).  Returns
    ``(good, rejects)``; rejects are the best rows of keys whose latest date is
    below ``lo``."""
    return split_bound(best_per_key(df, keys, date, True, tie), date, lo=lo)


def earliest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    hi: _dt.date | str | None = HI,
    tie: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The record with the earliest ``date`` per key; dates ``>= hi`` never win.

    Returns ``(good, rejects)``; rejects are the best rows of keys whose
    earliest date is at or above ``hi``."""
    return split_bound(best_per_key(df, keys, date, False, tie), date, hi=hi)


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    hi: _dt.date | str | None = HI,
    tie: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One record per composite key that contains the date itself
    (e.g. ``(imei, claim_date)``), with the earliest-fold ceiling ``hi``."""
    return earliest_per_key(df, keys, date, hi, tie)
