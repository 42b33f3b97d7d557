"""Event rows of the lifecycle timeline.

The timeline is one wide schema whose slots line up with the text layout:

``eventtype, eventdate | new_shipment columns | xchg_* (exchange record) |
rep_* (repair record) | to_* (new_shipment of the target device)``

Each event table fills the slots it has; the others are typed NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import col

EXCHANGE_COLUMNS = ("uid", "uidtype", "imei", "toimei", "eventtype", "eventdate")


def with_event_header(df: DataFrame, eventtype: str | Column, eventdate: str | Column) -> DataFrame:
    """Prepend ``(eventtype, eventdate)``.  ``eventtype`` given as ``str``
    is a literal type name; dates are column names or Columns."""
    t = F.lit(eventtype) if isinstance(eventtype, str) else eventtype
    return df.select(t.alias("eventtype"), col(eventdate).alias("eventdate"), *df.columns)


def to_exchange(
    df: DataFrame,
    uid,
    uidtype,
    imei,
    toimei,
    eventtype,
    eventdate,
    uid_type: str = "string",
    imei_type: str = "string",
) -> DataFrame:
    """Project onto the six-column exchange record.  Each argument is a
    column name, a Column, or ``None`` / a literal (``uidtype`` and
    ``eventtype`` literals are strings); "not applicable" is NULL."""

    def lit_or_col(v, dtype):
        if v is None:
            return F.lit(None).cast(dtype)
        if isinstance(v, Column):
            return v.cast(dtype)
        return F.col(v).cast(dtype)

    return df.select(
        lit_or_col(uid, uid_type).alias("uid"),
        (F.lit(uidtype) if isinstance(uidtype, str) or uidtype is None else uidtype).cast("string").alias("uidtype"),
        lit_or_col(imei, imei_type).alias("imei"),
        lit_or_col(toimei, imei_type).alias("toimei"),
        (F.lit(eventtype) if isinstance(eventtype, str) else eventtype).alias("eventtype"),
        lit_or_col(eventdate, "date").alias("eventdate"),
    )


def superset_schema(dfs: Sequence[DataFrame]) -> list[tuple[str, str]]:
    """Union of the columns of ``dfs`` in first-appearance order; a name must
    have one type everywhere."""
    seen: dict[str, str] = {}
    for df in dfs:
        for name, dtype in df.dtypes:
            if name not in seen:
                seen[name] = dtype
            elif seen[name] != dtype:
                raise TypeError(f"column {name!r}: {seen[name]} vs {dtype}")
    return list(seen.items())


def widen(df: DataFrame, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """Select ``schema`` from ``df``, filling missing columns with typed NULLs."""
    have = set(df.columns)
    return df.select([F.col(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in schema])


def timeline(*events: DataFrame, schema: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """union-all (duplicates kept) of event tables of different widths."""
    cols = list(schema) if schema is not None else superset_schema(events)
    out = None
    for df in events:
        w = widen(df, cols)
        out = w if out is None else out.unionByName(w)
    return out
