"""Scalar Column expressions (all built-in, JVM-side, no Python UDF)."""

from .dates import as_int, day_of, in_order, min_date, parse_dates, valid_date, within_period
from .warranty import source_bucket, warranty_tag

__all__ = [
    "as_int",
    "day_of",
    "in_order",
    "min_date",
    "parse_dates",
    "source_bucket",
    "valid_date",
    "warranty_tag",
    "within_period",
]
