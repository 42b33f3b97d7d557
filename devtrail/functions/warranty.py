"""Warranty classification of repair claims."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DAYS_PER_MONTH, GRACE_MONTHS, Buckets
from .dates import col, within_period

UNKNOWN_SOURCE = "0"
IN_WARRANTY = "1"
OUT_OF_WARRANTY = "2"
NEGATIVE_PERIOD = "3"
INVALID_DATES = "4"


def source_bucket(data_source: str | Column, buckets: Buckets) -> Column:
    """``'domestic'``, ``'overseas'`` or ``'unknown'`` for a data source."""
    ds = col(data_source)
    return (
        F.when(ds.isin(list(buckets.domestic)), F.lit("domestic"))
        .when(ds.isin(list(buckets.overseas)), F.lit("overseas"))
        .otherwise(F.lit("unknown"))
    )


def warranty_tag(
    data_source: str | Column,
    purchase_date: str | Column,
    claim_date: str | Column,
    shipment_date: str | Column,
    months: str | Column,
    buckets: Buckets,
    grace: int = GRACE_MONTHS,
    days_per_month: int = DAYS_PER_MONTH,
) -> Column:
    """is_real_in_warranty tag of a claim.

    * ``'3'`` negative warranty period (checked before the source);
    * domestic source: from the purchase date when present, else from the
      shipment date with ``grace`` extra months;
    * overseas source: from the shipment date with ``grace`` extra months;
    * ``'0'`` any other source.
    Within a period: ``'1'`` in, ``'2'`` out, ``'4'`` absent date or period <= 0.
    """
    ds, purchase, claim, ship, m = (
        col(data_source), col(purchase_date), col(claim_date), col(shipment_date), col(months)
    )
    from_ship = within_period(ship, claim, m.cast("bigint") + F.lit(grace), days_per_month)
    domestic = F.when(purchase.isNotNull(), within_period(purchase, claim, m, days_per_month)).otherwise(
        from_ship
    )
    return (
        F.when(m < 0, F.lit(NEGATIVE_PERIOD))
        .when(ds.isin(list(buckets.domestic)), domestic)
        .when(ds.isin(list(buckets.overseas)), from_ship)
        .otherwise(F.lit(UNKNOWN_SOURCE))
    )
