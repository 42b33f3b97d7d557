"""P5 repair, P17 repair_exceptions and P9 new_repair."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GRACE_MONTHS, HI, LO, Buckets
from ..functions.dates import as_int, in_order, min_date, parse_dates
from ..functions.warranty import warranty_tag
from ..operators.aggregates import last_date_by
from ..operators.dedupe import best_per_key, dedupe, split_bound
from ..operators.events import with_event_header
from ..operators.joins import not_in, prefixed
from ..operators.sequence import failure_tag
from .shipment import prepare_shipment, shared

Date = _dt.date | str | None


def prepare_repair(repair_orig: DataFrame) -> DataFrame:
    """Guard claim/purchase dates (B2); warranty months to int (NULL when
    not numeric)."""
    r = parse_dates(repair_orig, "claim_date", "purchase_date")
    if dict(r.dtypes)["warranty_period"] != "int":
        r = r.withColumn("warranty_period", as_int("warranty_period"))
    return r


RAW = {"purchase_date": "__purchase_text", "warranty_period": "__period_text"}


def dedupe_repair(repair_orig: DataFrame, hi: Date = HI) -> tuple[DataFrame, DataFrame]:
    """One claim per (imei, claim_date); claims at/after ``hi`` are rejects."""
    return dedupe(prepare_repair(repair_orig), ["imei", "claim_date"], "claim_date", hi)


def last_shipment_dates(shipment_orig: DataFrame, lo: Date = LO) -> DataFrame:
    """C4: latest valid shipment date per device from the raw feed, floored at ``lo``."""
    s = prepare_shipment(shipment_orig.select("imei", "mfg_date", "shipment_date"))
    return last_date_by(s, "imei", "shipment_date", lo)


def build_repair(
    repair_orig: DataFrame,
    shipment_orig: DataFrame,
    buckets: Buckets,
    lo: Date = LO,
    hi: Date = HI,
    grace: int = GRACE_MONTHS,
    materialize: bool = False,
) -> dict[str, DataFrame]:
    """P5: deduplicated claims of shipped devices with ``failure_count``
    (W1) and ``is_real_in_warranty`` (D5).

    ``repair_rejects``: claims at/after ``hi``; ``repair_period_rejects``:
    shipped claims whose warranty period is not a number (the surveyed job
    aborts on them).  ``materialize`` writes the dedup once so the rejects
    need no second pass."""
    texts = prepare_repair(repair_orig.withColumns({raw: F.col(c) for c, raw in RAW.items()}))
    keys = ["imei", "claim_date"]
    tie = [c for c in texts.columns if c not in (*keys, *RAW.values())]  # typed values order equal claims, the texts ride along

    def reduced(claims: DataFrame) -> DataFrame:
        return best_per_key(claims, keys, "claim_date", latest=False, tie=tie)

    if materialize:  # one dedup for claims, rejects and the report of raw text
        with_text = shared(reduced(texts), "repair_best")
        best = with_text.drop(*RAW.values())
    else:  # a single table's plan has no use for the texts
        with_text, best = reduced(texts), reduced(texts.drop(*RAW.values()))
    as_read, _ = split_bound(with_text, "claim_date", hi=hi)
    dedup, rejects = split_bound(best, "claim_date", hi=hi)
    tagged = failure_tag(dedup, "imei", "claim_date")
    joined = tagged.join(last_shipment_dates(shipment_orig, lo), "imei", "inner")
    good = joined.filter(F.col("warranty_period").isNotNull())
    tag = warranty_tag(
        "data_source", "purchase_date", "claim_date", "shipment_date", "warranty_period", buckets, grace
    )
    repair = good.select(*tagged.columns, tag.alias("is_real_in_warranty"))
    bad = joined.filter(F.col("warranty_period").isNull()).select(*tagged.columns)
    return {"repair": repair, "repair_first": as_read, "repair_rejects": rejects, "repair_period_rejects": bad}


def repair_exceptions(repair_first: DataFrame, shipment: DataFrame) -> DataFrame:
    """Deduplicated claims (``build_repair``'s ``repair_first``) of devices
    absent from shipment.  The report shows the record as it came: purchase
    date and warranty period are the feed's own text."""
    columns = [c for c in repair_first.columns if c not in RAW.values()]
    return not_in(repair_first, shipment, "imei").select(*(F.col(RAW.get(c, c)).alias(c) for c in columns))


def build_new_repair(repair: DataFrame, new_shipment: DataFrame, materialize: bool = False) -> dict[str, DataFrame]:
    """Claims joined to their device's new_shipment row.

    ``new_repair``: event rows ``('repair', claim_date)`` + new_shipment +
    ``rep_*``; ``new_repair_exception``: claims dated before the device's
    first use (earlier of SDAC create date and activation date), laid out
    new_shipment + ``rep_*`` without a header.  With ``materialize`` the join
    is written once as a table that both outputs read (G2) -- for when they
    are written by separate jobs."""
    rep = prefixed(repair, "rep_")
    joined = rep.join(new_shipment, F.col("rep_imei") == F.col("imei"), "inner")
    if materialize:
        joined = shared(joined, "new_repair")
    body = joined.select(*new_shipment.columns, *rep.columns)
    events = with_event_header(body, "repair", "rep_claim_date")
    first_use = min_date("sdac_create_date", "act_activation_date")
    exceptions = body.filter(~in_order(first_use, "rep_claim_date"))
    return {"new_repair": events, "new_repair_exception": exceptions}
