"""P1/P2 shipment, P3 sdac, P4 activation and their not-shipped reports
(P15, P16): the device dimension tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HI, LO, MAX_BROADCAST_ROWS
from ..session import stage, stage_by_key, together
from ..functions.dates import day_of, parse_dates
from ..operators.aggregates import checkin_count, first_date_by
from ..operators.dedupe import best_per_key, earliest_per_key, latest_per_key, split_bound
from ..operators.joins import enrich_left, not_in, only_not_in, sized_broadcast
from ..operators.quality import chronology_exceptions

Date = _dt.date | str | None


def shared(df: DataFrame, name: str = "shared") -> DataFrame:
    """An intermediate that several outputs read (G2): written once as a
    table in the shared checkpoint folder (``session.stage``), so its upstream
    shuffles run once and lineage is cut."""
    return stage(df, name)


def shared_by_device(df: DataFrame, name: str, n_buckets: int | None = None) -> DataFrame:
    """``shared`` for a table with one row a device, bucketed by it: the joins by
    device that follow need no exchange on its side.  All device tables of a run
    have the same number of buckets."""
    return stage_by_key(df, "imei", name, n_buckets)


def prepare_shipment(shipment_orig: DataFrame) -> DataFrame:
    """Guard the two dates of the raw shipment feed (B2)."""
    return parse_dates(shipment_orig, "mfg_date", "shipment_date")


def build_shipment_model(shipment_orig: DataFrame, lo: Date = LO) -> DataFrame:
    """``(imei, model)`` of the latest shipment record of each device."""
    latest, _ = latest_per_key(prepare_shipment(shipment_orig), ["imei"], "shipment_date", lo)
    return latest.select("imei", "model")


def model_first_dates(shipment_orig: DataFrame, hi: Date = HI) -> DataFrame:
    """C3 x 2 in one pass over the *raw* rows: first_mfg_date and
    first_shipment_date per model, each from rows where that date is valid."""
    s = prepare_shipment(shipment_orig)
    return first_date_by(
        s, "model", {"first_mfg_date": "mfg_date", "first_shipment_date": "shipment_date"}, hi
    )


def build_shipment(
    shipment_orig: DataFrame,
    lo: Date = LO,
    hi: Date = HI,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    n_buckets: int | None = None,
) -> dict[str, DataFrame]:
    """One shipment row per device (latest shipment date) with the model's
    first manufacturing and first shipment dates appended.

    Outputs ``shipment``, ``shipment_model`` (P1), ``shipment_exception``
    (raw rows manufactured after shipment; copied, not removed) and
    ``shipment_rejects`` (devices whose latest shipment is below ``lo``).
    """
    s = prepare_shipment(shipment_orig)
    # one dedup, written once, feeds shipment, shipment_model (and through it
    # sdac and activation) and the rejects
    best, dims = together(
        shipment_orig.sparkSession,
        lambda: shared_by_device(best_per_key(s, ["imei"], "shipment_date", latest=True), "shipment_best", n_buckets),
        lambda: sized_broadcast(model_first_dates(shipment_orig, hi), max_broadcast_rows),
    )
    latest, rejects = split_bound(best, "shipment_date", lo=lo)
    shipment = enrich_left(latest, dims, "model").select(*s.columns, "first_mfg_date", "first_shipment_date")
    return {
        "shipment": shipment,
        "shipment_model": latest.select("imei", "model"),
        "shipment_exception": chronology_exceptions(s, "mfg_date", "shipment_date"),
        "shipment_rejects": rejects,
    }


def earliest_sdac(sdac_orig: DataFrame, hi: Date = HI) -> tuple[DataFrame, DataFrame]:
    """C2 on the SDAC feed: earliest create_date per device."""
    s = parse_dates(sdac_orig, "create_date")
    return earliest_per_key(s, ["imei"], "create_date", hi)


def build_sdac(
    sdac_orig: DataFrame,
    shipment_model: DataFrame,
    hi: Date = HI,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    materialize: bool = False,
    n_buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Earliest SDAC record per shipped device plus the model's
    first_sdac_date (computed after the dedup and the join, over shipped
    devices only).  ``materialize`` writes the per-device dedup once so the
    rejects need no second pass."""
    best = best_per_key(parse_dates(sdac_orig, "create_date"), ["imei"], "create_date", latest=False)
    if materialize:
        best = shared_by_device(best, "sdac_best", n_buckets)
    first, rejects = split_bound(best, "create_date", hi=hi)
    joined = shared_by_device(first.join(shipment_model.select("imei", "model"), "imei", "inner"), "sdac_model", n_buckets)
    dims = sized_broadcast(first_date_by(joined, "model", {"first_sdac_date": "create_date"}, hi), max_broadcast_rows)
    sdac = joined.join(dims, "model", "left").select(*first.columns, "first_sdac_date")
    return {"sdac": sdac, "sdac_first": first, "sdac_model_dates": dims, "sdac_rejects": rejects}


def sdac_exceptions(sdac_first: DataFrame, shipment: DataFrame) -> DataFrame:
    """Earliest SDAC records (``build_sdac``'s ``sdac_first``) of devices
    absent from shipment."""
    return not_in(sdac_first, shipment, "imei")


def last_checkins(uss_device: DataFrame) -> DataFrame:
    """(imei, imsi, activation_date = day of the last-seen timestamp) for
    check-in rows whose last-seen timestamp is valid (B3)."""
    d = day_of("last_ts")
    return uss_device.select("imei", "imsi", d.alias("activation_date")).filter(d.isNotNull())


def build_activation(
    uss_device: DataFrame,
    shipment_model: DataFrame,
    lo: Date = LO,
    hi: Date = HI,
    source: str = "deduped",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    materialize: bool = False,
    n_buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Per shipped device its activation_date (latest last-seen day), the
    model's first_checkin_date (minimum of those over shipped devices) and the
    checkin_count (C6).  ``source='deduped'`` counts SIMs of the deduplicated
    pair as the surveyed job does (always 1); ``source='raw'`` counts distinct
    SIMs over all valid check-ins (1 or 2 = several).  ``materialize`` writes
    the per-device dedup once so the rejects need no second pass."""
    if source not in ("deduped", "raw"):
        raise ValueError("source must be 'deduped' or 'raw'")
    u = last_checkins(uss_device)
    best = best_per_key(u, ["imei"], "activation_date", latest=True)
    if materialize:  # the rejects are written by a separate job: one dedup pass for both
        best = shared_by_device(best, "activation_best", n_buckets)
    latest, rejects = split_bound(best, "activation_date", lo=lo)
    joined = shared_by_device(latest.join(shipment_model.select("imei", "model"), "imei", "inner"), "activation_model", n_buckets)
    dims = sized_broadcast(
        first_date_by(joined, "model", {"first_checkin_date": "activation_date"}, hi), max_broadcast_rows
    )
    activation = joined.join(dims, "model", "left")
    if source == "deduped":  # one (imei, imsi) pair of every device: the count is 1
        activation = activation.filter(F.col("imei").isNotNull()).withColumn("checkin_count", F.lit(1).cast("bigint"))
    else:
        activation = activation.join(checkin_count(u, "imei", "imsi"), "imei", "inner")
    activation = activation.select("imei", "activation_date", "first_checkin_date", "checkin_count")
    return {"activation": activation, "activation_model_dates": dims, "activation_rejects": rejects}


def activation_exceptions(uss_device: DataFrame, shipment: DataFrame, lo: Date = LO) -> DataFrame:
    """Latest whole check-in record of devices absent from shipment.  Both
    steps are by device, so the check-ins of shipped devices go first, and only
    the others' records are deduplicated."""
    left = only_not_in(uss_device.withColumn("__day", day_of("last_ts")), shipment, "imei")
    latest, _ = latest_per_key(left, ["imei"], "__day", lo)
    return latest.drop("__day")
