"""P6 new_shipment, P7 new_complex, P8 new_move and P10 timeline."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HI, MAX_BROADCAST_ROWS
from ..functions.dates import lit_date, min_date
from ..operators.aggregates import first_launch_date
from ..operators.events import superset_schema, timeline, with_event_header
from ..operators.joins import join_both_ends, lookup, prefixed
from ..operators.quality import chronology_exceptions
from .shipment import shared, shared_by_device

Date = _dt.date | str | None


def build_new_shipment(
    shipment: DataFrame,
    sdac: DataFrame,
    activation: DataFrame,
    hi: Date = HI,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    sdac_model_dates: DataFrame | None = None,
    activation_model_dates: DataFrame | None = None,
    materialize: bool = False,
    n_buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Every shipped device, left-joined to its SDAC row (``sdac_*``) and
    activation row (``act_*``), plus the model's first_launch_date (C5).

    first_launch_date is the earlier of the model's first SDAC date and first
    check-in date, capped at ``hi``.  When P3/P4 hand over their per-model
    dimensions (``sdac_model_dates``, ``activation_model_dates``, already
    size-checked and broadcast) it is read from those -- every SDAC and
    activation row belongs to a shipped device, so they hold exactly the
    per-model minima over new_shipment; otherwise it is aggregated over the
    joined rows.

    Outputs ``new_shipment``; ``new_shipment_events`` (header
    ``('shipment', shipment_date)``); ``new_shipment_exception``: devices
    shipped after their first use (earlier of SDAC create date and
    activation date).  With ``materialize`` new_shipment is written once as a
    table (it feeds the events, the exceptions and the complex, move and
    repair joins) and every output reads that table."""
    sd = prefixed(sdac, "sdac_")
    ac = prefixed(activation, "act_")
    joined = shipment.join(sd, F.col("imei") == F.col("sdac_imei"), "left").join(
        ac, F.col("imei") == F.col("act_imei"), "left"
    )
    if sdac_model_dates is not None and activation_model_dates is not None:
        hi_c = lit_date(hi)
        parts = [F.col("__fs"), F.col("__fc")] + ([hi_c] if hi_c is not None else [])
        ns = (
            joined.join(sdac_model_dates.select("model", F.col("first_sdac_date").alias("__fs")), "model", "left")
            .join(activation_model_dates.select("model", F.col("first_checkin_date").alias("__fc")), "model", "left")
            .select(*joined.columns, F.least(*parts).alias("first_launch_date"))
        )
    else:
        joined = shared(joined)
        dims = first_launch_date(joined, "model", "sdac_first_sdac_date", "act_first_checkin_date", hi)
        ns = lookup(joined, dims, "model", max_broadcast_rows).select(*joined.columns, "first_launch_date")
    if materialize:
        ns = shared_by_device(ns, "new_shipment", n_buckets)
    first_use = min_date("sdac_create_date", "act_activation_date")
    return {
        "new_shipment": ns,
        "new_shipment_events": with_event_header(ns, "shipment", "shipment_date"),
        "new_shipment_exception": chronology_exceptions(ns, "shipment_date", first_use),
    }


def build_new_complex(exchange: DataFrame, new_shipment: DataFrame) -> DataFrame:
    """Exchange records (cabandon, dabandon, swap) joined to the
    new_shipment row of their device: header from the record, then
    new_shipment, then ``xchg_*``."""
    x = prefixed(exchange, "xchg_")
    joined = x.join(new_shipment, F.col("xchg_imei") == F.col("imei"), "inner")
    body = joined.select(*new_shipment.columns, *x.columns)
    return with_event_header(body, F.col("xchg_eventtype"), "xchg_eventdate")


#: Columns of new_shipment that hold few combinations: the model, what is known
#: of each model, and a capped count.
PER_MODEL = (
    "model", "first_mfg_date", "first_shipment_date", "sdac_first_sdac_date", "act_first_checkin_date", "act_checkin_count", "first_launch_date",
)
#: Columns of new_shipment that repeat the device where its record exists.
ECHOES = ("sdac_imei", "act_imei")


def build_new_move(move: DataFrame, new_shipment: DataFrame, staged: bool = False) -> DataFrame:
    """Move records joined at both ends (E6): new_shipment of the
    source device, the record (``xchg_*``), new_shipment of the target device
    (``to_*``).  Of a ``staged`` new_shipment, which can be read twice at no
    great cost, the columns that many devices share do not travel with each
    move."""
    shared = (PER_MODEL, ECHOES) if staged else ((), ())
    joined = join_both_ends(move, new_shipment, "imei", "toimei", "imei", "xchg_", "to_", *([c for c in s if c in new_shipment.columns] for s in shared))
    xcols = [c for c in joined.columns if c.startswith("xchg_")]
    tcols = ["to_" + c for c in new_shipment.columns]
    body = joined.select(*new_shipment.columns, *xcols, *tcols)
    return with_event_header(body, F.col("xchg_eventtype"), "xchg_eventdate")


def build_timeline(
    shipment_events: DataFrame,
    complex_events: DataFrame,
    move_events: DataFrame,
    repair_events: DataFrame,
) -> DataFrame:
    """P10: union-all of the four event tables in one wide schema: header,
    new_shipment, ``xchg_*``, ``rep_*``, ``to_*`` (missing slots NULL)."""
    schema = superset_schema([shipment_events, complex_events, repair_events, move_events])
    return timeline(shipment_events, complex_events, move_events, repair_events, schema=schema)
