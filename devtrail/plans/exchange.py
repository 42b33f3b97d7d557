"""Exchange-record sources from the check-in log: P11 cabandon (SIM
abandoned), P12 dabandon (device abandoned), P13 move / P14 swap (SIM moved
to another device), and the not-shipped reports P18, P19."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LO, STALE_DAYS
from ..functions.dates import day_of
from ..operators.aggregates import last_date_by
from ..operators.dedupe import best_per_key, split_bound
from ..operators.events import to_exchange
from ..operators.joins import not_in
from ..operators.quality import stale
from ..operators.sequence import device_codes, observations, transitions
from ..session import stage

Date = _dt.date | str | None


def _types(df: DataFrame) -> tuple[str, str]:
    t = dict(df.dtypes)
    return t["imsi"], t["imei"]


def _last_seen(uss_device: DataFrame) -> DataFrame:
    d = day_of("last_ts")
    return uss_device.select("imsi", "imei", d.alias("day")).filter(d.isNotNull())


def build_cabandon(
    uss_device: DataFrame, lo: Date = LO, as_of: Date = None, days: int = STALE_DAYS, materialize: bool = False
) -> dict[str, DataFrame]:
    """For each SIM its latest check-in (C1 by imsi); SIMs not seen for
    more than ``days`` days before ``as_of`` become
    ``(imsi, 'imsi', imei, NULL, 'cabandon', day)``.  ``materialize`` writes
    the per-SIM dedup once so the rejects need no second pass."""
    uid_t, imei_t = _types(uss_device)
    best = best_per_key(_last_seen(uss_device), ["imsi"], "day", latest=True)
    if materialize:
        best = stage(best, "cabandon_best")
    latest, rejects = split_bound(best, "day", lo=lo)
    gone = stale(latest, "day", days, as_of)
    ex = to_exchange(gone, "imsi", "imsi", "imei", None, "cabandon", "day", uid_t, imei_t)
    return {"cabandon": ex, "cabandon_rejects": rejects}


def build_dabandon(uss_device: DataFrame, lo: Date = LO, as_of: Date = None, days: int = STALE_DAYS) -> DataFrame:
    """Per device the latest last-seen day floored at ``lo`` (C4);
    devices not seen for more than ``days`` days become
    ``(NULL, NULL, imei, NULL, 'dabandon', day)``."""
    uid_t, imei_t = _types(uss_device)
    last = last_date_by(_last_seen(uss_device), "imei", "day", lo)
    gone = stale(last, "day", days, as_of)
    return to_exchange(gone, None, None, "imei", None, "dabandon", "day", uid_t, imei_t)


def build_transitions(uss_device: DataFrame, kind: str | None = None) -> DataFrame:
    """SIM device transitions (D11 -> W2 -> D9) as exchange records
    ``(imsi, 'imsi', from_imei, to_imei, 'move'|'swap', day)``."""
    uid_t, imei_t = _types(uss_device)
    codes = device_codes(uss_device)
    t = transitions(observations(uss_device), kind=kind, codes=codes, with_models=False)
    return to_exchange(t, "imsi", "imsi", "from_imei", "to_imei", F.col("kind"), "eventdate", uid_t, imei_t)


def exchange_exceptions(exchange: DataFrame, shipment: DataFrame) -> DataFrame:
    """Exchange records whose device is absent from shipment."""
    return not_in(exchange, shipment, "imei")
