"""Parameters of the device-lifecycle jobs.

Every operator takes these as keyword arguments; the module-level values
are only the defaults.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# --- fixed values (must equal the surveyed jobs for identical results) ---
# Floor of every "latest" fold and ceiling of every "earliest" fold.
LO = _dt.date(2000, 1, 1)
HI = _dt.date(2020, 1, 1)
# A SIM or device is abandoned when last seen more than this many whole days ago.
STALE_DAYS = 28
# Warranty arithmetic: a month counts as 30 days; shipment-based warranty
# starts get 3 extra months of grace.
DAYS_PER_MONTH = 30
GRACE_MONTHS = 3
# Text layout: Ctrl-A field separator, Hive null marker, "not applicable" marker.
FIELD_SEP = "\u0001"
NULL_MARKER = "\\N"
NA_MARKER = "NA"
DATE_FORMAT = "yyyy-MM-dd"
# Multiplicity tag of SIMs per device is capped at 2 ("several").
CHECKIN_CAP = 2
# Output file counts of the surveyed jobs (optional, for file-layout parity
# with existing consumers; by default AQE sizes the files).
REFERENCE_FILE_COUNTS = {
    "timeline": 820,
    "new_shipment": 500,
    "new_shipment_events": 500,
    "shipment": 350,
    "new_complex": 250,
    "sdac": 80,
    "shipment_model": 64,
    "new_repair": 42,
    "cabandon": 30,
    "dabandon": 30,
    "repair": 20,
    "activation_exception": 20,
    "sdac_exception": 20,
    "repair_exception": 20,
    "move": 12,
    "swap": 12,
    "activation": 10,
    "new_shipment_exception": 10,
    "new_repair_exception": 10,
    "cabandon_exception": 10,
    "new_move": 6,
    "dabandon_exception": 6,
    "shipment_exception": 5,
}
# --- end of fixed values ---

# Largest dimension that may be broadcast (rows and in-memory bytes);
# above either bound the join shuffles both sides.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Buckets:
    """Repair data-source buckets for the warranty rule.

    The surveyed jobs hard-code two domestic and five overseas source labels
    of one deployment; here they are configuration.  Sources in neither list
    get tag ``0`` (unknown source).
    """

    domestic: tuple[str, ...] = field(default_factory=tuple)
    overseas: tuple[str, ...] = field(default_factory=tuple)


# Buckets of the oracle fixtures (FIXTURES.md): SRC_7 is the unknown source.
FIXTURE_BUCKETS = Buckets(
    domestic=("SRC_0", "SRC_1"),
    overseas=("SRC_2", "SRC_3", "SRC_4", "SRC_5", "SRC_6"),
)
# Reference date of the abandon jobs in the fixtures (instead of the wall clock).
FIXTURE_AS_OF = _dt.date(2001, 10, 1)
