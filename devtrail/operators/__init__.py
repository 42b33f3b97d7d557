"""DataFrame -> DataFrame operators of the lifecycle engine."""

from .aggregates import checkin_count, first_date_by, first_launch_date, last_date_by
from .dedupe import best_per_key, dedupe, earliest_per_key, latest_per_key, split_bound, top1_per_key
from .events import superset_schema, timeline, to_exchange, widen, with_event_header
from .joins import (
    enrich,
    enrich_left,
    full_outer_by,
    join_both_ends,
    lookup,
    not_in,
    only_not_in,
    prefixed,
    sized_broadcast,
)
from .quality import chronology_exceptions, stale
from .sequence import device_codes, distinct_observations, failure_tag, observations, transitions

__all__ = [
    "best_per_key",
    "checkin_count",
    "chronology_exceptions",
    "dedupe",
    "device_codes",
    "distinct_observations",
    "earliest_per_key",
    "enrich",
    "enrich_left",
    "failure_tag",
    "first_date_by",
    "first_launch_date",
    "full_outer_by",
    "join_both_ends",
    "last_date_by",
    "latest_per_key",
    "lookup",
    "not_in",
    "observations",
    "only_not_in",
    "prefixed",
    "sized_broadcast",
    "split_bound",
    "stale",
    "superset_schema",
    "timeline",
    "to_exchange",
    "top1_per_key",
    "transitions",
    "widen",
    "with_event_header",
]
