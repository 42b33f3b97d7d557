"""Reject records (B2, B3, Q7): every guard of a feed, checked on every row.

A row that fails a guard is not lost to every job: a check-in with an
impossible first-seen day still counts for the activation date.  So rejects are
a report beside the feed -- one record per input row that fails any guard, as
it came, with the list of the guards it failed -- and each job goes on to use
the fields that are good.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NA_MARKER, NULL_MARKER
from ..functions.dates import as_int, day_of, valid_date

FAILED = "failed_guards"
ABSENT = ("", NULL_MARKER, NA_MARKER)


@dataclass(frozen=True)
class Guard:
    """A field and its check, whose result is NULL for a bad value.  An absent
    value (NULL, empty or a marker) fails only a ``required`` field."""

    field: str
    check: Callable[[Column], Column]
    required: bool = True

    def fails(self, dtype: str) -> Column:
        value = F.col(self.field)
        if dtype != "string":  # typed already: only absence is left to check
            return value.isNull() if self.required else F.lit(False)
        bad = self.check(value).isNull()
        return bad if self.required else bad & value.isNotNull() & ~value.isin(*ABSENT)


#: Guards of each raw feed, in the order in which a record lists them.
GUARDS = {
    "shipment_orig": (Guard("mfg_date", valid_date, required=False), Guard("shipment_date", valid_date)),
    "sdac_orig": (Guard("create_date", valid_date),),
    "uss_device": (Guard("first_ts", day_of), Guard("last_ts", day_of)),
    "repair_orig": (Guard("claim_date", valid_date), Guard("purchase_date", valid_date, required=False), Guard("warranty_period", as_int)),
}


def failed_guards(feed: DataFrame, name: str) -> Column:
    """The names of the guards that a row of the feed fails (empty: none)."""
    types = dict(feed.dtypes)
    checks = [F.when(g.fails(types[g.field]), F.lit(g.field)) for g in GUARDS[name] if g.field in types]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def guard_rejects(feed: DataFrame, name: str) -> DataFrame:
    """One record per row that fails a guard: the row as it came, and the list."""
    return feed.withColumn(FAILED, failed_guards(feed, name)).filter(F.size(FAILED) > 0)


def guard_counts(feed: DataFrame, name: str) -> DataFrame:
    """(feed, guard, n): rows that fail each guard, in one pass; a guard that no
    row fails has 0."""
    tagged = feed.select(failed_guards(feed, name).alias(FAILED))
    counts = tagged.agg(*(F.count_if(F.array_contains(FAILED, g.field)).alias(g.field) for g in GUARDS[name]))
    pairs = F.explode(F.array(*(F.struct(F.lit(g.field).alias("guard"), F.col(g.field).alias("n")) for g in GUARDS[name])))
    return counts.select(F.lit(name).alias("feed"), pairs.alias("p")).select("feed", "p.guard", "p.n")
