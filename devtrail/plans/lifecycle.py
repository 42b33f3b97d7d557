"""All jobs in one session: feeds in, every table of the lifecycle out.

``Lifecycle`` builds a table and what it depends on when it is asked for it.
Intermediates that several outputs read (the dedups, the dimension joins,
new_shipment, the abandoned devices, the SIM transitions and the event joins)
are written once as tables in the shared checkpoint folder, so each is computed
once and lineage stays short.  ``write_outputs`` writes each table once --
Parquet by default, or the positional Ctrl-A text layout.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GRACE_MONTHS, HI, LO, STALE_DAYS, Buckets
from ..operators.guards import FAILED, guard_rejects
from ..session import buckets, release, together
from ..sources.landing import Landing
from ..sources.text import LAYOUTS, read_delimited, write_delimited, write_table
from ..sources.textio import null_markers, write_event_text
from .exchange import build_cabandon, build_dabandon, build_transitions, exchange_exceptions
from .repair import build_new_repair, build_repair, repair_exceptions
from .shipment import activation_exceptions, build_activation, build_sdac, build_shipment, sdac_exceptions, shared, shared_by_device
from .timeline import build_new_complex, build_new_move, build_new_shipment, build_timeline

Date = _dt.date | str | None
EVENT_TABLES = ("new_shipment_events", "new_complex", "new_move", "new_repair", "timeline")
FEEDS = ("shipment_orig", "sdac_orig", "uss_device", "repair_orig")


def read_text_feeds(
    spark: SparkSession, paths: Mapping[str, str | Sequence[str]]
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Scan the four raw Ctrl-A feeds (A1/A2/B1): ``(feeds, rejects)``, the
    rejects being lines of the wrong width."""
    feeds, rejects = {}, {}
    for name in FEEDS:
        feeds[name], rejects[name] = read_delimited(spark, paths[name], LAYOUTS[name])
    return feeds, rejects


#: The date that a feed's record is chosen by; without it a record is a reject.
KEY_DATES = {"shipment_orig": "shipment_date", "sdac_orig": "create_date", "uss_device": "last_ts", "repair_orig": "claim_date"}


def date_rejects(rejects: DataFrame, name: str) -> DataFrame:
    """Q7: of a feed's reject records those whose key date fails its guard (B2,
    B3 for the check-in timestamp), as they came."""
    return rejects.filter(F.array_contains(FAILED, KEY_DATES[name])).drop(FAILED)


class Lifecycle:
    """The tables of the 18 surveyed jobs by name, each built on demand.

    ``feeds`` maps names to DataFrames, or to landed text (``TextFeeds``), whose
    outcomes are read from its partitions.  ``land`` writes each DataFrame that
    is needed once as a Parquet table before anything reads it.  Without ``materialize``
    intermediates stay in one plan, for a caller that wants a single table;
    ``share`` then still stages what the branches of the timeline read:
    new_shipment, and the records that are joined to it, so that the last plan
    holds no shuffles but those of the joins."""

    def __init__(
        self,
        feeds: Mapping[str, DataFrame | Landing],
        buckets: Buckets,
        lo: Date = LO,
        hi: Date = HI,
        as_of: Date = None,
        days: int = STALE_DAYS,
        grace: int = GRACE_MONTHS,
        checkin_source: str = "deduped",
        land: bool = False,
        materialize: bool = True,
        share: bool = False,
    ):
        self.feeds, self.buckets, self.lo, self.hi, self.as_of, self.days = feeds, buckets, lo, hi, as_of, days
        self.grace, self.checkin_source, self.land = grace, checkin_source, land
        self.materialize, self.share = materialize, share
        self._landed: dict[str, DataFrame] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return shared(df, name) if self.materialize else df

    def feed(self, name: str) -> DataFrame:
        if name not in self._landed:
            source = self.feeds[name]
            if isinstance(source, Landing):
                self._landed[name] = source.feed
            else:
                self._landed[name] = shared(source, f"feed-{name}") if self.land else source
        return self._landed[name]

    def guard_rejects(self, name: str) -> DataFrame:
        """One record per row of a feed that fails a guard, with the list."""
        feed = self.feed(name)
        source = self.feeds.get(name)
        return source.rejects if isinstance(source, Landing) else guard_rejects(feed, name)

    @property
    def session(self) -> SparkSession:
        return self.feed("shipment_orig").sparkSession

    @cached_property
    def n_buckets(self) -> int | None:
        """Buckets of the run's device tables, by the rows of the landed shipment
        feed (at least one for each device); the session's if nothing is landed."""
        landed = self.land or isinstance(self.feeds.get("shipment_orig"), Landing)
        return buckets(self.session, self.feed("shipment_orig").count()) if landed else None

    @cached_property
    def ship(self) -> dict[str, DataFrame]:
        return build_shipment(self.feed("shipment_orig"), self.lo, self.hi, n_buckets=self.n_buckets)

    @cached_property
    def sdac(self) -> dict[str, DataFrame]:
        return build_sdac(
            self.feed("sdac_orig"), self.ship["shipment_model"], self.hi, materialize=self.materialize, n_buckets=self.n_buckets
        )

    @cached_property
    def activation(self) -> dict[str, DataFrame]:
        return build_activation(
            self.feed("uss_device"), self.ship["shipment_model"], self.lo, self.hi, self.checkin_source, materialize=self.materialize,
            n_buckets=self.n_buckets,
        )

    @cached_property
    def repair(self) -> dict[str, DataFrame]:
        made = build_repair(
            self.feed("repair_orig"), self.feed("shipment_orig"), self.buckets, self.lo, self.hi, self.grace, materialize=self.materialize
        )
        if self.share and not self.materialize:  # lies by device already: a claim a day at most
            made["repair"] = shared_by_device(made["repair"], "repair", self.n_buckets)
        return made

    @cached_property
    def new_shipment(self) -> dict[str, DataFrame]:
        self.ship  # both of the next need it
        together(self.session, lambda: self.sdac, lambda: self.activation)
        return build_new_shipment(
            self.ship["shipment"], self.sdac["sdac"], self.activation["activation"], self.hi,
            sdac_model_dates=self.sdac["sdac_model_dates"],
            activation_model_dates=self.activation["activation_model_dates"],
            materialize=self.materialize or self.share,  # read by five outputs: computed once
            n_buckets=self.n_buckets,
        )

    @cached_property
    def cabandon(self) -> dict[str, DataFrame]:
        made = build_cabandon(self.feed("uss_device"), self.lo, self.as_of, self.days, materialize=self.materialize)
        if self.share and not self.materialize:
            made["cabandon"] = shared(made["cabandon"], "cabandon")
        return made

    @cached_property
    def dabandon(self) -> DataFrame:
        made = build_dabandon(self.feed("uss_device"), self.lo, self.as_of, self.days)
        return shared(made, "dabandon") if self.materialize or self.share else made

    @cached_property
    def transitions(self) -> DataFrame:
        made = build_transitions(self.feed("uss_device"))
        return shared(made, "transitions") if self.materialize or self.share else made

    def moved(self, kind: str) -> DataFrame:
        """The transitions of a kind.  Both type columns hold one value here, so
        that they need not travel through the joins that follow."""
        constants = {"uidtype": F.lit("imsi"), "eventtype": F.lit(kind)}
        return self.transitions.filter(F.col("eventtype") == kind).withColumns(constants)

    @cached_property
    def new_complex(self) -> DataFrame:
        exchange = self.cabandon["cabandon"].unionByName(self.dabandon).unionByName(self.moved("swap"))
        return self.keep(build_new_complex(exchange, self.new_shipment["new_shipment"]), "new_complex")

    @cached_property
    def new_move(self) -> DataFrame:
        staged = self.materialize or self.share
        return self.keep(build_new_move(self.moved("move"), self.new_shipment["new_shipment"], staged=staged), "new_move")

    @cached_property
    def new_repair(self) -> dict[str, DataFrame]:
        return build_new_repair(self.repair["repair"], self.new_shipment["new_shipment"], materialize=self.materialize)

    @cached_property
    def timeline(self) -> DataFrame:
        """P10 from the staged event tables; what they read is built side by side,
        but for the transitions, whose shuffles are the largest and go first."""
        if self.materialize or self.share:
            self.transitions
            release(self.session)
            together(self.session, lambda: self.new_shipment, lambda: self.repair, lambda: self.cabandon, lambda: self.dabandon)
            release(self.session)
            if self.materialize:
                together(self.session, lambda: self.new_complex, lambda: self.new_move, lambda: self.new_repair)
        return build_timeline(
            self.new_shipment["new_shipment_events"], self.new_complex, self.new_move, self.new_repair["new_repair"]
        )

    def table(self, name: str) -> DataFrame:
        return TABLES[name](self)


TABLES = {
    "shipment": lambda c: c.ship["shipment"],
    "shipment_model": lambda c: c.ship["shipment_model"],
    "shipment_exception": lambda c: c.ship["shipment_exception"],
    "sdac": lambda c: c.sdac["sdac"],
    "activation": lambda c: c.activation["activation"],
    "repair": lambda c: c.repair["repair"],
    "new_shipment": lambda c: c.new_shipment["new_shipment"],
    "new_shipment_events": lambda c: c.new_shipment["new_shipment_events"],
    "new_shipment_exception": lambda c: c.new_shipment["new_shipment_exception"],
    "cabandon": lambda c: c.cabandon["cabandon"],
    "dabandon": lambda c: c.dabandon,
    "move": lambda c: c.moved("move"),
    "swap": lambda c: c.moved("swap"),
    "new_complex": lambda c: c.new_complex,
    "new_move": lambda c: c.new_move,
    "new_repair": lambda c: c.new_repair["new_repair"],
    "new_repair_exception": lambda c: c.new_repair["new_repair_exception"],
    "timeline": lambda c: c.timeline,
    "sdac_exception": lambda c: sdac_exceptions(c.sdac["sdac_first"], c.ship["shipment"]),
    "activation_exception": lambda c: activation_exceptions(c.feed("uss_device"), c.ship["shipment"], c.lo),
    "repair_exception": lambda c: repair_exceptions(c.repair["repair_first"], c.ship["shipment"]),
    "cabandon_exception": lambda c: exchange_exceptions(c.cabandon["cabandon"], c.ship["shipment"]),
    "dabandon_exception": lambda c: exchange_exceptions(c.dabandon, c.ship["shipment"]),
    "shipment_rejects": lambda c: c.ship["shipment_rejects"],
    "sdac_rejects": lambda c: c.sdac["sdac_rejects"],
    "activation_rejects": lambda c: c.activation["activation_rejects"],
    "repair_rejects": lambda c: c.repair["repair_rejects"],
    "repair_period_rejects": lambda c: c.repair["repair_period_rejects"],
    "cabandon_rejects": lambda c: c.cabandon["cabandon_rejects"],
    "shipment_date_rejects": lambda c: date_rejects(c.guard_rejects("shipment_orig"), "shipment_orig"),
    "sdac_date_rejects": lambda c: date_rejects(c.guard_rejects("sdac_orig"), "sdac_orig"),
    "uss_date_rejects": lambda c: date_rejects(c.guard_rejects("uss_device"), "uss_device"),
    "repair_date_rejects": lambda c: date_rejects(c.guard_rejects("repair_orig"), "repair_orig"),
    "shipment_guard_rejects": lambda c: c.guard_rejects("shipment_orig"),
    "sdac_guard_rejects": lambda c: c.guard_rejects("sdac_orig"),
    "uss_guard_rejects": lambda c: c.guard_rejects("uss_device"),
    "repair_guard_rejects": lambda c: c.guard_rejects("repair_orig"),
}
#: Tables that need the warranty rule's source labels.
BUCKET_TABLES = ("repair", "new_repair", "new_repair_exception", "timeline")


def run_lifecycle(
    feeds: Mapping[str, DataFrame], buckets: Buckets, *args, only: Sequence[str] | None = None, **options
) -> dict[str, DataFrame]:
    """The tables ``only`` (default: every output of the 18 surveyed jobs, plus
    rejects) from the feeds; what they do not depend on is not built.  Options
    as for ``Lifecycle``."""
    unknown = sorted(set(only or ()) - set(TABLES))
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(unknown)}; there are {', '.join(TABLES)}")
    run = Lifecycle(feeds, buckets, *args, **options)
    return {name: run.table(name) for name in TABLES if not only or name in only}


def write_outputs(
    outputs: Mapping[str, DataFrame],
    base: str,
    fmt: str = "parquet",
    num_files: Mapping[str, int] | None = None,
    mode: str = "overwrite",
    payload: Mapping[str, str] | None = None,
    rows_per_file: int | None = None,
) -> None:
    """Write each output once under ``base/<name>`` (Parquet, or Ctrl-A text
    with the null markers and the constant event positions; ``payload`` places
    the extra columns of typed feeds).  ``num_files`` gives some tables a number
    of files, ``rows_per_file`` all others even files of at most so many rows."""
    files = dict(num_files or {})
    for name, df in outputs.items():
        path = f"{base.rstrip('/')}/{name}"
        how = {"mode": mode, "num_files": files.get(name), "rows_per_file": None if files.get(name) else rows_per_file}
        if fmt == "parquet":
            write_table(df, path, **how)
        elif fmt != "text":
            raise ValueError("fmt must be 'parquet' or 'text'")
        elif name in EVENT_TABLES:
            write_event_text(df, path, payload=payload, **how)
        else:
            write_delimited(df, path, null_markers=null_markers(df), **how)
