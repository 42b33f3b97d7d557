"""Registered queries: one per operator / job of the inventory.

Every query reads the test tables at ``sf_dir`` through the stand-in feeds
(``sources.fixtures``) and runs the library's own operators over the whole
tables.  Column names match the oracle SQL in ``devtrail.oracle``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Mapping
from functools import cache, cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import FIXTURE_AS_OF, FIXTURE_BUCKETS, HI, LO
from .functions.dates import day_of, in_order, min_date, parse_dates, valid_date, within_period
from .functions.warranty import source_bucket, warranty_tag
from .operators.aggregates import checkin_count, first_date_by, first_launch_date, last_date_by
from .operators.dedupe import latest_per_key
from .operators.guards import FAILED, guard_counts
from .operators.joins import enrich, enrich_left, full_outer_by, join_both_ends, lookup, prefixed
from .operators.sequence import distinct_observations, failure_tag, observations
from .plans import exchange as px
from .plans import repair as pr
from .plans import shipment as ps
from .plans.lifecycle import KEY_DATES, Lifecycle, date_rejects, write_outputs
from .session import release, scratch_path
from .sources import fixtures, textio
from .sources.landing import TextFeeds
from .sources.text import LAYOUTS, file_rows, read_lines, split_fields, union_text

# Narrowed bounds of the variant queries (FIXTURES.md section 2).
LO_LATE = _dt.date(2001, 6, 1)
HI_EARLY = _dt.date(1996, 1, 1)


class OnDemand(Mapping):
    """Feeds by name, each made when it is first asked for."""

    def __init__(self, names: Iterable[str], make: Callable[[str], DataFrame]):
        self._names, self._make = tuple(names), cache(make)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._make(name)

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Ctx(Lifecycle):
    """The lifecycle tables of one (session, data folder), each on demand; a
    query asks for one table, so its intermediates stay in one plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__({}, FIXTURE_BUCKETS, LO, HI, FIXTURE_AS_OF, materialize=False)
        self.spark, self.sf_dir = spark, sf_dir

    def feed(self, name: str) -> DataFrame:
        return fixtures.stored_feed(self.spark, self.sf_dir, name, among=self.share)

    @property
    def uss(self) -> DataFrame:
        return self.feed("uss_device")

    @property
    def ship_orig(self) -> DataFrame:
        return self.feed("shipment_orig")

    @property
    def sdac_orig(self) -> DataFrame:
        return self.feed("sdac_orig")

    @property
    def repair_orig(self) -> DataFrame:
        return self.feed("repair_orig")

    @property
    def shipment_model(self) -> DataFrame:
        return self.ship["shipment_model"]

    @property
    def move(self) -> DataFrame:
        return self.moved("move")

    @property
    def swap(self) -> DataFrame:
        return self.moved("swap")

    def whole(self) -> DataFrame:
        """The timeline: its four branches read one staged new_shipment and one
        staged table of SIM transitions."""
        self.share = True
        return self.timeline

    def spoiled(self, name: str) -> DataFrame:
        """A feed with impossible dates in it."""
        return fixtures.spoil(self.feed(name), name)

    @cached_property
    def spoiled_run(self) -> Lifecycle:
        """The lifecycle of the feeds with impossible dates."""
        return Lifecycle(OnDemand(KEY_DATES, self.spoiled), FIXTURE_BUCKETS, LO, HI, FIXTURE_AS_OF, materialize=False)

    @cached_property
    def placed_run(self) -> Lifecycle:
        """The lifecycle of feeds that have all their raw positions, as scanned."""
        payload = {**textio.RAW_PAYLOAD, "repair_orig": textio.REPAIR_PAYLOAD_LAST}
        feeds = OnDemand(KEY_DATES, lambda name: textio.place(self.feed(name), LAYOUTS[name], payload[name]))
        return Lifecycle(feeds, FIXTURE_BUCKETS, LO, HI, FIXTURE_AS_OF, materialize=False)

    # shared pieces of single-operator queries
    @cached_property
    def ship_typed(self) -> DataFrame:
        return ps.prepare_shipment(self.ship_orig)

    @cached_property
    def repair_typed(self) -> DataFrame:
        return pr.prepare_repair(self.repair_orig)

    @cached_property
    def checkins(self) -> DataFrame:
        return ps.last_checkins(self.uss)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Ctx], DataFrame]) -> Callable[[Ctx], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir))

    run.__doc__, run.__name__ = fn.__doc__, fn.__name__
    QUERIES[fn.__name__] = run
    return fn


# ---------------------------------------------------------------- B: guards
@query
def b1_width_guard(c: Ctx) -> DataFrame:
    """B1: a folder holding shipment lines (29 fields) and SDAC lines (7
    fields) scanned with the shipment layout: per field count, accepted or not."""
    return textio.width_guard_report(c.spark, c.ship_orig, c.sdac_orig)


@query
def b2_valid_date(c: Ctx) -> DataFrame:
    """B2: text dates of the shipment feed and their guarded DateType value."""
    return c.ship_orig.select(
        F.col("mfg_date").alias("mfg_text"),
        F.col("shipment_date").alias("ship_text"),
        valid_date("mfg_date").alias("mfg_day"),
        valid_date("shipment_date").alias("ship_day"),
    )


@query
def b3_day_of_timestamp(c: Ctx) -> DataFrame:
    """Day part of the check-in timestamps (NULL unless longer than 10)."""
    return c.uss.select(
        "first_ts", "last_ts", day_of("first_ts").alias("first_day"), day_of("last_ts").alias("last_day")
    )


@query
def b4_stale_filter(c: Ctx) -> DataFrame:
    """SDAC records created more than 28 days before the reference date."""
    from .operators.quality import stale

    return stale(parse_dates(c.sdac_orig, "create_date"), "create_date", as_of=FIXTURE_AS_OF)


@query
def b5_in_order(c: Ctx) -> DataFrame:
    """Null-tolerant mfg_date <= shipment_date flag for every raw row."""
    s = c.ship_typed
    return s.select("imei", "order_id", "mfg_date", "shipment_date", in_order("mfg_date", "shipment_date").alias("in_order"))


@query
def b6_ship_before_mfg(c: Ctx) -> DataFrame:
    """B6 (P2 side output): raw shipment rows manufactured after shipment."""
    return c.ship["shipment_exception"]


# ------------------------------------------------------- D: scalar functions
@query
def d1_min_date(c: Ctx) -> DataFrame:
    """Earlier of purchase and claim date, skipping absent ones."""
    r = c.repair_typed
    return r.select("imei", "claim_id", "purchase_date", "claim_date", min_date("purchase_date", "claim_date").alias("first_date"))


@query
def d4_within_period(c: Ctx) -> DataFrame:
    """Claim within warranty_period x 30 days of the purchase date."""
    r = c.repair_typed
    return r.select(
        "imei", "claim_id", "purchase_date", "claim_date", "warranty_period",
        within_period("purchase_date", "claim_date", "warranty_period").alias("within"),
    )


@query
def d5_warranty_tag(c: Ctx) -> DataFrame:
    """Claims per data source and warranty tag (P5 output)."""
    return c.repair["repair"].groupBy("data_source", "is_real_in_warranty").agg(F.count(F.lit(1)).alias("n"))


@query
def d6_source_bucket_counts(c: Ctx) -> DataFrame:
    """Raw claims per data-source bucket."""
    b = source_bucket("data_source", FIXTURE_BUCKETS)
    return c.repair_orig.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query
def d8_event_header(c: Ctx) -> DataFrame:
    """new_shipment rows with the ('shipment', shipment_date) header."""
    return c.new_shipment["new_shipment_events"]


@query
def d11_observations(c: Ctx) -> DataFrame:
    """Two observations (first-seen, last-seen day) per valid check-in."""
    return observations(c.uss)


@query
def d12_shipment_model(c: Ctx) -> DataFrame:
    """(imei, model) of each device's latest shipment."""
    return ps.build_shipment_model(c.ship_orig, LO)


@query
def f2_distinct_observations(c: Ctx) -> DataFrame:
    """distinct observations."""
    return distinct_observations(observations(c.uss), rows=2 * c.uss.count())


# ------------------------------------------------------------ C: aggregation
@query
def c1_latest_shipment(c: Ctx) -> DataFrame:
    """Latest shipment record per device."""
    good, _ = latest_per_key(c.ship_typed, ["imei"], "shipment_date", LO)
    return good


@query
def c1_shipment_rejects_lo2001(c: Ctx) -> DataFrame:
    """C1 with lo = 2001-06-01: devices whose latest shipment is below the floor."""
    _, rejects = latest_per_key(c.ship_typed, ["imei"], "shipment_date", LO_LATE)
    return rejects


@query
def c1_latest_device_per_sim(c: Ctx) -> DataFrame:
    """C1 by imsi: the latest check-in device of each SIM."""
    u = c.checkins.select("imsi", "imei", F.col("activation_date").alias("day"))
    good, _ = latest_per_key(u, ["imsi"], "day", LO)
    return good


@query
def c1_latest_sim_per_device(c: Ctx) -> DataFrame:
    """C1 by imei: the SIM and day of each device's latest check-in."""
    good, _ = latest_per_key(c.checkins, ["imei"], "activation_date", LO)
    return good


@query
def c2_earliest_sdac(c: Ctx) -> DataFrame:
    """Earliest SDAC record per device."""
    good, _ = ps.earliest_sdac(c.sdac_orig, HI)
    return good


@query
def c2b_repair_dedupe(c: Ctx) -> DataFrame:
    """One claim per (imei, claim_date)."""
    good, _ = pr.dedupe_repair(c.repair_orig, HI)
    return good


@query
def c2b_repair_rejects_hi1996(c: Ctx) -> DataFrame:
    """C2b with hi = 1996-01-01: claims at/after the ceiling are rejected."""
    _, rejects = pr.dedupe_repair(c.repair_orig, HI_EARLY)
    return rejects


@query
def c2b_repair_dedupe_hi1996(c: Ctx) -> DataFrame:
    """C2b with hi = 1996-01-01: the accepted claims."""
    good, _ = pr.dedupe_repair(c.repair_orig, HI_EARLY)
    return good


@query
def c3_first_mfg_date(c: Ctx) -> DataFrame:
    """First manufacturing date per model over raw rows."""
    return first_date_by(c.ship_typed, "model", {"first_mfg_date": "mfg_date"}, HI)


@query
def c3_first_ship_date(c: Ctx) -> DataFrame:
    """First shipment date per model over raw rows."""
    return first_date_by(c.ship_typed, "model", {"first_shipment_date": "shipment_date"}, HI)


@query
def c3_first_ship_date_hi1996(c: Ctx) -> DataFrame:
    """C3 with hi = 1996-01-01 (the ceiling caps the minimum)."""
    return first_date_by(c.ship_typed, "model", {"first_shipment_date": "shipment_date"}, HI_EARLY)


@query
def c3_first_checkin_date(c: Ctx) -> DataFrame:
    """First check-in date per model over shipped devices' activation dates."""
    good, _ = latest_per_key(c.checkins, ["imei"], "activation_date", LO)
    joined = good.join(c.shipment_model, "imei")
    return first_date_by(joined, "model", {"first_checkin_date": "activation_date"}, HI)


@query
def c3_first_sdac_date(c: Ctx) -> DataFrame:
    """First SDAC date per model over shipped devices' earliest records."""
    good, _ = ps.earliest_sdac(c.sdac_orig, HI)
    joined = good.join(c.shipment_model, "imei")
    return first_date_by(joined, "model", {"first_sdac_date": "create_date"}, HI)


@query
def c4_last_seen_per_device(c: Ctx) -> DataFrame:
    """C4: latest last-seen day per device, floored at 2000-01-01."""
    return last_date_by(c.checkins, "imei", "activation_date", LO, name="last_seen")


@query
def c4_last_seen_per_device_lo2001(c: Ctx) -> DataFrame:
    """C4 with lo = 2001-06-01: every device below the floor reports the floor."""
    return last_date_by(c.checkins, "imei", "activation_date", LO_LATE, name="last_seen")


@query
def c4_last_ship_date(c: Ctx) -> DataFrame:
    """C4: latest valid shipment date per device from raw rows."""
    return pr.last_shipment_dates(c.ship_orig, LO)


@query
def c5_first_launch_date(c: Ctx) -> DataFrame:
    """First launch date per model (earlier of first SDAC / first check-in)."""
    ns = c.new_shipment["new_shipment"]
    return first_launch_date(ns, "model", "sdac_first_sdac_date", "act_first_checkin_date", HI)


@query
def c6_checkin_count(c: Ctx) -> DataFrame:
    """SIM multiplicity on the deduplicated pair (always 1)."""
    good, _ = latest_per_key(c.checkins, ["imei"], "activation_date", LO)
    return checkin_count(good, "imei", "imsi")


@query
def c6_checkin_count_raw(c: Ctx) -> DataFrame:
    """C6 (raw): distinct SIMs per device over all valid check-ins, capped at 2."""
    return checkin_count(c.checkins, "imei", "imsi")


# ------------------------------------------------------------- W: sequences
@query
def w1_failure_count(c: Ctx) -> DataFrame:
    """W1: '1' for a device's first claim date, '2' for later claims."""
    good, _ = pr.dedupe_repair(c.repair_orig, HI)
    return failure_tag(good, "imei", "claim_date")


@query
def w2_move(c: Ctx) -> DataFrame:
    """SIM moved to a device of another model."""
    return c.move


@query
def w2_swap(c: Ctx) -> DataFrame:
    """SIM moved to another unit of the same model."""
    return c.swap


@query
def w2_transition_counts(c: Ctx) -> DataFrame:
    """Number of move and swap transitions."""
    t = px.build_transitions(c.uss)
    return t.groupBy("eventtype").agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- E: joins
@query
def e1_repair_x_shipment(c: Ctx) -> DataFrame:
    """Tagged claims joined to the device's latest shipment date."""
    good, _ = pr.dedupe_repair(c.repair_orig, HI)
    return enrich(failure_tag(good), pr.last_shipment_dates(c.ship_orig, LO))


@query
def e1_activation_x_model(c: Ctx) -> DataFrame:
    """Latest check-in per device joined to the shipped model."""
    good, _ = latest_per_key(c.checkins, ["imei"], "activation_date", LO)
    return enrich(good, c.shipment_model)


@query
def e2_left_enrich(c: Ctx) -> DataFrame:
    """Every shipped device with its SDAC row or NULLs."""
    sdac = prefixed(c.sdac["sdac"], "sdac_").withColumn("imei", F.col("sdac_imei"))
    return enrich_left(c.ship["shipment"], sdac)


@query
def e3_full_outer_model_dates(c: Ctx) -> DataFrame:
    """Per-model first SDAC and first check-in dates, full outer join."""
    sd = c.sdac["sdac"].join(c.shipment_model, "imei").select("model", "first_sdac_date").distinct()
    ac = (
        c.activation["activation"].join(c.shipment_model, "imei").select("model", "first_checkin_date").distinct()
    )
    return full_outer_by(sd, ac, "model")


@query
def e4_sdac_not_shipped(c: Ctx) -> DataFrame:
    """Earliest SDAC records of devices absent from shipment."""
    return ps.sdac_exceptions(c.sdac["sdac_first"], c.ship["shipment"])


@query
def e4_activation_not_shipped(c: Ctx) -> DataFrame:
    """Latest check-in records of devices absent from shipment."""
    return ps.activation_exceptions(c.uss, c.ship["shipment"], LO)


@query
def e4_repair_not_shipped(c: Ctx) -> DataFrame:
    """Deduplicated claims of devices absent from shipment."""
    return pr.repair_exceptions(c.repair["repair_first"], c.ship["shipment"])


@query
def e4_cabandon_not_shipped(c: Ctx) -> DataFrame:
    """Abandoned-SIM records whose device is absent from shipment."""
    return px.exchange_exceptions(c.cabandon["cabandon"], c.ship["shipment"])


@query
def e4_dabandon_not_shipped(c: Ctx) -> DataFrame:
    """Abandoned-device records whose device is absent from shipment."""
    return px.exchange_exceptions(c.dabandon, c.ship["shipment"])


@query
def e5_broadcast_model_dates(c: Ctx) -> DataFrame:
    """E5: model first dates looked up (size-checked broadcast) per device."""
    return lookup(c.shipment_model, ps.model_first_dates(c.ship_orig, HI), "model")


@query
def e6_move_both_ends(c: Ctx) -> DataFrame:
    """Move records joined to the shipment of both devices."""
    j = join_both_ends(c.move, c.ship["shipment"], "imei", "toimei", "imei", "xchg_", "to_")
    return j.select("xchg_uid", "imei", "model", "to_imei", "to_model", "xchg_eventdate")


# ------------------------------------------------------ F: timeline / union
@query
def f1_union_all(c: Ctx) -> DataFrame:
    """F1/P10: the whole event timeline."""
    return c.whole()


@query
def f1_event_counts(c: Ctx) -> DataFrame:
    """timeline rows per event type."""
    return c.whole().groupBy("eventtype").agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------- P: the jobs
@query
def p2_shipment(c: Ctx) -> DataFrame:
    """Shipment table."""
    return c.ship["shipment"]


@query
def p3_sdac(c: Ctx) -> DataFrame:
    """Sdac table."""
    return c.sdac["sdac"]


@query
def p4_activation(c: Ctx) -> DataFrame:
    """Activation table."""
    return c.activation["activation"]


@query
def p5_repair(c: Ctx) -> DataFrame:
    """P5: repair table."""
    return c.repair["repair"]


@query
def p6_new_shipment(c: Ctx) -> DataFrame:
    """new_shipment table."""
    return c.new_shipment["new_shipment"]


@query
def p6_new_shipment_exception(c: Ctx) -> DataFrame:
    """Devices shipped after their first use."""
    return c.new_shipment["new_shipment_exception"]


@query
def p7_new_complex(c: Ctx) -> DataFrame:
    """cabandon/dabandon/swap events with the device's new_shipment row."""
    return c.new_complex


@query
def p8_new_move(c: Ctx) -> DataFrame:
    """Move events with both devices' new_shipment rows."""
    return c.new_move


@query
def p9_new_repair(c: Ctx) -> DataFrame:
    """Repair events with the device's new_shipment row."""
    return c.new_repair["new_repair"]


@query
def p9_new_repair_exception(c: Ctx) -> DataFrame:
    """Claims dated before the device's first use."""
    return c.new_repair["new_repair_exception"]


@query
def p11_cabandon(c: Ctx) -> DataFrame:
    """Abandoned SIMs as exchange records."""
    return c.cabandon["cabandon"]


@query
def p12_dabandon(c: Ctx) -> DataFrame:
    """Abandoned devices as exchange records."""
    return c.dabandon


# ------------------------------------------------------------ A: text edges
@query
def a1_text_roundtrip(c: Ctx) -> DataFrame:
    """A1/A4: shipment feed written as 29-field Ctrl-A text, scanned back and
    re-typed."""
    return textio.shipment_roundtrip(c.spark, c.ship_orig)


@query
def a4_shipment_text_roundtrip(c: Ctx) -> DataFrame:
    """A4/A5/A1: the P2 shipment table written as 31-field text with its
    markers and read back as a typed table."""
    return textio.shipment_table_roundtrip(c.spark, c.ship["shipment"])


@query
def a2_multi_path_scan(c: Ctx) -> DataFrame:
    """Cabandon, dabandon and swap written to three text folders and
    scanned as one exchange table."""
    return textio.exchange_roundtrip(c.spark, [c.cabandon["cabandon"], c.dabandon, c.swap], "bigint", "bigint")


@query
def a5_ragged_render(c: Ctx) -> DataFrame:
    """A5: the timeline rendered as ragged text: lines per (event type, field count)."""
    return textio.ragged_report(c.spark, c.whole())


REPORT_FIELDS = {  # table of each report, and its device key and dates by position
    "sdac": ("sdac_exception", (1, 4)),
    "activation": ("activation_exception", (3, 4, 10)),
    "repair": ("repair_exception", (4, 13, 14, 27)),
    "cabandon": ("cabandon_exception", (0, 1, 2, 3, 4, 5)),
    "dabandon": ("dabandon_exception", (0, 1, 2, 3, 4, 5)),
}


def _report_text(c: Ctx, report: str) -> DataFrame:
    """A report of feeds in their raw positions, written by the one writer of
    text outputs as its columns stand, and read back by position only."""
    table, positions = REPORT_FIELDS[report]
    base = scratch_path(c.spark, "report")
    write_outputs({table: c.placed_run.table(table)}, base, fmt="text")
    return textio.by_position(c.spark, f"{base}/{table}", positions)


@query
def e4_sdac_text(c: Ctx) -> DataFrame:
    """P16 as text, read by position."""
    return _report_text(c, "sdac")


@query
def e4_activation_text(c: Ctx) -> DataFrame:
    """P15 as text, read by position."""
    return _report_text(c, "activation")


@query
def e4_repair_text(c: Ctx) -> DataFrame:
    """P17 as text, read by position: purchase date and period as they came."""
    return _report_text(c, "repair")


@query
def e4_cabandon_text(c: Ctx) -> DataFrame:
    """P18 as text, read by position."""
    return _report_text(c, "cabandon")


@query
def e4_dabandon_text(c: Ctx) -> DataFrame:
    """P19 as text, read by position."""
    return _report_text(c, "dabandon")


EVENT_TABLES = ("new_shipment_events", "new_complex", "new_move", "new_repair")


@query
def p10_union_text(c: Ctx) -> DataFrame:
    """P10/F1 on text: the four event tables written each on its own, put
    together line by line, and read by position."""
    base = scratch_path(c.spark, "events")
    c.whole()
    for name in EVENT_TABLES:
        textio.write_event_text(c.table(name), f"{base}/{name}", payload=textio.EVENT_PAYLOAD, compression=textio.DENSE_CODEC)
        release(c.spark)  # the joins' shuffles
    union_text(c.spark, [f"{base}/{name}" for name in EVENT_TABLES], f"{base}/timeline", compression=textio.DENSE_CODEC)
    release(c.spark)
    return textio.by_position(c.spark, f"{base}/timeline", EVENT_FIELDS)


@query
def g1_file_rows(c: Ctx) -> DataFrame:
    """G1: check-ins, a third of them in one partition of the shuffle (which
    several tasks read), written as text in files of at most a twelfth of the
    rows: rows, whether every file keeps the limit, and whether none has over
    twice the mean."""
    path, n = scratch_path(c.spark, "files"), c.uss.count()
    limit = max(1, n // 12)
    hot = F.when(F.col("imei") % 3 == 0, F.lit(0)).otherwise(F.col("imei"))
    skewed = c.uss.withColumn("__hot", hot).hint("rebalance", 8, "__hot").drop("__hot")
    textio.write_delimited(skewed, path, rows_per_file=limit)
    files = file_rows(c.spark, path)
    return files.agg(F.sum("n").alias("n_rows"), (F.max("n") <= limit).alias("within_limit"), (F.max("n") <= 2 * F.avg("n")).alias("even"))


def _written(c: Ctx, mode: str) -> tuple[DataFrame, str]:
    """SDAC records written as text, then those without a date to the same path
    in ``mode``; the rows left, and what became of the second write."""
    path = scratch_path(c.spark, "modes")
    textio.write_delimited(c.sdac_orig, path, mode="errorifexists")
    try:
        textio.write_delimited(c.sdac_orig.filter(F.col("create_date") == ""), path, mode=mode)
        second = "written"
    except AnalysisException as e:
        second = e.getCondition()
    left = read_lines(c.spark, path)
    f = split_fields(left)
    return left.select(*(f.getItem(i).alias(name) for i, name in enumerate(c.sdac_orig.columns))), second


@query
def a6_overwrite(c: Ctx) -> DataFrame:
    """A text table written over another: only the second one's lines are left."""
    left, second = _written(c, "overwrite")
    return left.withColumn("second", F.lit(second))


@query
def a7_error_if_exists(c: Ctx) -> DataFrame:
    """A second write to the same path is refused, and the first one's lines stay."""
    left, second = _written(c, "errorifexists")
    return left.withColumn("second", F.lit(second))


@query
def a5_timeline_roundtrip(c: Ctx) -> DataFrame:
    """A3/A5: the timeline written as ragged text and read back row for row."""
    return textio.timeline_roundtrip(c.spark, c.whole())


# header, imei, first_mfg_date, sdac imei, first_launch_date, xchg uid/uidtype/toimei, rep imei and tag, to imei and launch date
EVENT_FIELDS = (0, 1, 11, 31, 34, 45, 46, 47, 49, 56, 90, 100, 134)


@query
def a5_complex_text(c: Ctx) -> DataFrame:
    """new_complex written alone as text, fields and markers by position."""
    return textio.events_by_position(c.spark, c.new_complex, EVENT_FIELDS)


@query
def a5_move_text(c: Ctx) -> DataFrame:
    """new_move written alone as text, fields and markers by position."""
    return textio.events_by_position(c.spark, c.new_move, EVENT_FIELDS)


@query
def a5_repair_text(c: Ctx) -> DataFrame:
    """new_repair written alone as text, fields and markers by position."""
    return textio.events_by_position(c.spark, c.new_repair["new_repair"], EVENT_FIELDS)


def _counted(feed: str, **parts: DataFrame) -> DataFrame:
    """One row: the number of rows of each table."""
    out = None
    for name, df in parts.items():
        n = df.agg(F.count(F.lit(1)).alias(name))
        out = n if out is None else out.crossJoin(n)  # one row by one row
    return out.select(F.lit(feed).alias("feed"), *parts)


def _used(c: Ctx, name: str) -> DataFrame:
    """The records that the jobs go on with, as their own first step leaves them."""
    date = KEY_DATES[name]
    prepare = {
        "shipment_orig": ps.prepare_shipment, "sdac_orig": lambda f: parse_dates(f, date), "uss_device": ps.last_checkins, "repair_orig": pr.prepare_repair,
    }[name](c.feed(name))
    return prepare if name == "uss_device" else prepare.filter(F.col(date).isNotNull())


@query
def b2_date_rejects(c: Ctx) -> DataFrame:
    """Q7: per feed its records, those that the jobs use and the rejects, each counted."""
    rows = [_counted(name, records=c.feed(name), rejects=date_rejects(c.guard_rejects(name), name), good=_used(c, name)) for name in KEY_DATES]
    return reduce(DataFrame.unionByName, rows)


@query
def b2_guard_outcomes(c: Ctx) -> DataFrame:
    """Feeds with impossible dates and short lines written as raw text
    and landed by one scan each: lines, and good, flawed and bad ones as their
    own partitions hold them."""
    rows = []
    for name in KEY_DATES:
        path = textio.write_raw(c.spark, c.spoiled(name), name)
        landed = TextFeeds(c.spark, {name: path})[name]
        rows.append(_counted(name, records=read_lines(c.spark, path), good=landed.good, rejects=landed.rejects, bad_lines=landed.bad_lines))
    return reduce(DataFrame.unionByName, rows)


@query
def b2_guard_rejects(c: Ctx) -> DataFrame:
    """B2: reject records of shipments and claims with impossible dates, as they
    came, with the guards that each fails."""
    ship = c.spoiled_run.table("shipment_guard_rejects").select(
        F.lit("shipment_orig").alias("feed"), "imei", F.col("order_id").alias("record"), F.col("mfg_date").alias("first"), F.col("shipment_date").alias("second"),
        F.array_join(FAILED, ",").alias("failed"))
    rep = c.spoiled_run.table("repair_guard_rejects").select(
        F.lit("repair_orig").alias("feed"), "imei", F.col("claim_id").alias("record"), F.col("claim_date").alias("first"), F.col("purchase_date").alias("second"),
        F.array_join(FAILED, ",").alias("failed"))
    return ship.unionByName(rep)


@query
def b2_guard_counts(c: Ctx) -> DataFrame:
    """Rows that fail each guard of each feed."""
    return reduce(DataFrame.unionByName, [guard_counts(c.spoiled(name), name) for name in KEY_DATES])


@query
def b3_timestamp_rejects(c: Ctx) -> DataFrame:
    """Check-ins whose first-seen or last-seen day is impossible or absent."""
    return c.spoiled_run.table("uss_guard_rejects").withColumn(FAILED, F.array_join(FAILED, ","))


@query
def b3_checkins_used(c: Ctx) -> DataFrame:
    """P13/P14 on a feed with impossible dates: check-ins that the observations
    hold, and rejects, counted apart; together all records."""
    uss = c.spoiled("uss_device")
    out = _counted("uss_device", records=uss, halves=observations(uss), rejects=c.spoiled_run.table("uss_guard_rejects"))
    return out.select("records", (F.col("halves") / 2).cast("long").alias("used"), "rejects")


@query
def p13_spoiled_transitions(c: Ctx) -> DataFrame:
    """P13/P14 on a feed with impossible dates."""
    return c.spoiled_run.transitions


@query
def d5_warranty_tag_any_period(c: Ctx) -> DataFrame:
    """D5 over periods up to the limits of an int: tags, no overflow."""
    r = pr.prepare_repair(c.repair_orig).select("data_source", "purchase_date", "claim_date", "warranty_period")
    periods = F.explode(F.array(*[F.lit(x) for x in (99_999_999, 2_147_483_647, -2_147_483_648)]))
    r = r.withColumn("period", periods)
    tag = warranty_tag("data_source", "purchase_date", "claim_date", "purchase_date", "period", FIXTURE_BUCKETS)
    return r.withColumn("tag", tag).groupBy("period", "tag").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["QUERIES", "Ctx"]
