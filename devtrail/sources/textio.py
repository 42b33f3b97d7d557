"""Text-path helpers: place typed rows into a positional raw layout, parse
text records back into typed tables, and the ragged timeline layout.

Files go to a fresh folder under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIELD_SEP, NA_MARKER, NULL_MARKER
from ..functions.dates import valid_date
from ..session import scratch_path
from .text import LAYOUTS, Layout, event_width, place_events, read_delimited, read_lines, read_table, split_fields, write_delimited

#: Files of event lines that are read back here: mostly markers, a sixth of the bytes.
SCRATCH_CODEC = "lz4"
#: The same where the lines lie on disk twice, as tables and as their union: half the bytes of lz4.
DENSE_CODEC = "gzip"

# Where the stand-in feeds put their extra typed columns in the raw layouts
# (the opaque payload positions); all other opaque positions are empty.
SHIPMENT_PAYLOAD = {"c00": "order_id", "c01": "plant_id", "c02": "channel"}
SDAC_PAYLOAD = {"c00": "event_id"}
REPAIR_PAYLOAD = {"c01": "claim_id"}
#: As ``REPAIR_PAYLOAD``, with the claim id after the fields that order equal claims.
REPAIR_PAYLOAD_LAST = {"c30": "claim_id"}
EVENT_PAYLOAD = {
    **{f"{end}{p}": f"{end}{c}" for end in ("", "to_") for p, c in SHIPMENT_PAYLOAD.items()},
    **{f"{end}sdac_{p}": f"{end}sdac_{c}" for end in ("", "to_") for p, c in SDAC_PAYLOAD.items()},
    **{f"rep_{p}": f"rep_{c}" for p, c in REPAIR_PAYLOAD.items()},
}


def place(df: DataFrame, layout: Layout, payload: Mapping[str, str]) -> DataFrame:
    """Select ``df`` into the positional columns of ``layout``: named
    positions from the same-named column, payload positions from
    ``payload[position]``, every other position an empty string."""
    have = set(df.columns)
    cols = []
    for name in layout.columns():
        src = payload.get(name, name)
        cols.append((F.col(src) if src in have else F.lit("")).alias(name))
    return df.select(cols)


#: Where each raw feed's stand-in puts its extra columns.
RAW_PAYLOAD = {"shipment_orig": SHIPMENT_PAYLOAD, "sdac_orig": SDAC_PAYLOAD, "repair_orig": REPAIR_PAYLOAD, "uss_device": {}}
#: Records that ``write_raw`` cuts short by a field.
SHORT = {"shipment_orig": "order_id % 31 = 0", "sdac_orig": "event_id % 31 = 0", "repair_orig": "claim_id % 31 = 0", "uss_device": "imsi % 31 = 0"}


def write_raw(spark: SparkSession, feed: DataFrame, name: str) -> str:
    """A stand-in feed as raw text lines, some of them a field short; the path."""
    path, layout = scratch_path(spark, f"raw-{name}"), LAYOUTS[name]
    placed = place(feed.withColumn("__short", F.expr(SHORT[name])), Layout(layout.width + 1, {**dict(enumerate(layout.columns())), layout.width: "__short"}),
                   RAW_PAYLOAD[name])
    width = F.when(F.col("__short"), layout.width - 1).otherwise(layout.width)
    write_delimited(placed, path, ragged_width=width)
    return path


def shipment_roundtrip(spark: SparkSession, ship_orig: DataFrame) -> DataFrame:
    """Write the shipment feed as 29-field lines, scan it back (A1) and
    restore the stand-in feed's types."""
    path = scratch_path(spark, "shipment_orig")
    write_delimited(place(ship_orig, LAYOUTS["shipment_orig"], SHIPMENT_PAYLOAD), path)
    good, _ = read_delimited(spark, path, LAYOUTS["shipment_orig"])
    t = dict(ship_orig.dtypes)
    return good.select(
        F.col("imei").cast(t["imei"]).alias("imei"),
        "model",
        "mfg_date",
        "shipment_date",
        F.col("c00").cast(t["order_id"]).alias("order_id"),
        F.col("c01").cast(t["plant_id"]).alias("plant_id"),
        F.col("c02").alias("channel"),
    )


def shipment_table_roundtrip(spark: SparkSession, shipment: DataFrame) -> DataFrame:
    """A4/A5/A1 on a derived table: the shipment table written in its
    31-field text layout (absent model dates as ``NA``, absent fields as
    ``\\N``), scanned back with ``read_table`` and re-typed."""
    path = scratch_path(spark, "shipment_table")
    write_delimited(place(shipment, LAYOUTS["shipment"], SHIPMENT_PAYLOAD), path, null_markers={"first_mfg_date": NA_MARKER})
    t, _ = read_table(spark, path, "shipment")
    types = dict(shipment.dtypes)
    return t.select(
        F.col("imei").cast(types["imei"]).alias("imei"),
        "model",
        "mfg_date",
        "shipment_date",
        F.col("c00").cast(types["order_id"]).alias("order_id"),
        F.col("c01").cast(types["plant_id"]).alias("plant_id"),
        F.col("c02").alias("channel"),
        "first_mfg_date",
        "first_shipment_date",
    )


def width_guard_report(spark: SparkSession, ship_orig: DataFrame, sdac_orig: DataFrame) -> DataFrame:
    """B1: one folder scan over 29-field shipment lines and 7-field SDAC
    lines with the shipment layout -> (n_fields, accepted, n)."""
    base = scratch_path(spark, "width_guard")
    write_delimited(place(ship_orig, LAYOUTS["shipment_orig"], SHIPMENT_PAYLOAD), f"{base}/shipment")
    write_delimited(place(sdac_orig, LAYOUTS["sdac_orig"], SDAC_PAYLOAD), f"{base}/sdac")
    good, rejects = read_delimited(spark, [f"{base}/shipment", f"{base}/sdac"], LAYOUTS["shipment_orig"])
    width = LAYOUTS["shipment_orig"].width
    acc = good.select(F.lit(width).alias("n_fields"), F.lit(True).alias("accepted"))
    rej = rejects.select(F.size(split_fields(rejects)).alias("n_fields"), F.lit(False).alias("accepted"))
    return acc.unionByName(rej).groupBy("n_fields", "accepted").agg(F.count(F.lit(1)).alias("n"))


def _na_to_null(c: Column) -> Column:
    return F.when(c == NA_MARKER, F.lit(None)).otherwise(c)


def parse_exchange(text: DataFrame, uid_type: str = "string", imei_type: str = "string") -> DataFrame:
    """Typed exchange records from scanned text: ``NA`` means not applicable
    (NULL); ids cast to the device/SIM key types; eventdate guarded (B2)."""
    return text.select(
        _na_to_null(F.col("uid")).cast(uid_type).alias("uid"),
        _na_to_null(F.col("uidtype")).alias("uidtype"),
        _na_to_null(F.col("imei")).cast(imei_type).alias("imei"),
        _na_to_null(F.col("toimei")).cast(imei_type).alias("toimei"),
        F.col("eventtype"),
        valid_date("eventdate").alias("eventdate"),
    )


def exchange_roundtrip(
    spark: SparkSession, parts: Sequence[DataFrame], uid_type: str, imei_type: str
) -> DataFrame:
    """A2: write each exchange table to its own folder (``NA`` for absent
    fields), scan all folders as one table and re-type it."""
    base = scratch_path(spark, "exchange")
    paths = [f"{base}/{i}" for i in range(len(parts))]
    for df, p in zip(parts, paths):
        write_delimited(df, p, null_markers={c: NA_MARKER for c in df.columns})
    good, _ = read_delimited(spark, paths, LAYOUTS["exchange"])
    return parse_exchange(good, uid_type, imei_type)


# Columns whose absence means "not available" (NA) rather than "no joined row" (\\N).
_NA_DATES = ("first_mfg_date", "first_launch_date")
_NA_EXCHANGE = ("uid", "uidtype", "toimei")


def null_markers(df: DataFrame) -> dict[str, str | Column]:
    """A5 markers of the text layout: ``NA`` for a model date that does not
    exist and for the not-applicable fields of an exchange record; ``\\N``
    for every column of an absent joined row (the default)."""
    cols = set(df.columns)
    m: dict[str, str | Column] = {}
    for c in df.columns:
        base = c[3:] if c.startswith("to_") else c
        if base in _NA_DATES:
            m[c] = NA_MARKER
    for f in _NA_EXCHANGE:
        if f in cols and "eventtype" in cols and "xchg_eventtype" not in cols:
            m[f] = NA_MARKER  # a bare exchange table
        if "xchg_" + f in cols:
            m["xchg_" + f] = F.when(F.col("xchg_eventtype").isNotNull(), F.lit(NA_MARKER)).otherwise(F.lit(NULL_MARKER))
    return m


def write_event_text(
    events: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite", payload: Mapping[str, str] | None = None,
    rows_per_file: int | None = None, compression: str | None = None,
) -> None:
    """A5: an event table as ragged text in the constant timeline positions
    with its null markers; each event type drops its trailing slots, so the
    prefixes line up.  The one writer of event tables."""
    placed = place_events(events, payload)
    write_delimited(
        placed, path, num_files=num_files, mode=mode, null_markers=null_markers(placed), ragged_width=event_width(F.col("eventtype")),
        rows_per_file=rows_per_file, compression=compression,
    )


def ragged_report(spark: SparkSession, timeline: DataFrame) -> DataFrame:
    """A5: render the timeline as ragged text, scan it back and count lines
    per (event type, field count)."""
    path = scratch_path(spark, "timeline")
    write_event_text(timeline, path, payload=EVENT_PAYLOAD, compression=SCRATCH_CODEC)
    lines = read_lines(spark, path)
    f = split_fields(lines, FIELD_SEP)
    return lines.select(f.getItem(0).alias("eventtype"), F.size(f).alias("n_fields")).groupBy(
        "eventtype", "n_fields"
    ).agg(F.count(F.lit(1)).alias("n"))


def by_position(spark: SparkSession, path: str, positions: Sequence[int]) -> DataFrame:
    """Text lines read by position only: ``f<position>`` as text (NULL beyond
    a line's end), and the number of fields."""
    lines = read_lines(spark, path)
    f = split_fields(lines, FIELD_SEP)
    return lines.select(F.size(f).alias("n_fields"), *(F.get(f, F.lit(p)).alias(f"f{p}") for p in positions))


def events_by_position(spark: SparkSession, events: DataFrame, positions: Sequence[int]) -> DataFrame:
    """One event table written alone as text and read back by position."""
    path = scratch_path(spark, "events")
    write_event_text(events, path, payload=EVENT_PAYLOAD, compression=SCRATCH_CODEC)
    return by_position(spark, path, positions)


def timeline_roundtrip(spark: SparkSession, timeline: DataFrame) -> DataFrame:
    """A3/A5: the timeline written as ragged text, read back through its widths
    per event type, and given the types and columns it had."""
    path = scratch_path(spark, "timeline")
    write_event_text(timeline, path, payload=EVENT_PAYLOAD, compression=SCRATCH_CODEC)
    back, _ = read_table(spark, path, "timeline")
    place_of = {c: p for p, c in EVENT_PAYLOAD.items()}
    return back.select(*(F.col(place_of.get(c, c)).cast(t).alias(c) for c, t in timeline.dtypes))
