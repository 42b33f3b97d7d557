"""Sequence operators: claim ordinal (W1), observations (D11, F2) and SIM
device transitions (W2).

No window runs over an unbounded device or SIM group, so a key holding a third
of all rows never lands in one task:

* W1 is a window minimum per device over deduplicated claims: at most one row
  per device and calendar day.
* W2 first reduces observations to one row per (SIM, day) holding the
  smallest and largest (imei, model) of that day, a partial aggregate.
  Adjacent observations on the same day never emit a transition, so the only
  candidate pairs are "last of one day -> first of the next observed day"; the
  lag window then runs over at most one row per calendar day and SIM, a size
  bounded by the calendar, not by the data.  Device and model are packed into
  one number that sorts like the pair (``device_codes``), so the reduction is a
  hash aggregate and check-ins are never sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..config import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from ..functions.dates import day_of
from ..session import ROWS_PER_DISTINCT, buckets, stage
from .joins import row_bytes


def failure_tag(df: DataFrame, key: str = "imei", date: str = "claim_date", name: str = "failure_count") -> DataFrame:
    """``'1'`` for the row at the key's first date, ``'2'`` for every later
    one.  Expects one row per (key, date) -- the output of ``dedupe`` -- so a
    key's window holds at most one row per calendar day; its partitioning by
    key serves the join that follows.  Rows with a null key or date drop out."""
    known = df.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
    first = F.min(date).over(Window.partitionBy(key))
    return known.withColumn(name, F.when(F.col(date) == first, F.lit("1")).otherwise(F.lit("2")))


def observations(
    uss: DataFrame,
    uid: str = "imsi",
    imei: str = "imei",
    model: str = "model",
    first_ts: str = "first_ts",
    last_ts: str = "last_ts",
    name: str = "obs_date",
) -> DataFrame:
    """Two observations per check-in row -- the first-seen day and the
    last-seen day -- for rows where both timestamps are valid (B3)."""
    # parse each timestamp once, then explode; a NULL array emits nothing, so
    # rows with an invalid timestamp drop out
    days = uss.select(
        F.col(uid), F.col(imei), F.col(model), day_of(first_ts).alias("__fd"), day_of(last_ts).alias("__ld")
    )
    fd, ld = F.col("__fd"), F.col("__ld")
    both = F.when(fd.isNotNull() & ld.isNotNull(), F.array(fd, ld))
    return days.select(uid, imei, model, F.explode(both).alias(name))


def distinct_observations(obs: DataFrame, rows: int | None = None) -> DataFrame:
    """distinct observation rows.

    Few observations are equal, so a map-side table of a task's distinct rows
    would hold nearly all of them.  The rows are dealt first, to as many
    partitions as ``rows`` (an upper bound; counted if not given) asks for, and
    a task's table holds about ``ROWS_PER_DISTINCT`` at any size of the input;
    equal rows meet there and take one entry."""
    n = buckets(obs.sparkSession, obs.count() if rows is None else rows, ROWS_PER_DISTINCT)
    return obs.repartition(n, *obs.columns).distinct()


@dataclass(frozen=True)
class DeviceCodes:
    """A number for each (device, model) that sorts like the pair, null first:
    ``(device - lowest + 1) * models + model's place``; no device is 0.

    ``models`` holds (model, place), to be broadcast; ``digits`` is the length
    of device texts, None for numbers."""

    models: DataFrame
    n: int
    lowest: int
    digits: int | None

    def pack(self, imei: Column, place: Column) -> Column:
        device = F.coalesce(imei.cast("bigint") - F.lit(self.lowest) + 1, F.lit(0).cast("bigint"))
        return device * F.lit(self.n).cast("bigint") + (place - 1)

    def device(self, code: Column) -> Column:
        """The device's number in a code, null for none."""
        at = F.call_function("div", code, F.lit(self.n).cast("bigint"))
        return F.when(at > 0, at - 1 + F.lit(self.lowest))

    def imei(self, code: Column, dtype: str) -> Column:
        number = self.device(code)
        return number.cast(dtype) if self.digits is None else F.lpad(number.cast("string"), self.digits, "0")

    def place(self, code: Column) -> Column:
        return (code % F.lit(self.n).cast("bigint") + 1).cast("int")


def device_codes(devices: DataFrame, imei: str = "imei", model: str = "model", max_models: int = MAX_BROADCAST_ROWS,
                 max_bytes: int = MAX_BROADCAST_BYTES) -> DeviceCodes | None:
    """Codes for the devices and models of a table, measured in one pass (a
    hash aggregate per model).  None if they do not fit: devices that are
    neither whole numbers nor digits of one length, too many models to
    broadcast, or more combinations than a 64-bit number has."""
    dtype = dict(devices.dtypes)[imei]
    if dtype not in ("tinyint", "smallint", "int", "bigint", "string"):
        return None
    text = F.col(imei).cast("string")
    fine = text.rlike("^[0-9]{1,18}$") if dtype == "string" else F.lit(True)
    number = F.when(fine, F.col(imei).cast("bigint")) if dtype == "string" else F.col(imei).cast("bigint")
    per_model = devices.groupBy(F.col(model).alias("model")).agg(
        F.min(number).alias("lo"), F.max(number).alias("hi"), F.min(F.length(text)).alias("short"), F.max(F.length(text)).alias("long"),
        F.max(F.when(~fine, 1).otherwise(0)).alias("odd"))
    seen = Observation()
    models = stage(per_model.observe(
        seen, F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("short").alias("short"),
        F.max("long").alias("long"), F.max("odd").alias("odd"), F.sum(row_bytes(per_model.select("model"))).alias("bytes")).select("model"), "models")
    m = seen.get
    if not m.get("n") or m["odd"] or m["n"] > max_models or m["bytes"] > max_bytes:
        return None
    if m["lo"] is None or (dtype == "string" and m["short"] != m["long"]):
        return None
    if (m["hi"] - m["lo"] + 2) * m["n"] >= 2**63:
        return None
    placed = models.select("model", F.row_number().over(Window.orderBy(F.col("model").asc_nulls_first())).alias("place"))  # few: checked above
    return DeviceCodes(F.broadcast(placed), m["n"], m["lo"], m["long"] if dtype == "string" else None)


def transitions(
    obs: DataFrame,
    uid: str = "imsi",
    imei: str = "imei",
    model: str = "model",
    date: str = "obs_date",
    kind: str | None = None,
    codes: DeviceCodes | None = None,
    with_models: bool = True,
) -> DataFrame:
    """Device changes of a SIM.

    Observations of one ``uid`` ordered by (date, imei, model); for each
    adjacent pair (l, r) with different devices and different days emit
    ``(uid, from_imei=l.imei, to_imei=r.imei, from_model, to_model, date=r.date,
    kind)`` where kind is ``'swap'`` when both devices are the same model and
    ``'move'`` otherwise.  Duplicate observations do not change the result.
    ``kind`` restricts the output to one of the two; without ``with_models`` the
    two model columns are left out.

    ``codes`` (``device_codes`` of a table that holds every device of ``obs``)
    reduces days by a hash aggregate of packed numbers; without them smallest
    and largest pairs are found by a sort aggregate, for keys that cannot be
    packed."""
    by_day = obs.filter(F.col(date).isNotNull())
    if codes is None:
        dev = F.struct(F.col(imei).alias("imei"), F.col(model).alias("model"))
        device, model_of = (lambda c: c["imei"]), (lambda c: c["model"])
    else:
        names = codes.models.select(F.col("model").alias("__model"), F.col("place").alias("__place"))
        by_day = by_day.join(names, F.col(model).eqNullSafe(F.col("__model")))
        dev = codes.pack(F.col(imei), F.col("__place"))
        device, model_of = codes.device, codes.place
    per_day = by_day.groupBy(uid, date).agg(F.min(dev).alias("__first"), F.max(dev).alias("__last"))
    w = Window.partitionBy(uid).orderBy(F.col(date).asc())
    chained = per_day.select(
        F.col(uid), F.col(date), F.col("__first"), F.lag("__last").over(w).alias("__prev")
    )
    l, r = F.col("__prev"), F.col("__first")
    moved = chained.filter(l.isNotNull() & ~device(l).eqNullSafe(device(r)))
    kinds = F.when(model_of(l).eqNullSafe(model_of(r)), F.lit("swap")).otherwise(F.lit("move"))
    if codes is None:
        imei_of = device
    else:
        dtype = dict(obs.dtypes)[imei]
        imei_of = lambda c: codes.imei(c, dtype)
    out = moved.select(
        F.col(uid), imei_of(l).alias("from_imei"), imei_of(r).alias("to_imei"), model_of(l).alias("from_model"), model_of(r).alias("to_model"),
        F.col(date).alias("eventdate"), kinds.alias("kind"))
    if kind is not None:
        out = out.filter(F.col("kind") == kind)
    if codes is not None and with_models:
        for end in ("from_model", "to_model"):
            place = codes.models.select(F.col("place").alias(end), F.col("model").alias("__name"))
            out = out.join(place, end).withColumn(end, F.col("__name")).drop("__name")
    columns = [uid, "from_imei", "to_imei", "from_model", "to_model", "eventdate", "kind"]
    return out.select(*(c for c in columns if with_models or c not in ("from_model", "to_model")))
