"""Column functions: date guards, chronology, warranty truth table."""

import datetime as dt

from pyspark.sql import functions as F

from devtrail.config import Buckets
from devtrail.functions import day_of, in_order, min_date, valid_date, warranty_tag, within_period

D = dt.date


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_valid_date_rejects_garbage_and_impossible_days(spark):
    vals = ["2014-02-28", "2014-02-31", "", "\\N", "abcdefghij", "2014-2-3xx", " 014-02-03", "2014/02/03", None,
            "2014-02-28 10:00:00"]
    got = one_col(spark, vals, valid_date)
    assert got == [D(2014, 2, 28)] + [None] * 9


def test_day_of_needs_more_than_ten_chars(spark):
    vals = ["1995-03-14 00:00:00", "1995-03-14", "", "1995-02-30 01:02:03", "1995-03-14x"]
    assert one_col(spark, vals, day_of) == [D(1995, 3, 14), None, None, None, D(1995, 3, 14)]


def test_in_order_and_min_date_skip_absent(spark):
    df = spark.createDataFrame(
        [(D(2000, 1, 2), D(2000, 1, 1)), (D(2000, 1, 1), D(2000, 1, 1)), (None, D(2000, 1, 1)), (None, None)],
        "a date, b date",
    )
    got = df.select(in_order("a", "b"), min_date("a", "b")).collect()
    assert [tuple(r) for r in got] == [
        (False, D(2000, 1, 1)), (True, D(2000, 1, 1)), (True, D(2000, 1, 1)), (True, None)
    ]


def test_within_period(spark):
    s = D(2000, 1, 1)
    cases = [
        (s, s + dt.timedelta(days=360), 12, "1"),   # exactly 12 x 30 days
        (s, s + dt.timedelta(days=361), 12, "2"),
        (s, s - dt.timedelta(days=5), 12, "1"),     # claim before start counts as in
        (None, s, 12, "4"),
        (s, None, 12, "4"),
        (s, s, 0, "4"),
        (s, s, -1, "4"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "s date, e date, m int")
    got = [r[0] for r in df.select(within_period("s", "e", "m")).collect()]
    assert got == [c[3] for c in cases]


def test_warranty_truth_table(spark):
    b = Buckets(domestic=("DOM",), overseas=("OVS",))
    ship, buy = D(2000, 1, 1), D(2000, 3, 1)
    claim = D(2001, 1, 1)  # 366 days after shipment, 307 after purchase
    cases = [
        ("ZZZ", buy, claim, ship, -1, "3"),         # negative period beats unknown source
        ("ZZZ", buy, claim, ship, 12, "0"),         # unknown source
        ("DOM", buy, claim, ship, 10, "2"),         # from purchase, no grace: 307 > 300
        ("DOM", buy, claim, ship, 11, "1"),         # 307 <= 330
        ("DOM", None, claim, ship, 9, "2"),         # from shipment + 3 months: 366 > 360
        ("DOM", None, claim, ship, 10, "1"),        # 366 <= 390
        ("OVS", buy, claim, ship, 10, "1"),         # overseas ignores the purchase date
        ("OVS", buy, claim, ship, 8, "2"),          # 366 > 330
        ("DOM", buy, claim, ship, 0, "4"),          # period 0 with a purchase date
        ("DOM", None, claim, ship, 0, "2"),         # period 0 + grace = 90 days from shipment
        ("DOM", buy, D(1999, 1, 1), ship, 1, "1"),  # claim before the start counts as in
        ("OVS", buy, claim, None, 10, "4"),         # absent start date
    ]
    df = spark.createDataFrame([c[:5] for c in cases], "ds string, p date, c date, s date, m int")
    got = [r[0] for r in df.select(warranty_tag("ds", "p", "c", "s", "m", b)).collect()]
    assert got == [c[5] for c in cases]
