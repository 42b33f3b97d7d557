"""Operators on hand-written rows: bounds, ties, absent dates, transitions
(SURVEY 1.2 Q1, Q2, Q4, Q8, Q13, Q14, Q15, Q17) and a brute-force check of W2."""

import datetime as dt
import random

from tests.helpers import rows
from pyspark.sql import functions as F

from devtrail.operators import (
    checkin_count,
    earliest_per_key,
    failure_tag,
    first_date_by,
    first_launch_date,
    last_date_by,
    latest_per_key,
    not_in,
    observations,
    stale,
    timeline,
    transitions,
)

D = dt.date


def test_latest_per_key_floor_ties_and_rejects(spark):
    df = spark.createDataFrame(
        [
            ("a", D(2005, 1, 1), "x2"), ("a", D(2005, 1, 1), "x1"),  # tie on the best date
            ("a", D(2003, 1, 1), "x0"),
            ("b", D(1999, 12, 31), "y"),                              # below the floor only
            ("c", D(2000, 1, 1), "z"),                                # exactly the floor is accepted
            ("d", None, "w"),                                         # no valid date: not a candidate
        ],
        "k string, d date, p string",
    )
    good, rejects = latest_per_key(df, ["k"], "d", D(2000, 1, 1))
    assert rows(good) == [("a", D(2005, 1, 1), "x1"), ("c", D(2000, 1, 1), "z")]
    assert rows(rejects) == [("b", D(1999, 12, 31), "y")]


def test_earliest_per_key_ceiling_is_exclusive(spark):
    df = spark.createDataFrame(
        [("a", D(2019, 12, 31), 2), ("a", D(2019, 12, 31), 1), ("b", D(2020, 1, 1), 3), ("b", D(2021, 1, 1), 4)],
        "k string, d date, p int",
    )
    good, rejects = earliest_per_key(df, ["k"], "d", D(2020, 1, 1))
    assert rows(good) == [("a", D(2019, 12, 31), 1)]
    assert rows(rejects) == [("b", D(2020, 1, 1), 3)]


def test_dedup_of_a_hot_key_plans_partial_group_limit(spark):
    # one key holds a third of the rows: the partial WindowGroupLimit runs before the shuffle
    n = 3000
    data = [("hot", D(2001, 1, 1) + dt.timedelta(days=i % 400), i) for i in range(n // 3)]
    data += [(f"k{i}", D(2002, 1, 1), i) for i in range(2 * n // 3)]
    df = spark.createDataFrame(data, "k string, d date, p int")
    good, _ = latest_per_key(df, ["k"], "d", D(2000, 1, 1))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    best = [r for r in good.collect() if r.k == "hot"]
    assert len(best) == 1 and best[0].d == D(2001, 1, 1) + dt.timedelta(days=399) and best[0].p == 399
    assert good.count() == 1 + 2 * n // 3


def test_first_and_last_date_by(spark):
    df = spark.createDataFrame(
        [("m1", D(1995, 1, 1)), ("m1", D(2021, 1, 1)), ("m2", None), ("m3", D(2022, 5, 5))],
        "model string, d date",
    )
    first = first_date_by(df, "model", {"first": "d"}, D(2020, 1, 1))
    assert rows(first) == [("m1", D(1995, 1, 1)), ("m2", None), ("m3", D(2020, 1, 1))]
    last = last_date_by(df, "model", "d", D(2000, 1, 1), name="last")
    assert rows(last) == [("m1", D(2021, 1, 1)), ("m3", D(2022, 5, 5))]
    floored = last_date_by(df.filter("model = 'm1' and d < '2000-01-01'"), "model", "d", D(2000, 1, 1))
    assert rows(floored) == [("m1", D(2000, 1, 1))]


def test_first_launch_date_with_and_without_ceiling(spark):
    df = spark.createDataFrame(
        [("m1", D(2001, 1, 1), None), ("m1", None, D(2000, 6, 1)), ("m2", None, None)],
        "model string, a date, b date",
    )
    assert rows(first_launch_date(df, "model", "a", "b", D(2020, 1, 1))) == [
        ("m1", D(2000, 6, 1)), ("m2", D(2020, 1, 1))
    ]
    assert rows(first_launch_date(df, "model", "a", "b", None)) == [("m1", D(2000, 6, 1)), ("m2", None)]


def test_checkin_count_deduped_is_one_raw_caps_at_two(spark):
    raw = spark.createDataFrame(
        [("i1", "s1", D(2001, 1, 1)), ("i1", "s2", D(2001, 2, 1)), ("i1", "s3", D(2001, 3, 1)), ("i2", "s1", D(2001, 1, 1))],
        "imei string, imsi string, activation_date date",
    )
    latest, _ = latest_per_key(raw, ["imei"], "activation_date")
    assert rows(checkin_count(latest)) == [("i1", 1), ("i2", 1)]
    assert rows(checkin_count(raw)) == [("i1", 2), ("i2", 1)]


def test_failure_tag(spark):
    df = spark.createDataFrame(
        [("i1", D(2001, 1, 3)), ("i1", D(2001, 1, 1)), ("i1", D(2001, 1, 2)), ("i2", D(2001, 1, 1))],
        "imei string, claim_date date",
    )
    assert rows(failure_tag(df)) == [
        ("i1", D(2001, 1, 1), "1"), ("i1", D(2001, 1, 2), "2"), ("i1", D(2001, 1, 3), "2"), ("i2", D(2001, 1, 1), "1")
    ]


def _uss(spark, data):
    return spark.createDataFrame(data, "imsi string, imei string, model string, first_ts string, last_ts string")


def test_transitions_a_b_a_same_day_and_single(spark):
    t = lambda d: f"{d} 10:00:00"
    uss = _uss(spark, [
        ("s1", "A", "M1", t("2001-01-01"), t("2001-01-02")),
        ("s1", "B", "M2", t("2001-01-05"), t("2001-01-06")),   # move A->B
        ("s1", "A", "M1", t("2001-01-09"), t("2001-01-09")),   # move back B->A
        ("s2", "C", "M1", t("2001-01-01"), t("2001-01-01")),
        ("s2", "D", "M1", t("2001-01-01"), t("2001-01-01")),   # same-day neighbours: nothing
        ("s2", "E", "M1", t("2001-01-03"), t("2001-01-03")),   # D -> E next day, same model: swap
        ("s3", "F", "M1", t("2001-01-01"), t("2001-01-04")),   # one device only: nothing
        ("s4", "G", "M1", "", t("2001-01-04")),                 # invalid first-seen: dropped
    ])
    got = rows(transitions(observations(uss)), "imsi", "from_imei", "to_imei", "eventdate", "kind")
    assert got == [
        ("s1", "A", "B", D(2001, 1, 5), "move"),
        ("s1", "B", "A", D(2001, 1, 9), "move"),
        ("s2", "D", "E", D(2001, 1, 3), "swap"),
    ]


def _brute_transitions(obs):
    """The surveyed sort-and-chain, per SIM, on distinct observations in
    (date, imei, model) order."""
    out = []
    by_sim = {}
    for imsi, imei, model, d in set(obs):
        by_sim.setdefault(imsi, []).append((d, imei, model))
    for imsi, seq in by_sim.items():
        seq.sort()
        for (ld, li, lm), (rd, ri, rm) in zip(seq, seq[1:]):
            if li != ri and ld != rd:
                out.append((imsi, li, ri, rd, "swap" if lm == rm else "move"))
    return sorted(out, key=repr)


def test_transitions_match_brute_force_with_a_hot_sim(spark):
    rnd = random.Random(7)
    data = []
    for i in range(1500):
        imsi = "hot" if i % 3 == 0 else f"s{rnd.randrange(40)}"  # one SIM holds a third of the rows
        imei = f"d{rnd.randrange(30)}"
        model = f"m{int(imei[1:]) % 4}"
        a = D(2001, 1, 1) + dt.timedelta(days=rnd.randrange(60))
        b = a + dt.timedelta(days=rnd.randrange(3))
        data.append((imsi, imei, model, f"{a} 01:00:00", f"{b} 02:00:00"))
    uss = _uss(spark, data)
    obs = [(r.imsi, r.imei, r.model, r.obs_date) for r in observations(uss).collect()]
    got = rows(transitions(observations(uss)), "imsi", "from_imei", "to_imei", "eventdate", "kind")
    assert got == _brute_transitions(obs)
    assert any(g[0] == "hot" for g in got)


def test_not_in_keeps_left_duplicates(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "imei string, v int")
    ref = spark.createDataFrame([("b",), ("b",), ("z",)], "imei string")
    anti = not_in(left, ref)
    assert rows(anti) == [("a", 1), ("a", 2), ("c", 4)]
    assert anti.count() + left.join(ref.distinct(), "imei", "left_semi").count() == left.count()


def test_stale_boundary(spark):
    df = spark.createDataFrame([(D(2001, 9, 3),), (D(2001, 9, 2),), (D(2001, 10, 5),)], "d date")
    assert rows(stale(df, "d", 28, D(2001, 10, 1))) == [(D(2001, 9, 2),)]  # 28 days is not stale, 29 is


def test_timeline_keeps_duplicates_and_fills_slots(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1)], "eventtype string, v int")
    b = spark.createDataFrame([("y", 2, "p")], "eventtype string, v int, w string")
    t = timeline(a, b)
    assert t.columns == ["eventtype", "v", "w"]
    assert rows(t) == [("x", 1, None), ("x", 1, None), ("y", 2, "p")]


def test_empty_keys_join_but_null_keys_do_not(spark):
    # Q18: an empty text key is an ordinary value; NULL never matches in an equi join
    from devtrail.operators import enrich

    left = spark.createDataFrame([("", 1), (None, 2), ("a", 3)], "imei string, v int")
    right = spark.createDataFrame([("", "x"), (None, "y"), ("a", "z")], "imei string, w string")
    assert rows(enrich(left, right)) == [("", 1, "x"), ("a", 3, "z")]
    assert rows(not_in(left, right)) == [(None, 2)]
