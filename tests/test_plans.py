"""Physical plans: the shapes the design relies on at scale."""

import re

import pytest

from devtrail.config import HI
from devtrail.operators import first_date_by, lookup, not_in, observations, transitions
from devtrail.plans import shipment as ps
from devtrail.registry import QUERIES, Ctx
from devtrail.sources import fixtures

SF = "/root/testdata/sf0.001"
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ctx(spark):
    return Ctx(spark, SF)


def test_model_dates_hash_aggregate_and_pruned_scan(ctx):
    p = plan(ps.model_first_dates(ctx.ship_orig, HI))
    assert "HashAggregate" in p and "SortAggregate" not in p and "Window" not in p
    assert "ReadSchema: struct<model:string,mfg_date:string,shipment_date:string>" in p


def test_model_lookup_is_a_broadcast_join(ctx):
    dims = first_date_by(ps.prepare_shipment(ctx.ship_orig), "model", {"first": "shipment_date"}, HI)
    p = plan(lookup(ctx.shipment_model, dims, "model"))
    assert "BroadcastHashJoin" in p


def test_sized_broadcast_falls_back_to_shuffle_join(spark, ctx):
    dims = first_date_by(ps.prepare_shipment(ctx.ship_orig), "model", {"first": "shipment_date"}, HI)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:  # leave the decision to sized_broadcast alone
            spark.conf.set(k, "-1")
        assert "BroadcastHashJoin" in plan(lookup(ctx.shipment_model, dims, "model"))
        p = plan(lookup(ctx.shipment_model, dims, "model", max_rows=1))
        assert "BroadcastHashJoin" not in p and ("SortMergeJoin" in p or "ShuffledHashJoin" in p)
        p = plan(lookup(ctx.shipment_model, dims, "model", max_bytes=16))
        assert "BroadcastHashJoin" not in p
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_not_shipped_is_a_left_anti_join(ctx):
    p = plan(not_in(ctx.sdac_orig, ctx.ship_orig, "imei"))
    assert "LeftAnti" in p


def test_filter_reaches_the_scan(spark):
    p = plan(fixtures.sdac_orig(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in p


def test_transitions_window_runs_on_per_day_aggregates(ctx):
    p = plan(transitions(observations(ctx.uss)))
    agg = p.index("Aggregate")  # the per (SIM, day) aggregate sits below the window
    assert "Window" in p and p.index("Window") < agg
    assert "partial_min" in p and "partial_max" in p


def test_no_python_in_any_registered_plan(spark):
    for name in ("f1_union_all", "p5_repair", "p6_new_shipment", "w2_move", "p9_new_repair_exception"):
        p = plan(QUERIES[name](spark, SF))
        assert not any(n in p for n in PY_NODES), name


def test_broadcast_hint_survives_projection_of_the_dimension(spark):
    # new_shipment selects/renames the P3/P4 model dimensions before joining
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        p = plan(QUERIES["p6_new_shipment"](spark, SF))
        model_joins = re.findall(r"(\w+) \[model#\d+\], \[model#\d+\]", p)
        assert model_joins and set(model_joins) == {"BroadcastHashJoin"}, model_joins
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
