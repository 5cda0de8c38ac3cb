"""Plan shape: the physical plans we rely on for scale."""

from tallyflow.operators import marts
from tallyflow.plans.layers import from_testdata

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(from_testdata(spark, SF).silver)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan
    # the partial limit runs before the shuffle on the dedup key
    assert plan.index("Exchange hashpartitioning(event_id") < plan.rindex("WindowGroupLimit")


def test_scan_prunes_columns_and_no_python(spark):
    plan = _plan(from_testdata(spark, SF).fact)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct"):
        assert bad not in plan


def test_dimension_joins_broadcast(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        L = from_testdata(spark, SF)
        plans = [
            _plan(marts.captured_by_country(spark, L.fact)),
            _plan(marts.gmv_by_revenue_status(spark, L.fact)),
            _plan(marts.fact_with_calendar(spark, L.all_payments)),
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for p in plans:
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_fact_filter_reaches_below_aggregate(spark):
    """The fact's status filter is a grain column, so Catalyst moves it below
    the aggregate; it must stop above the dedup window (filtering before the
    dedup would change which copy of an event wins)."""
    opt = from_testdata(spark, SF).fact._jdf.queryExecution().optimizedPlan().toString()
    lines = opt.split("\n")
    agg = next(i for i, line in enumerate(lines) if "Aggregate" in line)
    flt = next(i for i, line in enumerate(lines) if "Filter" in line and "failed" in line)
    win = next(i for i, line in enumerate(lines) if "Window " in line or "+- Window" in line)
    assert agg < flt < win
