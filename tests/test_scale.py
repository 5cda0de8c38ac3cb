"""Scale behaviour: partition pruning and hot keys."""

from pyspark.sql import functions as F

from helpers import bronze, row
from tallyflow.operators import marts, outbound, silver
from tallyflow.plans import pipeline
from tallyflow.plans.layers import from_testdata
from tallyflow.session import scratch_path
from tallyflow.sources import fixture, raw
from tallyflow.sources.schema import BRONZE_COLUMNS

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_day_slice_prunes_partitions(spark):
    wh = pipeline.Warehouse(scratch_path(spark, "prune"))
    pipeline.publish_all(spark, fixture.bronze_from_dir(spark, SF), wh, "fixture")
    fact = wh.read(spark, "fact_payments")
    q = marts.top_merchants_gmv(fact, full_date="2024-01-05")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(full_date" in plan and "2024-01-05" in plan
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,captured)]" in plan
    expected = marts.top_merchants_gmv(from_testdata(spark, SF).fact).where("full_date = '2024-01-05'")
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, expected.collect()))
    # unparseable times are quarantined into the null day partition and read back as null
    rej = wh.read(spark, "silver_payments_rejected")
    no_day = rej.where("year IS NULL").count()
    assert no_day == rej.where("event_timestamp_utc IS NULL").count() > 0


def test_raw_explore_prunes_delivery_folders(spark):
    root = scratch_path(spark, "explore")
    b = fixture.bronze_from_dir(spark, SF, with_delivery=True)
    raw.land_raw(b.select(F.to_json(F.struct(*BRONZE_COLUMNS)).alias("line"), "delivered_at"), root)
    df = raw.explore_raw(spark, root).where("day = 3 AND hour = 12")
    plan = _plan(df)
    assert "PartitionFilters" in plan and "(day#" in plan
    want = b.where("day(delivered_at) = 3 AND hour(delivered_at) = 12").count()
    assert df.count() == want > 0


def test_hot_merchant_is_split_across_route_partitions(spark):
    hot = [("e%05d" % i, "hot", "{}") for i in range(3000)]
    cold = [("c%05d" % i, "m%03d" % (i % 200), "{}") for i in range(6000)]
    lines = spark.createDataFrame(hot + cold, "event_id string, merchant_id string, line string")
    routed = outbound.route_by_merchant(lines, 8).withColumn("p", F.spark_partition_id())
    parts = routed.where("merchant_id = 'hot'").select("p").distinct().count()
    assert parts >= 2  # a third of all rows is not one task
    # each merchant still occupies one contiguous run of partitions
    spans = routed.groupBy("merchant_id").agg(F.min("p").alias("lo"), F.max("p").alias("hi"),
                                              F.countDistinct("p").alias("n"))
    assert spans.where("hi - lo + 1 != n").count() == 0


def test_replayed_key_with_a_third_of_rows(spark):
    replays = [row(event_id="hot", amount=f"{i % 50 + 1}.00",
                   event_timestamp=f"2026-10-09T{i % 24:02d}:00:00Z") for i in range(600)]
    others = [row(event_id=f"e{i}") for i in range(1200)]
    b = bronze(spark, replays + others).repartition(8)
    out = silver.silver_payments(b)
    assert out.count() == 1201
    (h,) = out.where("event_id = 'hot'").collect()
    assert h.event_timestamp == "2026-10-09T23:00:00Z"
