"""Bronze: registry adapter, batch/stream reads, landing, replay safety."""

import gzip
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.operators import gold, silver
from tallyflow.plans import pipeline
from tallyflow.session import scratch_path
from tallyflow.sources import raw
from tallyflow.sources.tables import TABLES
from tallyflow.sources.schema import BRONZE_COLUMNS, PAYMENT_EVENT_CONTRACT, schema_from_registry
from tallyflow.streaming import bronze as bronze_streaming

# One payment delivered twice; the later copy has another amount.
def _line(hour, amount, **more):
    return {"event_id": "evt-twice", "merchant_id": "mrc_0042", "user_id": "usr_7", "amount_usd": amount,
            "currency": "CAD", "status": "captured", "event_timestamp": f"2026-03-05T{hour:02d}:15:00Z", **more}


TWICE = [_line(8, 61.5), _line(11, 310)]


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _write_gz(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as f:
        for line in lines:
            f.write(line + "\n")


def test_registry_type_mapping():
    s = schema_from_registry(
        {"properties": {
            "a": {"type": "string"}, "b": {"type": "number"}, "c": {"type": "integer"},
            "d": {"type": "boolean"}, "e": {}, "f": {"type": ["null", "long"]},
            "g": {"type": "object"}, "h": "double",
        }}
    )
    assert [f.dataType for f in s.fields] == [
        T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.StringType(),
        T.LongType(), T.StringType(), T.DoubleType(),
    ]
    assert all(f.nullable for f in s.fields)


def test_contract_amount_is_untyped_string():
    assert "type" not in PAYMENT_EVENT_CONTRACT["properties"]["amount"]
    s = schema_from_registry(PAYMENT_EVENT_CONTRACT)
    assert s["amount"].dataType == T.StringType()
    assert s["amount_usd"].dataType == T.DoubleType()


def test_later_copy_reaches_silver_and_gold(spark):
    root = _local(scratch_path(spark, "examples"))
    _write_gz(f"{root}/year=2026/month=03/day=05/hour=08", "a.json.gz", [json.dumps(TWICE[0])])
    _write_gz(f"{root}/year=2026/month=03/day=05/hour=11", "b.json.gz", [json.dumps(TWICE[1])])
    b = raw.read_bronze_batch(spark, root)
    assert tuple(b.columns) == BRONZE_COLUMNS
    assert b.where(F.col("source_file").endswith(".json.gz")).count() == 2
    (s,) = silver.silver_payments(b).collect()
    assert s.amount == Decimal("310.00") and s.currency_normalized == "CAD"
    assert s.amount_band == "large" and (s.year, s.month, s.day) == ("2026", "03", "05")
    (g,) = gold.daily(silver.silver_payments(b)).collect()
    assert (g.full_date, g.country, g.amount, g.txn_count, g.unique_users, g.amount_band) == (
        "2026-03-05", "unknown", Decimal("310.00"), 1, 1, "medium")


def test_string_and_numeric_amounts_side_by_side(spark):
    root = _local(scratch_path(spark, "multi"))
    lines = [
        {"event_id": "a", "merchant_id": "m", "user_id": "u", "amount_usd": 12.34,
         "currency": "USD", "status": "captured", "event_timestamp": "2026-01-01T00:00:00Z"},
        {"event_id": "b", "merchant_id": "m", "user_id": "u", "amount": "9999999999999999.99",
         "currency": "USD", "status": "captured", "event_timestamp": "2026-01-01T00:00:00Z"},
        {"event_id": "c", "merchant_id": "m", "user_id": "u", "amount": 23.45,
         "currency": "USD", "status": "captured", "event_timestamp": "2026-01-01T00:00:00Z"},
    ]
    _write_gz(root, "x.json.gz", [json.dumps(x) for x in lines])
    got = {r.event_id: r.amount for r in silver.silver_payments(raw.read_bronze_batch(spark, root)).collect()}
    assert got == {"a": Decimal("12.34"), "b": Decimal("9999999999999999.99"), "c": Decimal("23.45")}


def test_malformed_line_and_extras(spark):
    root = _local(scratch_path(spark, "malformed"))
    extra = dict(TWICE[0], schema_version=3, payment_method="card", source_file="spoof")
    _write_gz(root, "x.json.gz", ["{not json", json.dumps(extra)])
    b = raw.read_bronze_batch(spark, root)
    assert tuple(b.columns) == BRONZE_COLUMNS  # extras dropped
    rows = silver.with_reasons(b).collect()
    bad = [r for r in rows if r.event_id is None]
    assert len(bad) == 1
    assert bad[0].rejection_reasons == [
        "missing_event_id", "missing_merchant_id", "missing_user_id", "missing_amount",
        "missing_status", "missing_event_timestamp",
    ]
    good = [r for r in rows if r.event_id is not None][0]
    assert good.source_file.endswith("x.json.gz")  # payload field replaced by the path
    explored = raw.explore_raw(spark, root)
    assert "payment_method" in explored.columns and "schema_version" in explored.columns


def test_stream_rerun_adds_nothing(spark):
    work = scratch_path(spark, "stream")
    root = _local(f"{work}/raw")
    _write_gz(f"{root}/year=2026/month=03/day=05/hour=08", "a.json.gz", [json.dumps(TWICE[0])])
    _write_gz(f"{root}/year=2026/month=03/day=05/hour=11", "b.json.gz", [json.dumps(TWICE[1])])
    run = lambda: bronze_streaming.append_bronze(bronze_streaming.bronze_stream(spark, root), f"{work}/bronze", f"{work}/ckpt")
    assert run() == (2, 2) and run() == (0, 2)
    # a new file is picked up by the next run, and only it; however old it is
    _write_gz(f"{root}/year=2026/month=03/day=05/hour=12", "c.json.gz", [json.dumps(TWICE[1])])
    old = f"{root}/year=2026/month=03/day=05/hour=12/c.json.gz"
    os.utime(old, (os.path.getmtime(old) - 30 * 86400,) * 2)
    assert run() == (1, 3)
    assert bronze_streaming.read_bronze(spark, f"{work}/bronze", TABLES["bronze_payments"].schema).count() == 3


def test_stream_and_batches_share_one_table(spark):
    work = scratch_path(spark, "both")
    root = _local(f"{work}/raw")
    _write_gz(root, "a.json.gz", [json.dumps(x) for x in TWICE])
    wh = pipeline.Warehouse(f"{work}/wh")
    metrics = lambda ms: {m.table: (m.added_records, m.total_records) for m in ms}
    assert metrics(pipeline.run_from_raw(spark, root, wh, f"{work}/ckpt"))["bronze_payments"] == (2, 2)
    batch = raw.read_bronze_batch(spark, root).withColumn("event_id", F.concat("event_id", F.lit("-b"), F.col("amount_usd").cast("string")))
    first = metrics(pipeline.publish_all(spark, batch, wh, "delivery-1"))
    assert first["bronze_payments"] == (2, 4) and first["silver_payments"] == (3, 3)
    # the same delivery again, as after a failure further down
    assert metrics(pipeline.publish_all(spark, batch, wh, "delivery-1"))["bronze_payments"] == (0, 4)
    _write_gz(root, "b.json.gz", [json.dumps(_line(14, 5, event_id="evt-new"))])
    assert metrics(pipeline.run_from_raw(spark, root, wh, f"{work}/ckpt"))["bronze_payments"] == (1, 5)
    again = pipeline.Warehouse(f"{work}/wh")
    assert again.read(spark, "bronze_payments").count() == 5 and again.read(spark, "silver_payments").count() == 4
    assert not spark.conf.get("spark.sql.shuffle.partitions") != "8"


def test_a_table_of_the_file_sink_is_refused(spark):
    path = scratch_path(spark, "sink")
    os.makedirs(f"{_local(path)}/_spark_metadata")
    with pytest.raises(ValueError, match="streaming file sink"):
        bronze_streaming.write_batch(spark.range(1).toDF("x"), path, "run", "r")


def test_empty_landing_publishes_empty_tables(spark):
    work = scratch_path(spark, "empty")
    os.makedirs(_local(f"{work}/raw"))
    out = {m.table: m.total_records for m in pipeline.run_from_raw(spark, _local(f"{work}/raw"), pipeline.Warehouse(f"{work}/wh"), f"{work}/ckpt")}
    assert out["bronze_payments"] == out["silver_payments"] == out["fact_payments"] == 0 and out["dim_date"] == 4018
    wh = pipeline.Warehouse(f"{work}/wh")
    for name, table in TABLES.items():
        assert wh.read(spark, name).schema.simpleString() == table.schema.simpleString()
    assert wh.register_views(spark) and spark.table("fact_payments_rejected").count() == 0


def test_hour_of_one_landing_uses_all_writers(spark):
    work = scratch_path(spark, "one_hour")
    lines = spark.range(4000).selectExpr("concat('{\"n\":', id, '}') AS line", "timestamp'2026-03-05 08:10:00' AS delivered_at")
    lines.write.parquet(f"{work}/in")
    stream = spark.readStream.schema(lines.schema).parquet(f"{work}/in")
    bronze_streaming.land_stream(stream, f"{work}/out", f"{work}/ckpt")
    files = [f for _, _, fs in os.walk(_local(f"{work}/out")) for f in fs if f.endswith(".gz")]
    assert len(files) >= 5 and spark.read.text(f"{work}/out").count() == 4000


def test_landing_layout(spark):
    root = scratch_path(spark, "landing")
    lines = spark.createDataFrame(
        [('{"a":1}', "2026-09-19 04:10:00"), ('{"a":2}', "2026-09-19 23:59:59")],
        "line string, delivered_at string",
    ).withColumn("delivered_at", F.to_timestamp("delivered_at"))
    raw.land_raw(lines, root)
    local = _local(root)
    assert os.path.isdir(f"{local}/year=2026/month=09/day=19/hour=04")
    assert os.path.isdir(f"{local}/year=2026/month=09/day=19/hour=23")
    files = [f for _, _, fs in os.walk(local) for f in fs if f.endswith(".gz")]
    assert files
    back = spark.read.text(root)
    assert sorted(back.columns) == ["day", "hour", "month", "value", "year"]


def test_pipeline_from_raw_twice(spark):
    work = scratch_path(spark, "pipe")
    root = _local(f"{work}/raw")
    _write_gz(root, "a.json.gz", [json.dumps(x) for x in TWICE])
    wh = pipeline.Warehouse(f"{work}/wh")
    m1 = {m.table: m for m in pipeline.run_from_raw(spark, root, wh, f"{work}/ckpt")}
    m2 = {m.table: m for m in pipeline.run_from_raw(spark, root, wh, f"{work}/ckpt")}
    assert (m1["bronze_payments"].added_records, m1["bronze_payments"].total_records) == (2, 2)
    assert (m2["bronze_payments"].added_records, m2["bronze_payments"].total_records) == (0, 2)
    assert m2["silver_payments"].total_records == 1 and m2["dim_date"].total_records == 4018
    fact = wh.read(spark, "fact_payments").collect()
    assert len(fact) == 1 and fact[0].full_date == "2026-03-05" and fact[0].country == "unknown"
