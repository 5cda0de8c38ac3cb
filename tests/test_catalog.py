"""Published tables in a catalog: created, replaced, described, read by name."""

import uuid

import pytest
from pyspark.sql import functions as F

from tallyflow.operators import dims, marts
from tallyflow.plans import pipeline
from tallyflow.plans.layers import Layers, from_testdata
from tallyflow.session import scratch_path
from tallyflow.sources.catalog import CatalogWarehouse, iceberg_settings
from tallyflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def wh(spark):
    found = CatalogWarehouse(scratch_path(spark, "catalog"), database=f"payments_{uuid.uuid4().hex[:8]}")
    found.create_database(spark, found.root)
    yield found
    spark.sql(f"DROP DATABASE {found.database} CASCADE")


def test_written_twice_described_and_read_by_name(spark, wh):
    layers = from_testdata(spark, SF)
    assert wh.read(spark, "fact_payments").count() == 0  # not there yet
    for df in (layers.daily, layers.fact):
        n = wh.write(df, "fact_payments")
        assert n.added_records == n.total_records == df.count()
    back = wh.read(spark, "fact_payments")
    assert back.columns == TABLES["fact_payments"].schema.fieldNames()
    assert back.exceptAll(layers.fact).isEmpty() and layers.fact.exceptAll(back).isEmpty()
    assert back.where("country = ''").count() > 0  # a blank value is no null
    notes = wh.described(spark, "fact_payments")
    assert notes == {"comment": TABLES["fact_payments"].comment, "properties": {"quality": "gold"}, "partitions": ["full_date"]}
    plan = spark.sql(f"SELECT * FROM {wh.table('fact_payments')} WHERE full_date = '2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(full_date" in plan
    status = wh.write(dims.dim_status(spark), "dim_status")
    assert status.total_records == 4 and wh.described(spark, "dim_status")["partitions"] == []


def test_a_session_setting_keeps_no_old_rows(spark, wh):
    layers = from_testdata(spark, SF)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        wh.write(layers.fact, "fact_payments")
        wh.write(layers.fact.where("full_date = '2024-01-05'"), "fact_payments")
        assert [r[0] for r in wh.read(spark, "fact_payments").select("full_date").distinct().collect()] == ["2024-01-05"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_a_whole_run_into_the_catalog(spark, wh):
    bronze = from_testdata(spark, SF).bronze
    metrics = {m.table: m.total_records for m in pipeline.publish_all(spark, bronze, wh, "r")}
    assert set(metrics) == set(TABLES)
    assert {n: wh.read(spark, n).count() for n in TABLES} == metrics
    assert set(wh.register_views(spark)) == set(TABLES)
    assert spark.table("silver_payments").count() == metrics["silver_payments"]


def test_replacing_catalogs_get_every_partition_and_the_format_version(spark):
    wh = CatalogWarehouse("s3a://lake", fmt="iceberg", catalog="lake")
    assert wh.replaces(spark) and wh.partitions(spark, "fact_payments") == ["full_date", "country"]
    assert wh.properties("dim_date") == {"quality": "gold", "format-version": "2"}
    conf = iceberg_settings("lake", "s3a://lake/warehouse")
    assert conf["spark.sql.catalog.lake.type"] == "hadoop" and conf["spark.sql.catalog.lake.warehouse"] == "s3a://lake/warehouse"
    named = iceberg_settings("lake", "w", implementation="a.Catalog", io="a.IO")
    assert named["spark.sql.catalog.lake.catalog-impl"] == "a.Catalog" and "spark.sql.catalog.lake.type" not in named
    assert wh.table("dim`x") == "`lake`.`payments`.`dim``x`"


def test_a_filtered_calendar_prunes_the_published_fact(spark):
    wh = pipeline.Warehouse(scratch_path(spark, "pruned"))
    layers = from_testdata(spark, SF)
    wh.write(layers.fact, "fact_payments")
    wh.write(dims.dim_date(spark), "dim_date")
    fact, calendar = wh.read(spark, "fact_payments"), wh.read(spark, "dim_date")
    out = marts.fact_on_days(fact, calendar, "day_of_week >= 6")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    days = {r.full_date for r in calendar.where("is_weekend").collect()}
    want = [r for r in layers.fact.collect() if r.full_date in days]
    assert out.count() == len(want) > 0
    assert out.where(~F.col("day_name").isin("Saturday", "Sunday")).isEmpty()


def test_a_query_builds_only_the_layers_it_needs(spark, monkeypatch):
    layers = from_testdata(spark, SF)
    built = lambda: {n for n in vars(layers) if n != "bronze"}
    assert isinstance(layers, Layers) and built() == set()
    layers.rejected  # noqa: B018
    assert built() == {"validated", "rejected"}
    layers.fact  # noqa: B018
    assert built() == {"validated", "rejected", "accepted", "silver", "daily", "fact"}
