"""Published tables: lossless partitions, safe replacement, declared types."""

import pytest
from pyspark.sql import functions as F

from tallyflow.operators import gold, silver
from tallyflow.plans import pipeline
from tallyflow.plans.layers import from_testdata
from tallyflow.session import scratch_path, sized_for
from tallyflow.sources import publish
from tallyflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_declared_schemas_are_those_of_the_layers(spark):
    layers = from_testdata(spark, SF)
    frames = {"bronze_payments": layers.bronze, "silver_payments": layers.silver, "silver_payments_rejected": layers.rejected,
              "fact_payments": layers.fact, "fact_payments_rejected": layers.fact_rejected}
    for name, df in frames.items():
        assert df.schema.simpleString() == TABLES[name].schema.simpleString()
    assert TABLES["silver_payments"].schema.fieldNames() == list(silver.SILVER_COLUMNS)
    assert TABLES["fact_payments"].schema.fieldNames() == list(gold.FACT_COLUMNS)


def test_odd_partition_values_come_back(spark):
    path = scratch_path(spark, "odd")
    values = ["", "=", "=x", "FR", "a/b", "a b ", publish.NULL_FOLDER, None, "%20"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "country string, n int")
    publish.publish(df, path, "odd", ("country",), ("country",))
    back = publish.read_published(spark, path, df.schema, ("country",))
    assert back.columns == ["country", "n"]
    assert {r.n: r.country for r in back.collect()} == dict(enumerate(values))
    assert back.where("country = ''").collect()[0].n == 0
    assert "PartitionFilters: [" in back.where("country = 'FR'")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_rows_that_left_the_result_go_and_a_failed_write_changes_nothing(spark, mode):
    path = scratch_path(spark, "replace")
    two = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, n int")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        publish.publish(two, path, "t", ("day",))
        publish.publish(two.where("day = 'd2'"), path, "t", ("day",))
        read = lambda: publish.read_published(spark, path, two.schema).collect()
        assert [tuple(r) for r in read()] == [("d2", 2)]
        with pytest.raises(Exception):  # noqa: B017
            publish.publish(two.withColumn("n", F.raise_error(F.lit("stop")).cast("int")), path, "t", ("day",))
        assert [tuple(r) for r in read()] == [("d2", 2)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_second_process_reads_types_order_and_blank_countries(spark):
    root = scratch_path(spark, "second")
    bronze = from_testdata(spark, SF).bronze
    pipeline.publish_all(spark, bronze, pipeline.Warehouse(root), "r")
    wh = pipeline.Warehouse(root)
    layers = from_testdata(spark, SF)
    for name, df in (("silver_payments", layers.silver), ("silver_payments_rejected", layers.rejected), ("fact_payments", layers.fact)):
        back = wh.read(spark, name)
        assert back.columns == df.columns and back.schema.simpleString() == df.schema.simpleString()
        assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert wh.read(spark, "silver_payments").where("country = ''").count() > 0


def test_sizing_follows_the_input_and_comes_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_for(spark, 10 * 1024**4):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 5120
    with sized_for(spark, 1000):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_layers_follow_the_folder(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder = f"{tmp_path}/sf/events.parquet"
    events.limit(50).write.parquet(folder)
    first = from_testdata(spark, f"{tmp_path}/sf").bronze.count()
    events.limit(30).write.mode("append").parquet(folder)
    assert from_testdata(spark, f"{tmp_path}/sf").bronze.count() > first
