"""The medallion graph as a Spark Declarative Pipeline.

A transformation file for the ``spark-pipelines`` CLI only needs::

    from pyspark.sql import SparkSession
    from tallyflow.plans.declarative import declare

    declare(SparkSession.active(), raw_root="s3a://landing/payments/raw")

Datasets (names, kinds and partition columns as the published tables):

* ``bronze_payments``        streaming table fed by one append flow (S1, S5)
* ``silver_payments_temp``   temporary view: typed rows + reasons (S10)
* ``silver_payments_rejected``, ``silver_payments``  materialized views by event day
* ``fact_payments_temp``     temporary view: the daily grain
* ``fact_payments``, ``fact_payments_rejected``      materialized views by day and country
* ``dim_status``, ``dim_country``, ``dim_date``       materialized views

Every query function reads its inputs by name (``spark.table``), which is what
creates the graph edges (S11); schemas are ``StructType`` objects, never DDL
strings, because query functions may not trigger analysis.
"""

from __future__ import annotations

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession

from tallyflow.operators import dims, gold, silver
from tallyflow.plans.pipeline import TABLE_COMMENTS, TABLE_PARTITIONS
from tallyflow.sources.tables import TABLES
from tallyflow.streaming import bronze as bronze_streaming


def _parts(name: str) -> list[str] | None:
    cols = TABLE_PARTITIONS[name]
    return list(cols) if cols else None


def _props(name: str) -> dict[str, str]:
    return dict(TABLES[name].properties)


def declare(
    spark: SparkSession,
    raw_root: str,
    definition=None,
    fmt: str | None = None,
) -> None:
    """Register every dataset and flow of the graph in the active pipeline."""

    dp.create_streaming_table(
        "bronze_payments",
        comment=TABLE_COMMENTS["bronze_payments"],
        table_properties=_props("bronze_payments"),
        schema=TABLES["bronze_payments"].schema,
        format=fmt,
    )

    @dp.append_flow(target="bronze_payments", name="ingest_bronze")
    def ingest_bronze() -> DataFrame:
        return bronze_streaming.bronze_stream(spark, raw_root, definition)

    @dp.temporary_view(name="silver_payments_temp", comment="Typed payments with reasons")
    def silver_payments_temp() -> DataFrame:
        return silver.with_reasons(spark.table("bronze_payments"))

    @dp.materialized_view(
        name="silver_payments_rejected",
        comment=TABLE_COMMENTS["silver_payments_rejected"],
        table_properties=_props("silver_payments_rejected"),
        partition_cols=_parts("silver_payments_rejected"),
        format=fmt,
    )
    def silver_payments_rejected() -> DataFrame:
        return silver.rejected(spark.table("silver_payments_temp"))

    @dp.materialized_view(
        name="silver_payments",
        comment=TABLE_COMMENTS["silver_payments"],
        table_properties=_props("silver_payments"),
        partition_cols=_parts("silver_payments"),
        format=fmt,
    )
    def silver_payments() -> DataFrame:
        validated = spark.table("silver_payments_temp")
        return silver.project_silver(silver.dedup(silver.accepted(validated)))

    @dp.temporary_view(name="fact_payments_temp", comment="Daily payments grain")
    def fact_payments_temp() -> DataFrame:
        return gold.daily(spark.table("silver_payments"))

    @dp.materialized_view(
        name="fact_payments",
        comment=TABLE_COMMENTS["fact_payments"],
        table_properties=_props("fact_payments"),
        partition_cols=_parts("fact_payments"),
        format=fmt,
    )
    def fact_payments() -> DataFrame:
        return gold.fact_payments(spark.table("fact_payments_temp"))

    @dp.materialized_view(
        name="fact_payments_rejected",
        comment=TABLE_COMMENTS["fact_payments_rejected"],
        table_properties=_props("fact_payments_rejected"),
        partition_cols=_parts("fact_payments_rejected"),
        format=fmt,
    )
    def fact_payments_rejected() -> DataFrame:
        return gold.fact_payments_rejected(spark.table("fact_payments_temp"))

    @dp.materialized_view(
        name="dim_status", comment=TABLE_COMMENTS["dim_status"], table_properties=_props("dim_status"), format=fmt
    )
    def dim_status() -> DataFrame:
        return dims.dim_status(spark)

    @dp.materialized_view(
        name="dim_country", comment=TABLE_COMMENTS["dim_country"], table_properties=_props("dim_country"), format=fmt
    )
    def dim_country() -> DataFrame:
        return dims.dim_country(spark)

    @dp.materialized_view(
        name="dim_date", comment=TABLE_COMMENTS["dim_date"], table_properties=_props("dim_date"), format=fmt
    )
    def dim_date() -> DataFrame:
        return dims.dim_date(spark)
