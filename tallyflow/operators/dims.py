"""Conformed dimensions: payment status, merchant country, calendar.

All three are bounded by construction (4 rows, 8 rows, one row per day of a
fixed eleven-year range). The row count of each is known from how it is
built, and ``bounded_broadcast`` hints a broadcast only when that count is
under ``BROADCAST_ROW_BOUND``; a larger calendar falls back to a shuffle join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.functions import domain

# Largest dimension we ever broadcast: 2020-01-01..2030-12-31 is 4,018 days.
BROADCAST_ROW_BOUND = 10_000

STATUS_SCHEMA = T.StructType(
    [
        T.StructField("status_code", T.StringType(), True),
        T.StructField("status_name", T.StringType(), True),
        T.StructField("status_description", T.StringType(), True),
        T.StructField("is_revenue", T.BooleanType(), True),
    ]
)

COUNTRY_SCHEMA = T.StructType(
    [
        T.StructField("country_code", T.StringType(), True),
        T.StructField("country_code_alpha3", T.StringType(), True),
        T.StructField("country_name", T.StringType(), True),
        T.StructField("region_name", T.StringType(), True),
        T.StructField("subregion_name", T.StringType(), True),
        T.StructField("is_unknown", T.BooleanType(), True),
    ]
)


def literal_relation(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small literal table built on the JVM side: typed struct literals,
    inlined over a one-row range. Unlike ``createDataFrame`` from a Python
    list (a pickled Python RDD), it needs no Python worker to read and folds
    into the plan as constants. Column names and types follow ``schema``."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dim_status(spark: SparkSession) -> DataFrame:
    """Payment statuses; only captured counts toward GMV."""
    return literal_relation(spark, domain.STATUS_REFERENCE, STATUS_SCHEMA)


def dim_country(spark: SparkSession) -> DataFrame:
    """Merchant countries plus the ``unknown`` member (null alpha-3)."""
    return literal_relation(spark, domain.COUNTRY_REFERENCE, COUNTRY_SCHEMA)


def dim_date(
    spark: SparkSession,
    start: str = domain.CALENDAR_START,
    end: str = domain.CALENDAR_END,
) -> DataFrame:
    """S14 + D1: one row per calendar day, generated (not read)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias(
            "calendar_date"
        )
    )
    d = F.col("calendar_date")
    iso_weekday = F.weekday(d) + 1  # Spark weekday(): Monday=0 .. Sunday=6
    last_of_month = d == F.last_day(d)
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
        F.date_format(d, "yyyy-MM-dd").alias("full_date"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("week_of_year"),  # ISO-8601 week
        F.dayofmonth(d).alias("day_of_month"),
        iso_weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (iso_weekday >= 6).alias("is_weekend"),
        last_of_month.alias("is_month_end"),
        (last_of_month & (F.month(d) % 3 == 0)).alias("is_quarter_end"),
        ((F.month(d) == 12) & (F.dayofmonth(d) == 31)).alias("is_year_end"),
    )


def calendar_days(start: str = domain.CALENDAR_START, end: str = domain.CALENDAR_END) -> int:
    """Exact row count of ``dim_date(start, end)``."""
    return (date.fromisoformat(end) - date.fromisoformat(start)).days + 1


def bounded_broadcast(dim: DataFrame, rows: int, bound: int = BROADCAST_ROW_BOUND) -> DataFrame:
    """Broadcast hint only for a side whose row count is known and bounded;
    otherwise leave the choice to the planner/AQE (shuffle join beyond it)."""
    return F.broadcast(dim) if rows <= bound else dim


def status_for_join(spark: SparkSession) -> DataFrame:
    return bounded_broadcast(dim_status(spark), len(domain.STATUS_REFERENCE))


def country_for_join(spark: SparkSession) -> DataFrame:
    return bounded_broadcast(dim_country(spark), len(domain.COUNTRY_REFERENCE))


def date_for_join(
    spark: SparkSession,
    start: str = domain.CALENDAR_START,
    end: str = domain.CALENDAR_END,
) -> DataFrame:
    return bounded_broadcast(dim_date(spark, start, end), calendar_days(start, end))
