"""Analyst questions over gold and silver, one function per question.

Each takes already-built DataFrames (published tables or lazily derived
ones), so Catalyst sees one plan: filters on grain columns reach the gold
scan (and partition pruning when gold is read from its ``full_date, country``
partitioned files). Dimensions enter through ``bounded_broadcast``, so fact
rows never shuffle for a dimension join. ``full_date`` is optional: ``None``
answers for every day, a value slices one day as the analyst SQL does.
Sorting is presentation only and off by default in composed plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.functions import domain
from tallyflow.operators import dims, gold


def _on_day(df: DataFrame, full_date: str | None) -> DataFrame:
    return df if full_date is None else df.where(F.col("full_date") == full_date)


def _ratio(num, den):
    """P20: null-safe double ratio (``x / NULLIF(n, 0)``)."""
    return F.col(num).cast("double") / F.nullif(F.col(den), F.lit(0)).cast("double")


def top_merchants_gmv(
    fact: DataFrame, full_date: str | None = None, ordered: bool = False
) -> DataFrame:
    """A3: captured GMV, count and average payment per merchant, day, currency."""
    out = (
        _on_day(fact, full_date)
        .where(F.col("status") == domain.CAPTURED_STATUS)
        .groupBy("merchant_id", "full_date", "currency")
        .agg(
            F.sum("amount").alias("gmv"),
            F.sum("txn_count").alias("captured_count"),
        )
        .withColumn("average_payment_amount", _ratio("gmv", "captured_count"))
    )
    return out.orderBy("currency", F.col("gmv").desc()) if ordered else out


def failure_rate(
    fact: DataFrame,
    fact_rejected: DataFrame | None,
    full_date: str | None = None,
    min_events: int = 5,
    ordered: bool = False,
) -> DataFrame:
    """A2 + A4: failed share of all payments per merchant, day, currency, for
    groups with at least ``min_events`` events. Reads both facts (O3), or ``fact``
    alone if it holds all payments already (``fact_rejected`` is None)."""
    failed = F.when(F.col("status") == domain.FAILED_STATUS, F.col("txn_count"))
    out = (
        _on_day(fact if fact_rejected is None else gold.all_payments(fact, fact_rejected), full_date)
        .groupBy("merchant_id", "full_date", "currency")
        .agg(
            F.sum("txn_count").alias("event_count"),
            F.sum(failed.otherwise(F.lit(0))).alias("failed_count"),
        )
        .where(F.col("event_count") >= min_events)
        .withColumn(
            "failure_rate",
            F.col("failed_count").cast("double") / F.col("event_count").cast("double"),
        )
    )
    return out.orderBy(F.col("failure_rate").desc()) if ordered else out


def captured_by_country(
    spark: SparkSession,
    fact: DataFrame,
    full_date: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """A5 with J1 + J2: captured GMV by day, merchant-country name, currency.
    Left joins keep unmapped country codes (null name)."""
    country = dims.country_for_join(spark)
    status = dims.status_for_join(spark)
    f = _on_day(fact, full_date).where(F.col("status") == domain.CAPTURED_STATUS)
    out = (
        f.join(country, f["country"] == country["country_code"], "left")
        .join(status, f["status"] == status["status_code"], "left")
        .groupBy(f["full_date"], country["country_name"], f["currency"])
        .agg(
            F.sum(f["amount"]).alias("gmv"),
            F.sum(f["txn_count"]).alias("captured_count"),
        )
    )
    return out.orderBy("currency", F.col("gmv").desc()) if ordered else out


def distinct_captured_users(
    silver: DataFrame,
    day: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Exact distinct captured users per day and currency, from silver
    (gold ``unique_users`` are not additive across groups)."""
    s = silver.where(F.col("status_normalized") == domain.CAPTURED_STATUS)
    if day is not None:
        y, m, d = day
        s = s.where((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))
    return s.groupBy(
        "year", "month", "day", F.col("currency_normalized").alias("currency")
    ).agg(F.count_distinct("user_id").alias("unique_users"))


def rejection_counts(rejected: DataFrame, ordered: bool = False) -> DataFrame:
    """A7 + J5: rows per rejection reason; a row counts once per reason.
    No date filter: rows with an unparseable time have null day partitions."""
    out = (
        rejected.select(F.explode("rejection_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )
    return out.orderBy(F.col("rejected_rows").desc(), "reason") if ordered else out


def gmv_by_revenue_status(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """A8 + J3: daily GMV per currency through the ``is_revenue`` flag."""
    status = dims.status_for_join(spark)
    return (
        fact.join(status, fact["status"] == status["status_code"], "inner")
        .where(status["is_revenue"])
        .groupBy(fact["full_date"], fact["currency"])
        .agg(
            F.sum(fact["amount"]).alias("gmv"),
            F.sum(fact["txn_count"]).alias("captured_count"),
        )
    )


def fact_with_calendar(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """Fact rows with every calendar attribute of their ``full_date``
    (the calendar's int ``year``/``month`` renamed beside the fact's text ones)."""
    cal = (
        dims.date_for_join(spark)
        .withColumnRenamed("year", "calendar_year")
        .withColumnRenamed("month", "calendar_month")
    )
    return facts.join(cal, "full_date", "left")


def fact_on_days(facts: DataFrame, calendar: DataFrame, days: Column | str) -> DataFrame:
    """J4 + P19: the fact rows of those calendar days for which ``days`` holds, with the
    days' names. Over a published fact, whose folders are days, the filtered calendar
    decides at run time which folders are read at all (dynamic partition pruning): it is
    a few thousand rows at most, broadcast for the join, and used again for the scan."""
    chosen = calendar.where(days).select("full_date", "day_name", "is_month_end")
    return facts.join(F.broadcast(chosen), "full_date")


def fact_with_country(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """J1 as a star join: fact rows with every merchant-country attribute;
    a left join, so unmapped codes keep null attributes."""
    country = dims.country_for_join(spark)
    return facts.join(country, facts["country"] == country["country_code"], "left")


def fact_with_status(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """J2 as a star join: fact rows with every payment-status attribute."""
    status = dims.status_for_join(spark)
    return facts.join(status, facts["status"] == status["status_code"], "left")


def dimension_usage(dim: DataFrame, facts: DataFrame, dim_key: str, fact_key: str) -> DataFrame:
    """S12/S13/D1 checked against the data: every dimension row with all its
    attributes and ``fact_rows``, the number of fact rows that reference it
    (0 when none). The facts are pre-aggregated per key before the join, so
    only one row per key (bounded by the dimension) meets the dimension."""
    used = facts.groupBy(F.col(fact_key).alias("_key")).agg(F.count(F.lit(1)).alias("fact_rows"))
    joined = dim.join(used, dim[dim_key] == used["_key"], "left")
    return joined.select(
        *[dim[c] for c in dim.columns],
        F.coalesce(F.col("fact_rows"), F.lit(0)).alias("fact_rows"),
    )
