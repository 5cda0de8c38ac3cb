"""Gold: the daily payments fact and its failed/not-failed split.

Plan shape: one aggregate with a single ``count(distinct user_id)``. Spark
plans it without ``Expand`` as two hash aggregates: partial on
``grain + user_id`` -> exchange on ``grain + user_id`` -> merge -> partial on
``grain`` -> exchange on ``grain`` -> final. The first exchange spreads a hot
merchant-day over its users, the second carries one pre-aggregated row per
grain and map task, so neither a hot merchant nor a hot day lands whole in one
task. No sort is written into the view (a sort inside a reused view would keep
a range exchange and global sort in every consumer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import columns as C
from tallyflow.functions import domain

# --- fixed values: stored fact columns, in order ------------------------------
FACT_COLUMNS = (
    "full_date",
    "year",
    "month",
    "day",
    "merchant_id",
    "status",
    "country",
    "currency",
    "amount",
    "txn_count",
    "unique_users",
    "amount_band",
)


def daily(silver: DataFrame) -> DataFrame:
    """A1 + P14-P16: group by event day, merchant, status, country, currency."""
    grain = silver.select(
        "year",
        "month",
        "day",
        "merchant_id",
        F.col("status_normalized").alias("status"),
        F.coalesce(F.col("country"), F.lit(domain.UNKNOWN_COUNTRY)).alias("country"),
        F.col("currency_normalized").alias("currency"),
        "amount_decimal",
        "user_id",
    )
    agg = grain.groupBy(
        "year", "month", "day", "merchant_id", "status", "country", "currency"
    ).agg(
        F.sum("amount_decimal").alias("amount"),
        F.count(F.lit(1)).alias("txn_count"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    return agg.select(
        C.full_date().alias("full_date"),
        "year",
        "month",
        "day",
        "merchant_id",
        "status",
        "country",
        "currency",
        "amount",
        "txn_count",
        "unique_users",
        C.daily_band("amount").alias("amount_band"),
    )


def fact_payments(daily_fact: DataFrame) -> DataFrame:
    """Every status except failed (authorized, captured, refunded)."""
    return daily_fact.where(F.col("status") != domain.FAILED_STATUS)


def fact_payments_rejected(daily_fact: DataFrame) -> DataFrame:
    """Failed payments only (a business outcome, not bad data)."""
    return daily_fact.where(F.col("status") == domain.FAILED_STATUS)


def all_payments(fact: DataFrame, fact_rejected: DataFrame) -> DataFrame:
    """O3: ``UNION ALL`` of both facts (no dedup, no shuffle)."""
    return fact.unionByName(fact_rejected)
