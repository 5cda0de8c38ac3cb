"""Silver: typed payment events, a quarantine with every reason, and one
deterministic row per ``(event_id, merchant_id)``.

Plan shape: ``typed``/``with_reasons`` are narrow projections (no shuffle, one
codegen stage over the bronze scan). ``dedup`` is the only exchange, hashed on
the dedup key. Because the filter ``row_number() = 1`` sits directly over the
window, Catalyst inserts a partial ``WindowGroupLimit`` before the exchange:
every map task keeps at most one row per key, so a replayed key that holds a
third of all rows still reaches the reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyflow.functions import columns as C
from tallyflow.functions import domain

# --- fixed values: dedup key, tie-break payload fields (in order), stored silver columns
DEDUP_KEY = ("event_id", "merchant_id")

TIE_BREAK_FIELDS = (
    "user_id",
    "amount_decimal",
    "currency_normalized",
    "status_normalized",
    "currency",
    "status",
    "country",
    "event_timestamp",
)

SILVER_COLUMNS = (
    "event_id",
    "merchant_id",
    "user_id",
    "amount",
    "currency",
    "status",
    "event_timestamp",
    "source_file",
    "amount_decimal",
    "status_normalized",
    "currency_normalized",
    "event_timestamp_utc",
    "rejection_reasons",
    "amount_band",
    "year",
    "month",
    "day",
    "country",
)


def typed(bronze: DataFrame) -> DataFrame:
    """Keep every bronze column and add the typed/normalised ones."""
    with_input = bronze.select("*", C.amount_input().alias("_amount_input"))
    return with_input.select(
        "*",
        C.safe_amount("_amount_input").alias("amount_decimal"),
        C.normalized_status("status").alias("status_normalized"),
        C.normalized_currency("currency").alias("currency_normalized"),
        C.event_time_utc("event_timestamp").alias("event_timestamp_utc"),
    )


def silver_rules() -> list[tuple[str, Column]]:
    """The eleven quality rules in reporting order (names and order are fixed values)."""
    amt_in, amt = F.col("_amount_input"), F.col("amount_decimal")
    status = F.col("status_normalized")
    no_status, no_time = C.missing_text(status), C.missing_text("event_timestamp")
    return [
        ("missing_event_id", C.missing_text("event_id")),
        ("missing_merchant_id", C.missing_text("merchant_id")),
        ("missing_user_id", C.missing_text("user_id")),
        ("missing_amount", amt_in.isNull()),
        ("invalid_amount", amt_in.isNotNull() & amt.isNull()),
        ("amount_decimal_non_positive", amt <= 0),
        ("missing_status", no_status),
        ("invalid_status", ~no_status & ~status.isin(*domain.VALID_STATUSES)),
        ("invalid_currency", ~F.col("currency_normalized").isin(*domain.VALID_CURRENCIES)),
        ("missing_event_timestamp", no_time),
        ("invalid_event_timestamp", ~no_time & F.col("event_timestamp_utc").isNull()),
    ]


def with_reasons(bronze: DataFrame, quality: Observation | None = None) -> DataFrame:
    """P9 + P6: typed rows with ``rejection_reasons`` and event-day parts.
    This is the shared (temporary) view under both silver tables.

    The view carries a data-quality observation (rows in, rows rejected,
    gathered by whichever action runs first, no extra job). It also keeps
    the ``accepted``/``rejected`` filters above the projection: without it
    Catalyst pushes ``size(rejection_reasons)`` below the projections with
    every alias inlined, and each rule (regexes, timestamp parse, decimal
    cast) would be evaluated twice per row."""
    t = typed(bronze)
    validated = t.select(
        "*",
        C.reasons(silver_rules()).alias("rejection_reasons"),
        *C.date_parts("event_timestamp_utc"),
    )
    return validated.observe(
        quality if quality is not None else Observation(),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("rejection_reasons") > 0).alias("rejected"),
    )


def rejected(validated: DataFrame) -> DataFrame:
    """P10: quarantine, rows with at least one reason; raw columns kept, not deduplicated."""
    return validated.filter(F.size("rejection_reasons") > 0)


def accepted(validated: DataFrame) -> DataFrame:
    """Valid rows before dedup, with the per-event band."""
    return validated.filter(F.size("rejection_reasons") == 0).withColumn(
        "amount_band", C.event_band("amount_decimal")
    )


def dedup(rows: DataFrame) -> DataFrame:
    """Keep one row per (event_id, merchant_id): latest event time, then
    greatest canonical JSON payload, then greatest non-null source file."""
    payload = F.to_json(F.struct(*TIE_BREAK_FIELDS))
    w = Window.partitionBy(*DEDUP_KEY).orderBy(
        F.col("event_timestamp_utc").desc(),
        payload.desc(),
        F.col("source_file").desc_nulls_last(),
    )
    return (
        rows.withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def project_silver(rows: DataFrame) -> DataFrame:
    """The stored 18-column silver projection."""
    out = [F.col("amount_decimal").alias("amount") if c == "amount" else F.col(c)
           for c in SILVER_COLUMNS]
    return rows.select(*out)


def silver_payments(bronze: DataFrame) -> DataFrame:
    """Accepted, deduplicated silver table."""
    return project_silver(dedup(accepted(with_reasons(bronze))))


def silver_payments_rejected(bronze: DataFrame) -> DataFrame:
    """Quarantine table: every column of the validated view."""
    return rejected(with_reasons(bronze))
