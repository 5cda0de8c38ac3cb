"""The published tables: stored column order and types, partitions, comments, properties.

One declaration per table, used on every write and on every read, so a second
process sees the same types and order as the one that wrote.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_FACT = """full_date string, year string, month string, day string, merchant_id string, status string,
 country string, currency string, amount decimal(28,2), txn_count bigint, unique_users bigint, amount_band string"""


@dataclass(frozen=True)
class Table:
    ddl: str
    partitions: tuple[str, ...] = ()
    #: partitions whose values may be blank, and so are encoded in folder names
    coded: tuple[str, ...] = ()
    comment: str = ""
    properties: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


# --- fixed values: stored columns and partitions of the published tables -------
TABLES: dict[str, Table] = {
    "bronze_payments": Table(
        """event_id string, merchant_id string, user_id string, amount_usd double, currency string, status string,
 event_timestamp string, source_file string, country string, amount string""",
        comment="Every payment event as it arrived, never changed afterwards",
        properties={"quality": "bronze"},
    ),
    "silver_payments": Table(
        """event_id string, merchant_id string, user_id string, amount decimal(18,2), currency string, status string,
 event_timestamp string, source_file string, amount_decimal decimal(18,2), status_normalized string,
 currency_normalized string, event_timestamp_utc timestamp, rejection_reasons array<string>, amount_band string,
 year string, month string, day string, country string""",
        ("year", "month", "day"),
        comment="One valid, typed row for each event of a merchant",
        properties={"quality": "silver"},
    ),
    "silver_payments_rejected": Table(
        """event_id string, merchant_id string, user_id string, amount_usd double, currency string, status string,
 event_timestamp string, source_file string, country string, amount string, _amount_input string,
 amount_decimal decimal(18,2), status_normalized string, currency_normalized string,
 event_timestamp_utc timestamp, rejection_reasons array<string>, year string, month string, day string""",
        ("year", "month", "day"),
        comment="Quarantine: events that broke a rule, with all broken rules",
        properties={"quality": "silver"},
    ),
    "fact_payments": Table(
        _FACT, ("full_date", "country"), ("country",), "Payments of a day by merchant, status, country and currency", {"quality": "gold"}
    ),
    "fact_payments_rejected": Table(
        _FACT, ("full_date", "country"), ("country",), "The same daily grain for failed payments alone", {"quality": "gold"}
    ),
    "dim_status": Table(
        "status_code string, status_name string, status_description string, is_revenue boolean",
        comment="What each payment status means and whether it counts as revenue",
        properties={"quality": "gold"},
    ),
    "dim_country": Table(
        """country_code string, country_code_alpha3 string, country_name string, region_name string,
 subregion_name string, is_unknown boolean""",
        comment="Countries of merchants with their regions",
        properties={"quality": "gold"},
    ),
    "dim_date": Table(
        """date_key int, full_date string, calendar_date date, year int, quarter int, month int, month_name string,
 year_month string, week_of_year int, day_of_month int, day_of_week int, day_name string, is_weekend boolean,
 is_month_end boolean, is_quarter_end boolean, is_year_end boolean""",
        comment="One row for each calendar day with its attributes",
        properties={"quality": "gold"},
    ),
}
