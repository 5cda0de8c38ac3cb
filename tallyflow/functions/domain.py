"""Fixed values of the payments contract.

Everything in this module is a value that must equal the upstream contract for
results to match (domains, rule names and order, band edges, reference
dimensions, calendar range). They are stated once, plainly, in natural order.
"""

from __future__ import annotations

# --- fixed values: accepted domains -------------------------------------------
VALID_STATUSES = ("authorized", "captured", "failed", "refunded")
VALID_CURRENCIES = ("USD", "EUR", "BRL", "GBP", "JPY", "CAD", "MXN")
DEFAULT_CURRENCY = "USD"
FAILED_STATUS = "failed"
CAPTURED_STATUS = "captured"
UNKNOWN_COUNTRY = "unknown"

# --- fixed values: amount bands (upper bounds are exclusive) ------------------
EVENT_BANDS = ((10, "micro"), (50, "small"), (100, "medium"))
EVENT_BAND_TOP = "large"
DAILY_BANDS = ((100, "micro"), (250, "small"), (1000, "medium"))
DAILY_BAND_TOP = "large"

# --- fixed values: money type --------------------------------------------------
AMOUNT_TYPE = "decimal(18,2)"

# --- fixed values: payment status dimension ----------------------------------
# (status_code, status_name, status_description, is_revenue)
STATUS_REFERENCE = (
    ("authorized", "Authorized", "Payment authorized; excluded from GMV.", False),
    ("captured", "Captured", "Payment captured; included in GMV.", True),
    ("failed", "Failed", "Payment failed; excluded from GMV.", False),
    ("refunded", "Refunded", "Payment refunded; excluded from GMV.", False),
)

# --- fixed values: merchant country dimension (UN M49 names) ------------------
# (country_code, country_code_alpha3, country_name, region_name,
#  subregion_name, is_unknown)
COUNTRY_REFERENCE = (
    ("BR", "BRA", "Brazil", "Americas", "Latin America and the Caribbean", False),
    ("CA", "CAN", "Canada", "Americas", "Northern America", False),
    ("DE", "DEU", "Germany", "Europe", "Western Europe", False),
    (
        "GB",
        "GBR",
        "United Kingdom of Great Britain and Northern Ireland",
        "Europe",
        "Northern Europe",
        False,
    ),
    ("JP", "JPN", "Japan", "Asia", "Eastern Asia", False),
    ("MX", "MEX", "Mexico", "Americas", "Latin America and the Caribbean", False),
    ("US", "USA", "United States of America", "Americas", "Northern America", False),
    ("unknown", None, "Unknown", "Unknown", "Unknown", True),
)

# --- fixed values: calendar dimension range ----------------------------------
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

# --- fixed values: outbound producer contract --------------------------------
CONTRACT_SCHEMA_VERSION = 3
CONTRACT_INGEST_SOURCE = "payment_gateway"
CONTRACT_AMOUNT_WHOLE_DIGITS = 16  # 18 digits in total
CONTRACT_AMOUNT_PLACES = 2  # after the point
MAX_RECORD_BYTES = 1024 * 1024  # one record, newline included
