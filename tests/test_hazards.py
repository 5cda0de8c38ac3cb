"""Decided hazards pinned as tests."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from helpers import BRONZE_STRING_SCHEMA, bronze, row
from tallyflow.operators import silver


def _reasons(spark, **changes):
    (r,) = silver.with_reasons(bronze(spark, [row(**changes)])).collect()
    return r


def test_h3_trim_strips_spaces_only(spark):
    # " \t " trims to "\t": status is then blank (missing), not invalid
    assert _reasons(spark, status=" \t ").rejection_reasons == ["missing_status"]
    # a no-break space is not whitespace for the blank test
    assert _reasons(spark, user_id="\u00a0").rejection_reasons == []


@pytest.mark.parametrize("text,ok", [
    ("2026", True), ("2026-10", True), ("2026-10-09 12:00:00", True),
    ("now", False), ("epoch", False), ("2026-10-09T24:00:00Z", False),
])
def test_h4_timestamp_forms(spark, text, ok):
    r = _reasons(spark, event_timestamp=text)
    assert (r.event_timestamp_utc is not None) == ok
    assert (r.rejection_reasons == []) == ok


def test_h4_zoneless_time_is_utc(spark):
    r = _reasons(spark, event_timestamp="2026-10-09 23:30:00")
    assert (r.year, r.month, r.day) == ("2026", "10", "09")


def test_h15_legacy_double_in_exponent_form(spark):
    schema = T.StructType(
        [T.StructField(f.name, T.DoubleType() if f.name == "amount_usd" else T.StringType())
         for f in BRONZE_STRING_SCHEMA.fields]
    )
    (r,) = silver.silver_payments(bronze(spark, [row(amount=None, amount_usd=1.0e7)], schema)).collect()
    assert r.amount == Decimal("10000000.00")


def test_h5_round_then_test_positivity(spark):
    assert _reasons(spark, amount="0.004").rejection_reasons == ["amount_decimal_non_positive"]
    assert _reasons(spark, amount="0.005").rejection_reasons == []


def test_h10_dedup_key_is_untrimmed(spark):
    out = silver.silver_payments(bronze(spark, [row(event_id="e1"), row(event_id="e1 ")]))
    assert out.count() == 2
