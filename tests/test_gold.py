"""Gold daily fact: grouping, currency separation, conservation."""

from decimal import Decimal

from helpers import bronze, row
from tallyflow.operators import gold, silver


def _gold(spark, rows):
    s = silver.silver_payments(bronze(spark, rows))
    d = gold.daily(s)
    return s, gold.fact_payments(d), gold.fact_payments_rejected(d)


def test_six_row_gold_case(spark):
    rows = [
        row(event_id="e1", amount="10.10", status="captured", currency="USD"),
        row(event_id="e2", amount="20.20", status=" CAPTURED ", currency=" usd "),
        row(event_id="e3", amount="100.00", currency="BRL"),
        row(event_id="e4", amount="5.50", status="failed"),
        row(event_id="e5", amount="1.00", status="authorized"),
        row(event_id="e6", amount="2.00", status="refunded"),
    ]
    s, fact, failed = _gold(spark, rows)
    by_key = {(r.status, r.currency): r for r in fact.collect()}
    usd = by_key[("captured", "USD")]
    assert usd.amount == Decimal("30.30") and usd.txn_count == 2 and usd.unique_users == 1
    assert by_key[("captured", "BRL")].amount == Decimal("100.00")
    assert ("failed", "USD") not in by_key
    (f,) = failed.collect()
    assert f.amount == Decimal("5.50") and f.status == "failed"
    total = sum(r.txn_count for r in fact.collect()) + f.txn_count
    assert total == s.count() == 6


def test_country_default_and_bands(spark):
    rows = [
        row(event_id="a", country=None, amount="99.99"),
        row(event_id="b", country="", amount="150.00"),
        row(event_id="c", country="US", amount="999.99"),
        row(event_id="d", country="DE", amount="1000.00"),
    ]
    _, fact, _ = _gold(spark, rows)
    got = {r.country: (r.amount_band, r.full_date) for r in fact.collect()}
    assert got == {
        "unknown": ("micro", "2026-10-09"),
        "": ("small", "2026-10-09"),
        "US": ("medium", "2026-10-09"),
        "DE": ("large", "2026-10-09"),
    }


def test_fact_columns(spark):
    _, fact, _ = _gold(spark, [row()])
    assert tuple(fact.columns) == gold.FACT_COLUMNS
    types = dict(fact.dtypes)
    assert types["txn_count"] == "bigint" and types["unique_users"] == "bigint"
    assert types["amount"].startswith("decimal(")
