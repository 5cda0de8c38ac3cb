"""Properties over generated bronze rows (hypothesis)."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import bronze
from tallyflow.operators import gold, silver

text = st.one_of(st.none(), st.sampled_from(["", " ", "x", "evt-1", "evt-2"]))
amounts = st.one_of(st.none(), st.sampled_from(["1.00", "0", "-3", "banana", "99.999", "250.50", "1e3"]))
statuses = st.one_of(st.none(), st.sampled_from(["captured", " FAILED ", "refunded", "banana", ""]))
currencies = st.one_of(st.none(), st.sampled_from(["usd", " EUR ", "XYZ", ""]))
times = st.one_of(st.none(), st.sampled_from(
    ["2026-01-01T00:00:00Z", "2026-01-01T05:00:00+03:00", "banana", "2026-01-02T10:00:00Z"]))

rows_strategy = st.lists(
    st.fixed_dictionaries({
        "event_id": text, "merchant_id": st.sampled_from(["m1", "m2", None]),
        "user_id": st.sampled_from(["u1", "u2", " "]), "amount": amounts,
        "amount_usd": st.one_of(st.none(), st.just("12.34")), "currency": currencies,
        "status": statuses, "event_timestamp": times,
        "source_file": st.sampled_from(["f1", "f2", None]), "country": st.sampled_from(["BR", None, ""]),
    }),
    min_size=1, max_size=25,
)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows_strategy)
def test_each_row_in_exactly_one_of_accepted_rejected(spark, rows):
    v = silver.with_reasons(bronze(spark, rows))
    assert silver.accepted(v).count() + silver.rejected(v).count() == len(rows)


@SETTINGS
@given(rows_strategy, st.integers(0, 1000))
def test_dedup_is_order_independent(spark, rows, seed):
    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    a = silver.silver_payments(bronze(spark, rows)).withColumn("r", F.array_join("rejection_reasons", ","))
    b = silver.silver_payments(bronze(spark, shuffled)).withColumn("r", F.array_join("rejection_reasons", ","))
    cols = [c for c in a.columns if c != "rejection_reasons"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


@SETTINGS
@given(rows_strategy)
def test_gold_conserves_silver_rows(spark, rows):
    s = silver.silver_payments(bronze(spark, rows))
    d = gold.daily(s)
    total = (gold.all_payments(gold.fact_payments(d), gold.fact_payments_rejected(d))
             .agg(F.coalesce(F.sum("txn_count"), F.lit(0))).first()[0])
    assert total == s.count()
