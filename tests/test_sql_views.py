"""Analyst SQL runs unchanged over the published tables registered as views."""

from tallyflow.operators import marts
from tallyflow.plans import pipeline
from tallyflow.session import scratch_path
from tallyflow.sources import fixture

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_analyst_sql_over_views(spark):
    root = scratch_path(spark, "views")
    pipeline.publish_all(spark, fixture.bronze_from_dir(spark, SF), pipeline.Warehouse(root), "fixture")
    names = pipeline.Warehouse(root).register_views(spark)  # as a second process would
    assert set(names) == set(pipeline.TABLE_PARTITIONS)
    fact, failed = spark.table("fact_payments"), spark.table("fact_payments_rejected")

    top = spark.sql("""
        SELECT *, try_divide(double(gmv), captured_count) AS average_payment_amount
        FROM (FROM fact_payments |> WHERE status = 'captured'
              |> AGGREGATE sum(amount) AS gmv, sum(txn_count) AS captured_count GROUP BY merchant_id, full_date, currency)""")
    assert _rows(top) == _rows(marts.top_merchants_gmv(fact))

    rate = spark.sql("""
        SELECT merchant_id, full_date, currency, n AS event_count, bad AS failed_count, double(bad) / double(n) AS failure_rate
        FROM (SELECT merchant_id, full_date, currency, sum(n) AS n, sum(bad) AS bad FROM (
                SELECT merchant_id, full_date, currency, txn_count AS n, 0L AS bad FROM fact_payments
                UNION ALL SELECT merchant_id, full_date, currency, txn_count, txn_count FROM fact_payments_rejected)
              GROUP BY ALL) WHERE n > 1""")
    assert _rows(rate) == _rows(marts.failure_rate(fact, failed, min_events=2))

    by_country = spark.sql("""
        WITH names AS (SELECT country_code AS country, country_name FROM dim_country)
        SELECT full_date, country_name, currency, sum(amount) AS gmv, sum(txn_count) AS n
        FROM fact_payments LEFT JOIN names USING (country) WHERE status = 'captured' GROUP BY ALL""")
    assert _rows(by_country) == _rows(marts.captured_by_country(spark, fact))

    users = spark.sql("""
        SELECT year, month, day, currency_normalized, count(*) AS unique_users
        FROM (SELECT DISTINCT year, month, day, currency_normalized, user_id FROM silver_payments WHERE status_normalized = 'captured')
        GROUP BY ALL""")
    assert _rows(users) == _rows(marts.distinct_captured_users(spark.table("silver_payments")))

    reasons = spark.sql("SELECT col, count(*) FROM (SELECT explode(rejection_reasons) FROM silver_payments_rejected) GROUP BY col")
    assert _rows(reasons) == _rows(marts.rejection_counts(spark.table("silver_payments_rejected")))
    one_day = spark.sql("SELECT * FROM fact_payments WHERE full_date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(full_date" in one_day._jdf.queryExecution().executedPlan().toString()
