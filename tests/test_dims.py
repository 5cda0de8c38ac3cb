"""Dimensions: literal references and the generated calendar."""

from tallyflow.operators import dims


def test_dim_date_counts(spark):
    d = dims.dim_date(spark)
    assert d.count() == 4018 == dims.calendar_days()
    agg = d.selectExpr(
        "sum(cast(is_weekend as int)) w", "sum(cast(is_month_end as int)) m",
        "sum(cast(is_quarter_end as int)) q", "sum(cast(is_year_end as int)) y",
    ).first()
    assert (agg.w, agg.m, agg.q, agg.y) == (1148, 132, 44, 11)
    assert len(d.columns) == 16


def test_dim_date_iso_week_and_weekday(spark):
    r = dims.dim_date(spark).where("full_date = '2021-01-01'").first()
    assert r.week_of_year == 53 and r.year == 2021
    assert r.day_of_week == 5 and r.day_name == "Friday" and r.date_key == 20210101
    sun = dims.dim_date(spark).where("full_date = '2024-01-07'").first()
    assert sun.day_of_week == 7 and sun.is_weekend


def test_dim_country(spark):
    rows = {r.country_code: r for r in dims.dim_country(spark).collect()}
    assert len(rows) == 8
    assert rows["unknown"].is_unknown and rows["unknown"].country_code_alpha3 is None
    assert rows["BR"].subregion_name == "Latin America and the Caribbean"


def test_dim_status(spark):
    rows = dims.dim_status(spark).collect()
    assert [r.status_code for r in rows if r.is_revenue] == ["captured"]
    assert len(rows) == 4


def test_bounded_broadcast(spark):
    plan = dims.date_for_join(spark)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()
    small = dims.bounded_broadcast(dims.dim_status(spark), rows=10**9, bound=10)
    assert "broadcast" not in small._jdf.queryExecution().analyzed().toString().lower()


def test_scale_settings():
    from tallyflow.session import scale_settings

    big = scale_settings(100 * 1024**4)
    assert int(big["spark.sql.shuffle.partitions"]) == 51200
    assert big["spark.sql.files.maxPartitionBytes"] == "512m"
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "1024m"
    assert scale_settings(10)["spark.sql.shuffle.partitions"] == "200"


def test_dimension_usage_counts(spark):
    from tallyflow.operators import marts

    facts = spark.createDataFrame(
        [("captured", "BR"), ("captured", "FR"), ("failed", "unknown"), ("captured", "BR")],
        "status string, country string",
    )
    by_status = {r.status_code: r.fact_rows
                 for r in marts.dimension_usage(dims.dim_status(spark), facts, "status_code", "status").collect()}
    assert by_status == {"authorized": 0, "captured": 3, "failed": 1, "refunded": 0}
    by_country = marts.dimension_usage(dims.dim_country(spark), facts, "country_code", "country")
    rows = {r.country_code: r for r in by_country.collect()}
    assert len(rows) == 8 and "FR" not in rows  # unmapped codes add no member
    assert rows["BR"].fact_rows == 2 and rows["unknown"].fact_rows == 1 and rows["US"].fact_rows == 0
    assert rows["BR"].country_name == "Brazil"
