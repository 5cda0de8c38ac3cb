"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the payments bronze derived from the
whole ``events`` table of ``sf_dir``.

Outputs are conformed for comparison with an independent SQL engine: arrays
of reasons are rendered as comma-joined text and wide decimal sums as
``decimal(38, s)`` (``conform``). Queries with file effects (landing,
streaming, publishing) work in a fresh folder below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyflow.functions import columns as C
from tallyflow.operators import dims, gold, marts, outbound, silver
from tallyflow.plans import pipeline
from tallyflow.plans.layers import Layers, from_testdata
from tallyflow.session import scratch_path, use_utc
from tallyflow.sources import discovery, fixture, publish, raw
from tallyflow.sources.catalog import CatalogWarehouse
from tallyflow.sources.schema import BRONZE_COLUMNS
from tallyflow.sources.tables import TABLES
from tallyflow.streaming import bronze as bronze_streaming

Query = Callable[[SparkSession, str], DataFrame]


def conform(df: DataFrame) -> DataFrame:
    """Arrays of text -> ``a,b`` text; decimals wider than 18 digits -> 38;
    dates and timestamps -> ISO text (session zone UTC)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            c = c.cast(T.DecimalType(38, f.dataType.scale))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _layers(spark: SparkSession, sf_dir: str) -> Layers:
    return from_testdata(spark, sf_dir)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_testdata(spark, sf_dir).bronze


# --- P1-P6: typed columns over every bronze row ---------------------------------


def q_amount_input(spark, sf_dir):
    """P1."""
    b = _bronze(spark, sf_dir)
    return b.select(*BRONZE_COLUMNS, C.amount_input().alias("amount_input"))


def q_amount_decimal(spark, sf_dir):
    """P2."""
    b = _bronze(spark, sf_dir)
    return b.select(
        *BRONZE_COLUMNS, C.safe_amount(C.amount_input()).alias("amount_decimal")
    )


def q_status_normalized(spark, sf_dir):
    """P3."""
    b = _bronze(spark, sf_dir)
    return b.select(*BRONZE_COLUMNS, C.normalized_status().alias("status_normalized"))


def q_currency_normalized(spark, sf_dir):
    """P4."""
    b = _bronze(spark, sf_dir)
    return b.select(
        *BRONZE_COLUMNS, C.normalized_currency().alias("currency_normalized")
    )


def q_event_timestamp_utc(spark, sf_dir):
    """P5."""
    b = _bronze(spark, sf_dir)
    return b.select(*BRONZE_COLUMNS, C.event_time_utc().alias("event_timestamp_utc"))


def q_event_date_parts(spark, sf_dir):
    """P6."""
    b = _bronze(spark, sf_dir)
    return b.select(*BRONZE_COLUMNS, *C.date_parts(C.event_time_utc()))


# --- P9-P13, W1: silver ---------------------------------------------------------


def q_rejection_reasons(spark, sf_dir):
    """The validated view (every row, every reason)."""
    return conform(_layers(spark, sf_dir).validated)


def q_silver_payments_rejected(spark, sf_dir):
    """P10."""
    return conform(_layers(spark, sf_dir).rejected)


def q_silver_accepted(spark, sf_dir):
    """P11 (with the P12 band), before dedup."""
    return conform(_layers(spark, sf_dir).accepted)


def q_amount_band_event(spark, sf_dir):
    """Per-event band of every accepted row."""
    acc = _layers(spark, sf_dir).accepted
    return acc.select("event_id", "merchant_id", "source_file", "amount_decimal", "amount_band")


def q_silver_dedup(spark, sf_dir):
    """W1 + W2: one row per (event_id, merchant_id), all view columns."""
    return conform(silver.dedup(_layers(spark, sf_dir).accepted))


def q_silver_payments(spark, sf_dir):
    """P13."""
    return conform(_layers(spark, sf_dir).silver)


# --- A1, P14-P18, O3: gold ------------------------------------------------------


def q_fact_payments_daily(spark, sf_dir):
    """A1 (+ P15, P16)."""
    return conform(_layers(spark, sf_dir).daily)


def q_amount_band_daily(spark, sf_dir):
    """P14."""
    d = _layers(spark, sf_dir).daily
    return conform(
        d.select("full_date", "merchant_id", "status", "country", "currency", "amount", "amount_band")
    )


def q_fact_payments(spark, sf_dir):
    """P17."""
    return conform(_layers(spark, sf_dir).fact)


def q_fact_payments_rejected(spark, sf_dir):
    """P18."""
    return conform(_layers(spark, sf_dir).fact_rejected)


def q_all_payments(spark, sf_dir):
    """O3."""
    return conform(_layers(spark, sf_dir).all_payments)


# --- A3-A8, J1-J5: analyst questions -----------------------------------------------


def q_top_merchants_gmv(spark, sf_dir):
    """A3."""
    return conform(marts.top_merchants_gmv(_layers(spark, sf_dir).fact))


def q_failure_rate(spark, sf_dir):
    """A2 + A4."""
    return conform(marts.failure_rate(_layers(spark, sf_dir).all_payments, None))


def q_captured_by_country(spark, sf_dir):
    """A5 + J1 + J2."""
    return conform(marts.captured_by_country(spark, _layers(spark, sf_dir).fact))


def q_distinct_captured_users(spark, sf_dir):
    """A6."""
    return marts.distinct_captured_users(_layers(spark, sf_dir).silver)


def q_rejection_counts(spark, sf_dir):
    """A7 + J5."""
    return marts.rejection_counts(_layers(spark, sf_dir).rejected)


def q_gmv_by_revenue_status(spark, sf_dir):
    """A8 + J3."""
    return conform(marts.gmv_by_revenue_status(spark, _layers(spark, sf_dir).fact))


def q_fact_with_calendar(spark, sf_dir):
    """J4 + D1 (every dim_date attribute on both facts)."""
    return conform(marts.fact_with_calendar(spark, _layers(spark, sf_dir).all_payments))


def q_fact_with_country(spark, sf_dir):
    """J1 + S13 (every dim_country attribute on both facts)."""
    return conform(marts.fact_with_country(spark, _layers(spark, sf_dir).all_payments))


def q_fact_with_status(spark, sf_dir):
    """J2 + S12 (every dim_status attribute on both facts)."""
    return conform(marts.fact_with_status(spark, _layers(spark, sf_dir).all_payments))


def q_dim_status(spark, sf_dir):
    """The status dimension with its use by both facts."""
    facts = _layers(spark, sf_dir).all_payments
    return marts.dimension_usage(dims.dim_status(spark), facts, "status_code", "status")


def q_dim_country(spark, sf_dir):
    """The country dimension with its use by both facts."""
    facts = _layers(spark, sf_dir).all_payments
    return marts.dimension_usage(dims.dim_country(spark), facts, "country_code", "country")


def q_dim_date(spark, sf_dir):
    """S14 + D1: the calendar with its use by both facts."""
    facts = _layers(spark, sf_dir).all_payments
    return marts.dimension_usage(dims.dim_date(spark), facts, "full_date", "full_date")


# --- C1-C5: outbound contract -------------------------------------------------------


def _outbound_input(spark, sf_dir):
    use_utc(spark)
    return fixture.outbound_from_dir(spark, sf_dir)


def q_contract_violations(spark, sf_dir):
    """C1."""
    return conform(outbound.contract_violations(_outbound_input(spark, sf_dir)))


def q_contract_normalize(spark, sf_dir):
    """C2, deterministic part (generated ids/times are flagged, not filled)."""
    return conform(
        outbound.normalize_contract(_outbound_input(spark, sf_dir), fill_defaults=False)
    )


def _ndjson(spark, sf_dir):
    norm = outbound.normalize_contract(_outbound_input(spark, sf_dir), fill_defaults=False)
    return outbound.to_ndjson(norm)


def q_event_ndjson(spark, sf_dir):
    """C3."""
    return _ndjson(spark, sf_dir)


def q_event_ndjson_open(spark, sf_dir):
    """C2 + C3 over lines with fields that no schema names: nested ones, and ones with
    the names of columns that the library itself uses."""
    use_utc(spark)
    lines = fixture.open_lines(_outbound_input(spark, sf_dir))
    return outbound.to_ndjson(outbound.normalize_contract(outbound.read_open(lines), fill_defaults=False))


def q_oversize_events(spark, sf_dir):
    """C4."""
    return outbound.oversize_events(_ndjson(spark, sf_dir))


def q_route_by_merchant(spark, sf_dir):
    """Per merchant its events and whether they lie in one run of partitions."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routed = outbound.route_by_merchant(_ndjson(spark, sf_dir), parts).withColumn("p", F.spark_partition_id())
    # the largest and smallest id of each merchant and partition: no other merchant's
    # partition may lie between, and ids must rise with the partitions
    runs = routed.groupBy("merchant_id", "p").agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))
    before = F.lag("high").over(Window.partitionBy("merchant_id").orderBy("p"))
    runs = runs.withColumn("rising", F.coalesce(before <= F.col("low"), F.lit(True)))
    return runs.groupBy("merchant_id").agg(
        F.sum("n").alias("events"), F.min("low").alias("first_event"), F.max("high").alias("last_event"), ((F.max("p") - F.min("p") + 1 == F.count("*")) & F.bool_and("rising")).alias("contiguous")
    )


# --- S1-S9, S16: files, streams, publishing ---------------------------------------------


def _land_fixture(spark, sf_dir, root: str) -> str:
    """Land the fixture as GZIP NDJSON by delivery hour (S8, batch)."""
    b = fixture.bronze_from_dir(spark, sf_dir, with_delivery=True)
    lines = b.select(
        F.to_json(F.struct(*BRONZE_COLUMNS)).alias("line"), "delivered_at"
    )
    return raw.land_raw(lines, root)


def q_raw_landing(spark, sf_dir):
    """S8 (stream): stream ``events`` -> fixture lines -> GZIP NDJSON folders;
    returns the landed lines with their folder columns."""
    use_utc(spark)
    work = scratch_path(spark, "raw_landing")
    events_schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = bronze_streaming.table_stream(spark, f"{sf_dir}/events.parquet", events_schema)
    b = fixture.payments_bronze(events, with_delivery=True)
    lines = b.select(F.to_json(F.struct(*BRONZE_COLUMNS)).alias("line"), "delivered_at")
    bronze_streaming.land_stream(lines, f"{work}/raw", f"{work}/_checkpoint")
    return spark.read.text(f"{work}/raw")


def q_bronze_batch_multi_version(spark, sf_dir):
    """Batch read with the read contract; payload columns (the file path
    in ``source_file`` is run-specific and left out)."""
    use_utc(spark)
    root = _land_fixture(spark, sf_dir, scratch_path(spark, "bronze_batch") + "/raw")
    return raw.read_bronze_batch(spark, root).drop("source_file")


def q_raw_explore(spark, sf_dir):
    """Raw table with a discovered schema and delivery-folder partition columns."""
    use_utc(spark)
    work = scratch_path(spark, "raw_explore")
    root = _land_fixture(spark, sf_dir, f"{work}/raw")
    return discovery.explore(spark, root, f"{work}/schema").drop("source_file")


def _stream_bronze_once(spark, sf_dir, runs: int):
    work = scratch_path(spark, "bronze_stream")
    root = _land_fixture(spark, sf_dir, f"{work}/raw")
    table, added = f"{work}/bronze_payments", []
    for _ in range(runs):
        stream = bronze_streaming.bronze_stream(spark, root)
        added.append(bronze_streaming.append_bronze(stream, table, f"{work}/_checkpoint")[0])
    return bronze_streaming.read_bronze(spark, table, TABLES["bronze_payments"].schema), added


def _with_landing_hour(bronze: DataFrame) -> DataFrame:
    """Payload columns plus the delivery hour read back from ``source_file``
    (the file path itself is run-specific)."""
    pattern = r"year=(\d{4})/month=(\d{2})/day=(\d{2})/hour=(\d{2})/"
    part = [F.regexp_extract("source_file", pattern, i) for i in range(1, 5)]
    hour = F.concat(part[0], F.lit("-"), part[1], F.lit("-"), part[2], F.lit(" "), part[3])
    return bronze.withColumn("landing_hour", hour).drop("source_file")


def q_bronze_stream(spark, sf_dir):
    """S1 + S3 + S4: streamed bronze rows; lineage shown as the landing hour."""
    use_utc(spark)
    return _with_landing_hour(_stream_bronze_once(spark, sf_dir, runs=1)[0])


def q_bronze_append(spark, sf_dir):
    """The stream run twice over the same files; the second run adds
    nothing, so the table holds each landed row once."""
    use_utc(spark)
    table, added = _stream_bronze_once(spark, sf_dir, runs=2)
    if added[1] != 0:
        raise AssertionError(f"re-run replayed {added[1]} rows")
    return _with_landing_hour(table)


def _published(spark, sf_dir):
    """A published warehouse, opened anew as another process would."""
    use_utc(spark)
    root = scratch_path(spark, "warehouse")
    metrics = pipeline.publish_all(spark, _bronze(spark, sf_dir), pipeline.Warehouse(root), run_id="events")
    return pipeline.Warehouse(root), metrics


def _written_layers(spark, sf_dir, *names: str) -> pipeline.Warehouse:
    """A warehouse with only these tables, opened anew."""
    L = _layers(spark, sf_dir)
    build = {
        "silver_payments": lambda: L.silver,
        "silver_payments_rejected": lambda: L.rejected,
        "fact_payments": lambda: L.fact,
        "fact_payments_rejected": lambda: L.fact_rejected,
        "dim_status": lambda: dims.dim_status(spark),
        "dim_date": lambda: dims.dim_date(spark),
    }
    root = scratch_path(spark, "warehouse")
    for name in names:
        pipeline.Warehouse(root).write(build[name](), name)
    return pipeline.Warehouse(root)


def _read_back(name: str) -> Query:
    def run(spark, sf_dir):
        return conform(_written_layers(spark, sf_dir, name).read(spark, name))

    run.__name__ = f"q_published_{name}"
    run.__doc__ = f"S9 + S11: ``{name}`` read back with its declared types and order."
    return run


def q_published_dim_date(spark, sf_dir):
    """S9 + S11 + D1: the published calendar with its use by the published fact."""
    wh = _written_layers(spark, sf_dir, "dim_date", "fact_payments")
    return conform(marts.dimension_usage(wh.read(spark, "dim_date"), wh.read(spark, "fact_payments"), "full_date", "full_date"))


def q_fact_weekends(spark, sf_dir):
    """J4 + P19: the published fact on Saturdays and Sundays, by dynamic pruning."""
    wh = _written_layers(spark, sf_dir, "dim_date", "fact_payments")
    return conform(marts.fact_on_days(wh.read(spark, "fact_payments"), wh.read(spark, "dim_date"), "day_of_week >= 6"))


def q_catalog_tables(spark, sf_dir):
    """Facts and a dimension as catalog tables, read by name in SQL; the first
    table is written twice, so that the second write replaces the first."""
    L = _layers(spark, sf_dir)
    wh = CatalogWarehouse(scratch_path(spark, "catalog"), database=f"payments_{uuid.uuid4().hex[:12]}")
    wh.create_database(spark, wh.root)
    wh.write(L.daily, "fact_payments")
    wh.write(L.fact, "fact_payments")
    wh.write(dims.dim_status(spark), "dim_status")
    notes = wh.described(spark, "fact_payments")
    fact, status = wh.table("fact_payments"), wh.table("dim_status")
    rows = spark.sql(f"SELECT f.*, s.status_name FROM {fact} f JOIN {status} s ON f.status = s.status_code")
    return conform(rows.withColumns({"table_comment": F.lit(notes["comment"]), "table_quality": F.lit(notes["properties"].get("quality"))}))


def q_named_views(spark, sf_dir):
    """S10 + S11: SQL over the published tables by name, and over a temporary view."""
    wh, _ = _published(spark, sf_dir)
    wh.register_views(spark)
    silver.with_reasons(wh.read(spark, "bronze_payments")).createOrReplaceTempView("silver_payments_temp")
    return conform(
        spark.sql(
            """SELECT f.full_date, s.status_name, count(*) AS n_facts, sum(f.txn_count) AS n_events,
                      (SELECT count(*) FROM silver_payments_temp) AS n_bronze
               FROM fact_payments f JOIN dim_status s ON f.status = s.status_code
               GROUP BY f.full_date, s.status_name"""
        )
    )



SLICE_DAY = "2024-01-05"


def q_day_slices(spark, sf_dir):
    """One day and one status of every layer that is sliced by them."""
    L = _layers(spark, sf_dir)
    top = marts.top_merchants_gmv(L.fact, full_date=SLICE_DAY).select(F.lit("top").alias("part"), "merchant_id", "currency", F.col("captured_count").alias("n"))
    rate = marts.failure_rate(L.all_payments, None, full_date=SLICE_DAY).select(F.lit("rate"), "merchant_id", "currency", "event_count")
    users = marts.distinct_captured_users(L.silver, day=tuple(SLICE_DAY.split("-"))).select(F.lit("users"), F.lit(None).cast("string"), "currency", "unique_users")
    return conform(top.union(rate).union(users))


def q_ordered_report(spark, sf_dir):
    """O2: the reason report in its presentation order, with each row's place (at
    most one row for each rule, so one task numbers them)."""
    L = _layers(spark, sf_dir)
    report = marts.rejection_counts(L.rejected, ordered=True).withColumn("_at", F.monotonically_increasing_id())
    return report.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


def q_publish_mv(spark, sf_dir):
    """The published ``fact_payments`` read back from its partitioned files."""
    wh = _written_layers(spark, sf_dir, "fact_payments")
    return conform(wh.read(spark, "fact_payments").select(*gold.FACT_COLUMNS))


def q_write_metrics(spark, sf_dir):
    """added/total records of every published table of one run."""
    _, metrics = _published(spark, sf_dir)
    return publish.metrics_frame(spark, metrics)


_QUERIES: dict[str, Query] = {
    # silver columns and rules
    "amount_input": q_amount_input,
    "amount_decimal": q_amount_decimal,
    "status_normalized": q_status_normalized,
    "currency_normalized": q_currency_normalized,
    "event_timestamp_utc": q_event_timestamp_utc,
    "event_date_parts": q_event_date_parts,
    "rejection_reasons": q_rejection_reasons,
    "silver_payments_rejected": q_silver_payments_rejected,
    "silver_accepted": q_silver_accepted,
    "amount_band_event": q_amount_band_event,
    "silver_dedup": q_silver_dedup,
    "silver_payments": q_silver_payments,
    # gold
    "fact_payments_daily": q_fact_payments_daily,
    "amount_band_daily": q_amount_band_daily,
    "fact_payments": q_fact_payments,
    "fact_payments_rejected": q_fact_payments_rejected,
    "all_payments": q_all_payments,
    # analyst questions and dimension joins
    "top_merchants_gmv": q_top_merchants_gmv,
    "failure_rate": q_failure_rate,
    "captured_by_country": q_captured_by_country,
    "distinct_captured_users": q_distinct_captured_users,
    "rejection_counts": q_rejection_counts,
    "gmv_by_revenue_status": q_gmv_by_revenue_status,
    "fact_with_calendar": q_fact_with_calendar,
    "fact_with_country": q_fact_with_country,
    "fact_with_status": q_fact_with_status,
    "dim_status": q_dim_status,
    "dim_country": q_dim_country,
    "dim_date": q_dim_date,
    # outbound contract
    "contract_violations": q_contract_violations,
    "contract_normalize": q_contract_normalize,
    "event_ndjson": q_event_ndjson,
    "event_ndjson_open": q_event_ndjson_open,
    "oversize_events": q_oversize_events,
    "route_by_merchant": q_route_by_merchant,
    # files, streams, publishing
    "raw_landing": q_raw_landing,
    "bronze_batch_multi_version": q_bronze_batch_multi_version,
    "raw_explore": q_raw_explore,
    "bronze_stream": q_bronze_stream,
    "bronze_append": q_bronze_append,
    "publish_mv": q_publish_mv,
    **{f"published_{n}": _read_back(n) for n in ("silver_payments", "silver_payments_rejected", "fact_payments_rejected")},
    "published_dim_date": q_published_dim_date,
    "fact_weekends": q_fact_weekends,
    "catalog_tables": q_catalog_tables,
    "named_views": q_named_views,
    "day_slices": q_day_slices,
    "ordered_report": q_ordered_report,
    "write_metrics": q_write_metrics,
}


def _conformed(q: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return conform(q(spark, sf_dir))

    run.__name__ = q.__name__
    run.__doc__ = q.__doc__
    return run


QUERIES: dict[str, Query] = {k: _conformed(q) for k, q in _QUERIES.items()}
