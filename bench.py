"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``

Every plan is executed in full through the ``noop`` sink (nothing is
collected to the driver). Each query is run once cold and ``BENCH_RUNS``
times warm; the reported time is the warm median.

* ``publish_all``       fixture bronze -> bronze/silver/quarantine/facts/dims
                        written as partitioned Parquet (the batch pipeline)
* ``stream_ingest``     landed GZIP NDJSON -> streaming bronze (availableNow)
* ``e2e_*``             registered queries, lazily from the payments source to the answer
* ``mart_*``            analyst questions over the published gold/silver

The payments source is derived from ``events`` once, before any timing, and written in
as many files as there are cores: deriving it is test data, not the library, and a single
small file is read by a single task. ``BENCH_SOURCE=events`` derives it inside
every query instead, as rounds before did. ``build`` are the seconds of each ``e2e_*``
query that go into building its DataFrame on the driver (in its figure, too).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tallyflow.operators import marts  # noqa: E402
from tallyflow.plans import pipeline  # noqa: E402
from tallyflow.plans.queries import QUERIES  # noqa: E402
from tallyflow.session import build_session, scratch_path  # noqa: E402
from tallyflow.sources import fixture, raw  # noqa: E402
from tallyflow.sources.schema import BRONZE_COLUMNS  # noqa: E402
from tallyflow.streaming import bronze as bronze_streaming  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
#: BENCH_CHECKSUMS=1 keeps the checksum files that a local file system adds to every
#: output file; no cluster file system has them, so the default leaves them out
CHECKSUMS = os.environ.get("BENCH_CHECKSUMS", "0") == "1"

E2E = (
    "silver_payments",
    "silver_payments_rejected",
    "fact_payments_daily",
    "top_merchants_gmv",
    "failure_rate",
    "captured_by_country",
    "distinct_captured_users",
    "rejection_counts",
    "gmv_by_revenue_status",
    "contract_violations",
    "event_ndjson",
)


def _sf_label(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


#: "bronze": the payments source is written before timing; "events": derived in each query
SOURCE = os.environ.get("BENCH_SOURCE", "bronze")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int = RUNS):
    """Warm median seconds of ``fn`` (after one cold run) and its last result."""
    out = fn()  # cold
    times = []
    for _ in range(runs):
        t = time.perf_counter()
        out = fn()
        times.append(time.perf_counter() - t)
    return statistics.median(times), out


def use_written_source(spark) -> None:
    """Let the queries read the payments source from files written here, as the tables
    of a lake are: the same rows, columns and order of columns."""
    for name in ("bronze_from_dir", "outbound_from_dir"):
        derive = getattr(fixture, name)
        kept: dict = {}

        def written(session, sf_dir, derive=derive, kept=kept, name=name, **how):
            key = (sf_dir, *sorted(how.items()))
            if key not in kept:
                path = scratch_path(session, f"bench_{name}")
                df = derive(session, sf_dir, **how)
                df.repartition(int(CPUS)).write.parquet(path)
                kept[key] = (path, df.schema)
            path, schema = kept[key]
            return session.read.schema(schema).parquet(path)

        setattr(fixture, name, written)
        written(spark, SF_DIR)


def main() -> None:
    spark = build_session(
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        extra={
            "spark.driver.memory": "16g",
            # small outputs keep several writer tasks
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
            **({} if CHECKSUMS else {"spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem"}),
        },
    )
    results: dict[str, float] = {}
    building: dict[str, list[float]] = {}
    if SOURCE == "bronze":
        use_written_source(spark)

    # batch pipeline: every layer published
    def publish():
        wh = pipeline.Warehouse(scratch_path(spark, "bench_wh"))
        pipeline.publish_all(spark, fixture.bronze_from_dir(spark, SF_DIR), wh, "bench")
        return wh

    results["publish_all"], wh = timed(publish, runs=max(1, RUNS - 1))

    # streaming ingest of landed raw files
    landed = scratch_path(spark, "bench_raw")
    b = fixture.bronze_from_dir(spark, SF_DIR, with_delivery=True)
    raw.land_raw(b.select(F.to_json(F.struct(*BRONZE_COLUMNS)).alias("line"), "delivered_at"), landed)

    def ingest():
        work = scratch_path(spark, "bench_stream")
        bronze_streaming.append_bronze(
            bronze_streaming.bronze_stream(spark, landed), f"{work}/bronze", f"{work}/ckpt"
        )

    results["stream_ingest"] = timed(ingest, runs=max(1, RUNS - 1))[0]

    # registered queries, lazily from the events table
    for key in E2E:


        def query(k=key):
            t = time.perf_counter()
            df = QUERIES[k](spark, SF_DIR)
            building.setdefault(f"e2e_{k}", []).append(time.perf_counter() - t)
            run(df)

        results[f"e2e_{key}"] = timed(query)[0]

    # analyst questions over the published tables
    fact = wh.read(spark, "fact_payments")
    failed = wh.read(spark, "fact_payments_rejected")
    silver_t = wh.read(spark, "silver_payments")
    rejected_t = wh.read(spark, "silver_payments_rejected")
    mart_plans = {
        "mart_top_merchants_gmv": lambda: marts.top_merchants_gmv(fact, ordered=True),
        "mart_failure_rate": lambda: marts.failure_rate(fact, failed, ordered=True),
        "mart_captured_by_country": lambda: marts.captured_by_country(spark, fact, ordered=True),
        "mart_distinct_captured_users": lambda: marts.distinct_captured_users(silver_t),
        "mart_rejection_counts": lambda: marts.rejection_counts(rejected_t, ordered=True),
        "mart_gmv_by_revenue_status": lambda: marts.gmv_by_revenue_status(spark, fact),
    }
    for name, build in mart_plans.items():
        results[name] = timed(lambda b=build: run(b()))[0]

    total = round(sum(results.values()), 3)
    print(
        json.dumps(
            {
                "metric": "payments_lakehouse_total_warm_median",
                "value": total,
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in results.items()},
                "build": {k: round(statistics.median(v[1:]), 3) for k, v in building.items()},
                "source": SOURCE,
                "sf": _sf_label(SF_DIR),
                "cpus": int(CPUS),
                "local_checksums": CHECKSUMS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
