"""Land a scale factor as GZIP NDJSON, run the streaming pipeline twice and
compare every published table's count with the FIXTURES.md control totals.

    python tools/pipeline_check.py [sf_dir]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tallyflow.plans import pipeline  # noqa: E402
from tallyflow.session import build_session, scratch_path  # noqa: E402
from tallyflow.sources import fixture, raw  # noqa: E402
from tallyflow.sources.schema import BRONZE_COLUMNS  # noqa: E402

# --- fixed values: FIXTURES.md control totals --------------------------------------
CONTROL = {
    "sf0.001": {"bronze_payments": 1200, "silver_payments_rejected": 130, "silver_payments": 920,
                "fact_payments": 711, "fact_payments_rejected": 176},
    "sf0.01": {"bronze_payments": 12000, "silver_payments_rejected": 1300, "silver_payments": 9200,
               "fact_payments": 4286, "fact_payments_rejected": 1261},
    "sf0.1": {"bronze_payments": 120000, "silver_payments_rejected": 13005, "silver_payments": 91995,
              "fact_payments": 8410, "fact_payments_rejected": 2671},
}
DIMS = {"dim_status": 4, "dim_country": 8, "dim_date": 4018}


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    expected = {**CONTROL[os.path.basename(sf_dir.rstrip("/"))], **DIMS}
    spark = build_session()
    work = scratch_path(spark, "pipeline_check")
    b = fixture.bronze_from_dir(spark, sf_dir, with_delivery=True)
    raw.land_raw(b.select(F.to_json(F.struct(*BRONZE_COLUMNS)).alias("line"), "delivered_at"),
                 f"{work}/raw")
    wh = pipeline.Warehouse(f"{work}/wh")
    t = time.time()
    first = {m.table: m for m in pipeline.run_from_raw(spark, f"{work}/raw", wh, f"{work}/ckpt")}
    print(f"pipeline run {time.time() - t:.1f}s, quality {wh.quality}")
    second = {m.table: m for m in pipeline.run_from_raw(spark, f"{work}/raw", wh, f"{work}/ckpt")}
    bad = []
    for table, want in expected.items():
        got = first[table].total_records
        print(f"  {table:26s} {got:8d} (expected {want})")
        if got != want:
            bad.append(table)
    if second["bronze_payments"].added_records != 0:
        bad.append("bronze re-run")
    print("OK" if not bad else f"FAILED: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
