"""Raw NDJSON landing and the batch reads over it.

S8 ``land_raw``           GZIP NDJSON under ``year=/month=/day=/hour=`` by delivery time
S3/S4 ``bronze_projection`` file lineage + fixed stored column order
S6 ``read_bronze_batch``  the bronze read contract as a batch read
S7 ``explore_raw``        ad-hoc read: inferred types + partition columns, for small roots
                         (``sources.discovery`` keeps a schema instead)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyflow.session import remove, scratch_path
from tallyflow.sources.schema import BRONZE_COLUMNS, bronze_read_schema

LANDING_PARTITIONS = ("year", "month", "day", "hour")
MAX_FILE_BYTES = 64 * 1024 * 1024


def delivery_partitions(delivered_at: str | Column = "delivered_at") -> list[Column]:
    """Zero-padded ``year/month/day/hour`` folders of the delivery time."""
    ts = F.col(delivered_at) if isinstance(delivered_at, str) else delivered_at
    return [
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
        F.date_format(ts, "HH").alias("hour"),
    ]


def landing_frame(lines: DataFrame, line: str = "line", delivered_at: str = "delivered_at"):
    """``value`` text plus the four folder columns, ready for a text sink."""
    return lines.select(F.col(line).alias("value"), *delivery_partitions(delivered_at))


def bounded_files(framed: DataFrame, max_bytes: int, work: str, at_least: int = 1) -> DataFrame:
    """``framed`` dealt out so that each partition is one file of one folder, of at most
    ``max_bytes`` of text (a line of more than half of that may add its own length).

    Files are cut by running totals of bytes. Each folder's lines fall into as many
    buckets as there are shuffle partitions, by their hash; the buckets' sums, added up
    in their order, say where each bucket begins in its folder, and a running sum inside
    the bucket where each line does. So one very large hour is measured and written by
    many tasks. The sums (a row for each folder and bucket) are gathered first, which
    reads ``framed`` once more, and written below ``work``, which the caller removes once
    the rows are written. All folders together get about ``at_least`` files or more,
    by their bytes: one folder with all rows that many, many small folders one each."""
    spark = framed.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = list(LANDING_PARTITIONS)
    size = (F.octet_length("value") + 1).cast("long")
    rows = framed.select(*folder, "value", size.alias("__size"), F.pmod(F.xxhash64("value"), F.lit(buckets)).alias("__bucket"))
    path = f"{work}/sums"
    rows.groupBy(*folder, "__bucket").agg(F.sum("__size").alias("bytes"), F.max("__size").alias("longest")).write.parquet(path)
    sums = spark.read.parquet(path)
    longest, total = (x or 0 for x in sums.agg(F.max("longest"), F.sum("bytes")).first())
    limit = max(1, min(max_bytes - min(longest, max_bytes // 2), -(-total // at_least)))
    # one row for each folder of the delivery, numbered in one task
    hours = sums.groupBy(*folder).agg(F.sum("bytes").alias("whole"))
    hours = hours.withColumn("files", F.floor((F.col("whole") - 1) / limit) + 1)
    count = hours.agg(F.sum("files")).first()[0] or 1
    before = Window.orderBy(*folder).rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.withColumn("first", F.coalesce(F.sum("files").over(before), F.lit(0)))
    line_up = Window.partitionBy(*folder).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("bytes").over(line_up), F.lit(0)))
    keys = [F.col(f"s.{c}").eqNullSafe(F.col(f"h.{c}")) for c in folder]
    starts = starts.alias("s").join(hours.alias("h"), keys).select(*(f"s.{c}" for c in (*folder, "__bucket", "start")), "h.first")
    inside = Window.partitionBy(*folder, "__bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__before", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    keys = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in (*folder, "__bucket")]
    rows = rows.alias("r").join(starts.alias("t"), keys)
    number = F.col("t.first") + F.floor((F.col("t.start") + F.col("r.__before")) / limit)
    rows = rows.select(*(f"r.{c}" for c in folder), "r.value", number.cast("int").alias("__file"))
    return rows.repartitionById(int(count), "__file").drop("__file")


def land_raw(
    lines: DataFrame, path: str, line: str = "line", delivered_at: str = "delivered_at", max_file_bytes: int = MAX_FILE_BYTES
):
    """S8 (batch): append GZIP NDJSON files into delivery-hour folders, none of more
    than ``max_file_bytes`` of text: a GZIP file is read by one task, so its size bounds
    that task (``bounded_files``)."""
    work = scratch_path(lines.sparkSession, "landing")
    try:
        rows = bounded_files(landing_frame(lines, line, delivered_at), max_file_bytes, work)
        rows.write.mode("append").partitionBy(*LANDING_PARTITIONS).option("compression", "gzip").text(path)
    finally:
        remove(lines.sparkSession, work)
    return path


def bronze_projection(raw: DataFrame) -> DataFrame:
    """S3 + S4: ``source_file`` is the originating file (any payload field of
    that name is replaced), then the ten stored columns in stored order."""
    return raw.withColumn("source_file", F.col("_metadata.file_path")).select(
        *BRONZE_COLUMNS
    )


def read_bronze_batch(spark: SparkSession, path: str, definition=None) -> DataFrame:
    """Read raw JSON with the registry-derived schema (no inference):
    legacy numeric ``amount_usd`` and v3 string ``amount`` side by side.
    A malformed line becomes an all-null row, as in the stream."""
    reader = (
        spark.read.schema(bronze_read_schema(definition))
        .option("recursiveFileLookup", "true")
        .option("mode", "PERMISSIVE")
    )
    return bronze_projection(reader.json(path))


def explore_raw(spark: SparkSession, root: str, sampling_ratio: float = 1.0) -> DataFrame:
    """One ad-hoc table at the raw root. Types are inferred from the JSON
    (extras such as ``schema_version`` stay visible) and the delivery folders
    become ``year, month, day, hour`` columns by partition discovery, so a
    filter on them prunes folders before any file is opened. On very large
    roots pass ``sampling_ratio`` < 1 to bound the inference pass."""
    return spark.read.option("samplingRatio", sampling_ratio).json(root)
