"""Structured Streaming: raw landing in, append-only bronze out.

S1 ``bronze_stream``     file-source stream over the raw root, fixed schema
S5 ``append_bronze``     append-only table with a persisted checkpoint;
                         a re-run picks up only files it has not seen
S8 ``land_stream``       streaming GZIP NDJSON landing by delivery hour
S16 ``ledger``           rows added and in all, without reading the table (``streaming.ledger``)

Bronze has one writer, ``write_batch``: a micro-batch of a stream and a batch
delivery both go to a folder of their own (``ingest=<kind>-<name>-<batch>``), which
a retry replaces. So both are readable together, a batch that ran twice counts
once, and no file log has to be compacted on the driver. The ledger beside the
folders is a log of opened and booked batches; what it has lost is counted anew.

Every micro-batch is bounded (``maxFilesPerTrigger``) and ``availableNow`` drains
the backlog in such batches, so a 100 TB backlog is a sequence of bounded jobs.
GZIP files can't be split: the landing bounds their size (``raw.bounded_files``), and a
source that delivers larger ones must be asked to do so too.
"""

from __future__ import annotations

import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyflow.session import is_file, list_files, make_folder, path_exists, read_text, remove, rename_over, scratch_path, write_text
from tallyflow.sources import raw
from tallyflow.sources.commits import TableStateError
from tallyflow.sources.schema import bronze_read_schema
from tallyflow.streaming import ledger
from tallyflow.streaming.ledger import INGEST

#: a file is new however old it is: back-fills keep their old modification times
ANY_AGE = "36500d"
#: renames of landed files that run at once
RENAMES = 16


def bronze_stream(
    spark: SparkSession,
    raw_root: str,
    definition=None,
    max_files_per_trigger: int | None = 1000,
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """S1 + S3 + S4: stream raw JSON with the registry-derived schema, every
    folder below the root (``recursiveFileLookup``: the delivery folders are
    not turned into columns), plus the source file, in stored order.
    ``max_file_age`` bounds the source's memory of seen files: files older than
    that, counted back from the newest, are ignored. The default ignores none."""
    reader = (
        spark.readStream.format("json")
        .schema(bronze_read_schema(definition))
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", max_file_age)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return raw.bronze_projection(reader.load(raw_root))


def refuse_sink(spark: SparkSession, table_path: str) -> None:
    if path_exists(spark, f"{table_path}/_spark_metadata"):
        raise ValueError(f"{table_path} belongs to a streaming file sink; readers would ignore other files in it")


def write_batch(df: DataFrame, table_path: str, kind: str, name: str, fmt: str = "parquet", batch: int = 0) -> int:
    """Write one batch to its own folder (again: in its place) and book its rows.
    Returns the rows it adds to those booked for it before."""
    spark = df.sparkSession
    refuse_sink(spark, table_path)
    known = ledger.folded(spark, table_path)
    if known.tail >= ledger.COMPACT:
        ledger.compact(spark, table_path)
    ledger.begin(spark, table_path, kind, name, batch)
    obs = Observation(f"bronze_{uuid.uuid4().hex[:8]}")
    written = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite")
    written.option("partitionOverwriteMode", "static").save(f"{table_path}/{ledger.folder(kind, name, batch)}")
    rows = int(obs.get["rows"])
    ledger.book(spark, table_path, kind, name, batch, rows)
    return rows - known.booked(kind, name, batch)


def read_bronze(spark: SparkSession, table_path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """All batches in the stored columns and order; no batch yet: no rows. A ledger
    with rows and no folder to hold them is an error."""
    if not ledger.folders(spark, table_path):
        if ledger.folded(spark, table_path).total:
            raise TableStateError(f"{table_path} has lost its batch folders")
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(INGEST, T.StringType())])
    return spark.read.format(fmt).schema(whole).load(table_path).select(*schema.fieldNames())


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """Names a stream's batches, as long as its checkpoint lives."""
    mark = f"{checkpoint}/table_stream_id"
    if not path_exists(spark, mark):
        write_text(spark, mark, uuid.uuid4().hex[:12])
    return read_text(spark, mark).strip()


def append_bronze(
    stream: DataFrame,
    table_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    name: str | None = None,
) -> tuple[int, int]:
    """S5 + S16: append the stream to the bronze table once over everything
    available now, then stop. Returns rows added by this run and rows in all."""
    spark = stream.sparkSession
    stream_id = stream_name(spark, checkpoint)
    before = ledger.state(spark, table_path, fmt).total

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, table_path, "stream", stream_id, fmt, number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    writer.start().awaitTermination()
    total = ledger.state(spark, table_path, fmt).total
    return total - before, total


def land_batch(framed: DataFrame, raw_root: str, name: str, max_file_bytes: int, at_least: int) -> int:
    """Land one batch under its name; the same batch again replaces its own files.

    The files are written to a folder that readers don't look at and then renamed into
    their hours, as ``<name>-<number>.txt.gz``. Numbers follow from the lines alone, so a
    retry, at whatever step the first try stopped, ends with the same files. Returns
    their number."""
    spark = framed.sparkSession
    staging = f"{raw_root}/_staging/{name}"
    work = scratch_path(spark, "landing")
    rows = raw.bounded_files(framed, max_file_bytes, work, at_least)
    rows.write.mode("overwrite").partitionBy(*raw.LANDING_PARTITIONS).option("compression", "gzip").text(staging)
    targets = {}
    for path in list_files(spark, staging):
        folder, file = path.rsplit("/", 1)
        part = re.match(r"part-(\d+)-.*\.txt\.gz$", file)
        if part:
            hour = folder[folder.index("/_staging/") + len(f"/_staging/{name}") :]
            targets[path] = (f"{raw_root}{hour}", f"{name}-{part[1]}.txt.gz")
    with ThreadPoolExecutor(RENAMES) as pool:  # one call to the file system each
        list(pool.map(lambda folder: make_folder(spark, folder), {folder for folder, _ in targets.values()}))
        list(pool.map(lambda move: rename_over(spark, move[0], "/".join(move[1])), targets.items()))
    remove(spark, staging)
    remove(spark, work)
    return len(targets)


def land_stream(
    lines: DataFrame,
    raw_root: str,
    checkpoint: str,
    line: str = "line",
    delivered_at: str = "delivered_at",
    salt_buckets: int | None = None,
    max_file_bytes: int = raw.MAX_FILE_BYTES,
) -> StreamingQuery:
    """S8 (stream): GZIP NDJSON into ``year=/month=/day=/hour=`` folders of the
    delivery time, each file at most ``max_file_bytes`` of text, exactly once through the
    checkpoint and the batches' names.

    A delivery-hour landing has nearly all rows of a batch in one hour, so by default a
    batch is cut into as many files as there are shuffle partitions, or into
    ``salt_buckets``, and into more where it has more hours or the bound asks for it."""
    framed = raw.landing_frame(lines, line, delivered_at)
    parts = salt_buckets or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream_id = stream_name(lines.sparkSession, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        land_batch(batch, raw_root, f"{stream_id}-{number}", max_file_bytes, parts)

    query = framed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int = 100,
) -> DataFrame:
    """Stream the files of a table. A file source watches a folder, so a
    table stored as one local file is watched through its folder with a
    file-name filter."""
    reader = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
    )
    if is_file(spark, path):
        folder, name = os.path.split(path)
        return reader.option("pathGlobFilter", name).load(folder)
    return reader.load(path)
