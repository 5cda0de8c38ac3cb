"""S9 + S16: publish full-recompute tables and report what each write did.

``publish`` writes a table (Parquet by default; ``fmt`` may name any installed
table format) into a fresh version folder and then commits it: a numbered, immutable
manifest beside the folders names the version, its rows, schema, comment and
properties (``sources.commits``). Readers take the highest whole manifest, so at every
moment they see the version before or the one after, never a part of it, and no
session setting (dynamic partition overwrite) can keep rows that left the result. A
table whose folders are there without any manifest is an error, not an empty table.

The last ``KEEP_VERSIONS`` versions stay: a DataFrame that was read before a republish
still answers, and ``read_published(version=)`` looks back. ``vacuum`` removes folders
that no manifest names (writers that died) once they are old enough.

Before the write the rows are ``rebalance``d on the partition columns: AQE splits a hot
day into several writers and coalesces quiet ones.

Folder names can't hold an empty string, so partition values that may be blank are
encoded on the way out and decoded on the way in (``encode`` / ``decode``); a filter on the
decoded column still prunes folders. Reads use the declared schema and stored
column order.

Metrics come from ``DataFrame.observe`` on the written plan itself: the count is
gathered by the write job, with no second action over the data.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.session import list_names, modified, remove
from tallyflow.sources import commits

LOG = "_commits"
VERSION = "v-"
KEEP_VERSIONS = 3
MARK = "="
#: what a folder name turns into null (a fixed value of the folder layout)
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class WriteMetrics:
    table: str
    added_records: int
    total_records: int


METRICS_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("added_records", T.LongType(), False),
        T.StructField("total_records", T.LongType(), False),
    ]
)


def encode(value: Column) -> Column:
    """A partition value that survives as a folder name: blank values, the null
    folder's name and marked values get a mark in front; null stays null."""
    odd = (value == "") | (value == NULL_FOLDER) | value.startswith(MARK)
    return F.when(odd, F.concat(F.lit(MARK), value)).otherwise(value)


def decode(value: Column) -> Column:
    return F.when(value.startswith(MARK), F.substr(value, F.lit(len(MARK) + 1))).otherwise(value)


def _coded(df: DataFrame, columns: tuple[str, ...], code) -> DataFrame:
    return df.withColumns({c: code(F.col(c)) for c in columns}) if columns else df


def publish(
    df: DataFrame,
    path: str,
    name: str,
    partition_cols: tuple[str, ...] = (),
    coded: tuple[str, ...] = (),
    fmt: str = "parquet",
    comment: str = "",
    properties: dict[str, str] | None = None,
    keep: int = KEEP_VERSIONS,
) -> WriteMetrics:
    """Replace the table at ``path`` by ``df`` and return its record counts.
    ``coded`` names the text partitions whose values may be blank."""
    version, rows = write_version(df, path, name, partition_cols, coded, fmt)
    manifest = {
        "table": name,
        "version": version,
        "rows": rows,
        "format": fmt,
        "schema": json.loads(df.schema.json()),
        "partitions": list(partition_cols),
        "comment": comment,
        "properties": dict(properties or {}),
    }
    commits.append(df.sparkSession, f"{path}/{LOG}", manifest)
    expire(df.sparkSession, path, keep)
    return WriteMetrics(name, rows, rows)


def write_version(
    df: DataFrame, path: str, name: str, partition_cols: tuple[str, ...], coded: tuple[str, ...], fmt: str
) -> tuple[str, int]:
    """Write the rows to a folder of their own, which no reader looks at yet: (folder, rows)."""
    obs = Observation(f"publish_{name}_{uuid.uuid4().hex[:8]}")
    df = _coded(df, coded, encode)
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    # observed in the write stage itself (above the rebalance exchange)
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("error").format(fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    version = f"{VERSION}{uuid.uuid4().hex}"
    writer.save(f"{path}/{version}")
    return version, int(obs.get["rows"])


def expire(spark: SparkSession, path: str, keep: int = KEEP_VERSIONS) -> list[str]:
    """Remove all but the last ``keep`` versions: first the manifests, so that no
    reader can choose a version whose files are going. Returns the folders removed."""
    log = f"{path}/{LOG}"
    whole = [(n, m) for n in commits.numbers(spark, log) if (m := commits.load(spark, log, n)) is not None]
    old, kept = whole[: -max(1, keep)], whole[-max(1, keep) :]
    commits.drop(spark, log, [n for n, _ in old])
    gone = [m["version"] for _, m in old if m["version"] not in {m["version"] for _, m in kept}]
    for version in gone:
        remove(spark, f"{path}/{version}")
    return gone


def vacuum(spark: SparkSession, path: str, older_than_hours: float = 7 * 24) -> list[str]:
    """Remove version folders without a manifest that nobody has touched for that long."""
    log = f"{path}/{LOG}"
    known = {m["version"] for n in commits.numbers(spark, log) if (m := commits.load(spark, log, n)) is not None}
    before = time.time() - older_than_hours * 3600
    gone = [n for n in list_names(spark, path) if n.startswith(VERSION) and n not in known and modified(spark, f"{path}/{n}") < before]
    for version in gone if known else []:  # without any manifest nothing says what is an orphan
        remove(spark, f"{path}/{version}")
    return gone if known else []


def history(spark: SparkSession, path: str) -> list[dict]:
    """The manifests that are kept, newest first, each with its ``number``."""
    log = f"{path}/{LOG}"
    found = [(n, commits.load(spark, log, n)) for n in reversed(commits.numbers(spark, log))]
    return [{"number": n, **m} for n, m in found if m is not None]


def current_version(spark: SparkSession, path: str) -> dict | None:
    """The manifest readers use; None if the table was never published."""
    found = commits.latest(spark, f"{path}/{LOG}")
    if found is None and any(n == LOG or n.startswith(VERSION) for n in list_names(spark, path)):
        raise commits.TableStateError(f"{path} has files of versions, but no whole manifest names one")
    return found and {"number": found[0], **found[1]}


def read_published(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    coded: tuple[str, ...] = (),
    fmt: str = "parquet",
    version: int | None = None,
) -> DataFrame:
    """The table's current version (or the one of that number) with its declared types
    and column order; a table that was never published has no rows."""
    if version is None:
        manifest = current_version(spark, path)
    else:
        manifest = commits.load(spark, f"{path}/{LOG}", version)
        if manifest is None:
            raise commits.TableStateError(f"{path} keeps no version {version}")
    if manifest is None:
        return spark.createDataFrame([], schema)
    df = spark.read.format(fmt).schema(schema).load(f"{path}/{manifest['version']}")
    return _coded(df, coded, decode).select(*schema.fieldNames())


def metrics_frame(spark: SparkSession, metrics: list[WriteMetrics]) -> DataFrame:
    """The per-table report as a DataFrame (one row per written table)."""
    return spark.createDataFrame(
        [(m.table, m.added_records, m.total_records) for m in metrics],
        schema=METRICS_SCHEMA,
    )
