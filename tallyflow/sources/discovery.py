"""The schema of raw JSON by discovery, folder by folder.

Inferring the types of all raw data means reading all of it, again with every question.
Here each delivery folder is looked at once: types are inferred from its newest
``SAMPLE_FILES`` files (whole files, the stated sample) and merged into the schema known
so far, which is kept as numbered versions beside the table (``sources.commits``). A
folder that has newer files than the ones seen is looked at again. ``explore`` then
reads everything with the known schema and no inference at all.

Types widen and never narrow: null < boolean, null < long < double < string, and
whatever else disagrees becomes string; structs unite their fields, arrays their
elements. New columns are added behind the known ones; none is ever dropped.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.sources import commits

SAMPLE_FILES = 1
COMPACT = 32
_NUMBERS = (T.LongType(), T.DoubleType())


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type of the lattice that holds both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if a in _NUMBERS and b in _NUMBERS:
        return T.DoubleType()
    return T.StringType()


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """All fields of both, those of ``a`` first."""
    other = {f.name: f.dataType for f in b.fields}
    known = [T.StructField(f.name, widened(f.dataType, other.pop(f.name, T.NullType()))) for f in a.fields]
    return T.StructType(known + [T.StructField(f.name, f.dataType) for f in b.fields if f.name in other])


@dataclass
class Known:
    """The schema and, for each folder, when the newest file that was sampled changed."""

    schema: T.StructType = field(default_factory=T.StructType)
    folders: dict[str, str] = field(default_factory=dict)
    version: int = 0


def known(spark: SparkSession, log: str) -> Known:
    """What the log holds: entries back to the last one that repeats all folders."""
    out, entries = Known(), []
    for number in reversed(commits.numbers(spark, log)):
        entry = commits.load(spark, log, number)
        if entry is not None:
            entries.append((number, entry))
            if entry["all"]:
                break
    for number, entry in reversed(entries):
        out.folders.update(entry["folders"])
        out.schema, out.version = T.StructType.fromJson(entry["schema"]), number
    return out


def raw_files(spark: SparkSession, root: str) -> DataFrame:
    """folder, path and modification time of every raw file (listed by Spark, not opened)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "path", F.col("modificationTime").cast("string").alias("at"))


def discover(spark: SparkSession, root: str, log: str, sample_files: int = SAMPLE_FILES) -> Known:
    """Look at what is new below ``root`` and return the schema known now. The driver
    gets one row for each sampled file of folders that are new or have newer files."""
    state = known(spark, log)
    files = raw_files(spark, root)
    if state.folders:
        # one row for each folder seen
        seen = spark.createDataFrame(list(state.folders.items()), "folder string, seen string")
        newest = files.groupBy("folder").agg(F.max("at").alias("newest")).join(seen, "folder", "left")
        files = files.join(newest.where("seen IS NULL OR newest > seen").select("folder"), "folder", "left_semi")
    place = F.row_number().over(Window.partitionBy("folder").orderBy(F.desc("at"), "path"))
    chosen = files.withColumn("place", place).where(F.col("place") <= sample_files).collect()
    if not chosen:
        return state
    sample = spark.read.option("dropFieldIfAllNull", "true").option("recursiveFileLookup", "true").json(sorted(r.path for r in chosen))
    schema = merged(state.schema, sample.schema)
    fresh: dict[str, str] = {}
    for r in chosen:
        fresh[r.folder] = max(r["at"], fresh.get(r.folder, ""))
    everything = len(commits.numbers(spark, log)) % COMPACT == 0
    entry = {
        "schema": json.loads(schema.json()),
        "added": [f.name for f in schema.fields if f.name not in state.schema.fieldNames()],
        "folders": {**state.folders, **fresh} if everything else fresh,
        "all": everything,
    }
    version = commits.append(spark, log, entry, above=state.version)
    return Known(schema, {**state.folders, **fresh}, version)


def explore(spark: SparkSession, root: str, log: str, refresh: bool = True, sample_files: int = SAMPLE_FILES) -> DataFrame:
    """One ad-hoc table over the raw root, read with the discovered schema; the delivery
    folders become ``year, month, day, hour`` by partition discovery, so filters on them
    prune folders. Without ``refresh`` the last version is taken as it is."""
    found = discover(spark, root, log, sample_files) if refresh else known(spark, log)
    return spark.read.schema(found.schema).json(root)
