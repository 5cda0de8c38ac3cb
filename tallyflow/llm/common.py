"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.session import scratch_path

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: documents whose crc32(doc_id as text) leaves this remainder are never learned from
HELD_OUT_REMAINDER = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id's decimal text, modulo 4 (a null id: null)."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == HELD_OUT_REMAINDER, F.lit(False))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: cuts the lineage
    and survives the loss of any executor."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_chunks(batches: Iterable[pa.RecordBatch], max_chars: int) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches so that one piece holds about ``max_chars`` bytes of
    its ``text`` column (a longer text stands alone): bounds a task's memory by
    the size of the texts, not by the number of rows."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > max_chars:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


#: bytes of one Arrow batch between Spark and a task's Python, where the session says nothing else
BATCH_BYTES = 8 * 1024 * 1024
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Texts are long: batches of Spark's default size hold ten thousand of them, several
    times over, in buffers that neither side gives back. A session's own setting stays."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def give_back_memory() -> None:
    """What a task's end leaves to the next one: Python workers are used again, and
    what their allocators keep of freed memory counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for functions that yield dicts of lists in schema order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        try:
            for out in function(batches):
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
        finally:
            give_back_memory()

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
