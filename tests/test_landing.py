"""Landing in files of a bounded size, whatever the hours and lines are like."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from tallyflow.session import scratch_path
from tallyflow.sources import raw
from tallyflow.streaming import bronze

BOUND = 20_000


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def landed(root):
    """Bytes of text of every landed file, by its hour's folder."""
    out = {}
    for path in glob.glob(f"{local(root)}/year=*/month=*/day=*/hour=*/*.gz"):
        with gzip.open(path) as f:
            out.setdefault(os.path.basename(os.path.dirname(path)), []).append(len(f.read()))
    return out


def lines(spark, n=3000):
    """One hot hour, many quiet ones, and lines from ten to some thousand characters."""
    rows = spark.range(n).withColumn("hour", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 24).cast("int"))
    text = F.concat(F.lit('{"n":'), "id", F.lit(',"x":"'), F.expr("repeat('ab', cast(if(id % 50 = 0, 2000, id % 7) as int))"), F.lit('"}'))
    return rows.select(text.alias("line"), F.make_timestamp(F.lit(2026), F.lit(3), F.lit(5), "hour", F.lit(0), F.lit(0)).alias("delivered_at"))


def test_no_file_passes_the_bound(spark):
    root = scratch_path(spark, "bounded")
    raw.land_raw(lines(spark), root, max_file_bytes=BOUND)
    sizes = landed(root)
    assert len(sizes) == 9 and max(max(s) for s in sizes.values()) <= BOUND
    whole = {hour: sum(s) for hour, s in sizes.items()}
    assert all(len(sizes[h]) <= -(-whole[h] // (BOUND - 4100)) for h in sizes)  # and not more files than needed
    assert len(sizes["hour=05"]) > 5
    back = spark.read.text(root).select("value")
    want = lines(spark).select(F.col("line").alias("value"))
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()


def test_few_bytes_make_one_file_an_hour(spark):
    root = scratch_path(spark, "small")
    raw.land_raw(lines(spark, 200), root)
    assert all(len(s) == 1 for s in landed(root).values())


def test_lines_longer_than_the_bound_and_no_lines(spark):
    root = scratch_path(spark, "longer")
    some = spark.createDataFrame([("x" * 5000, "2026-03-05 01:00:00")] * 4 + [("y", None)], "line string, at string")
    raw.land_raw(some.select("line", F.to_timestamp("at").alias("delivered_at")), root, max_file_bytes=100)
    files = sorted(glob.glob(f"{local(root)}/year=2026/month=03/day=05/hour=01/*.gz"))
    assert len(files) == 4 and spark.read.text(root).count() == 5
    raw.land_raw(some.where("false").select("line", F.to_timestamp("at").alias("delivered_at")), scratch_path(spark, "none"))


@pytest.mark.parametrize("stop", ["make_folder", "rename_over", "remove"])
def test_a_batch_that_stopped_lands_once(spark, monkeypatch, stop):
    root = scratch_path(spark, "retried")
    framed = raw.landing_frame(lines(spark, 600))
    calls = []

    def stopped(*a):
        calls.append(a)
        if len(calls) > 3 or stop == "remove":
            raise OSError(stop)
        return real(*a)

    real = getattr(bronze, stop)
    monkeypatch.setattr(bronze, stop, stopped)
    with pytest.raises(OSError):
        bronze.land_batch(framed, root, "s-0", BOUND, 1)
    monkeypatch.undo()
    n = bronze.land_batch(framed, root, "s-0", BOUND, 1)
    assert sum(len(s) for s in landed(root).values()) == n and spark.read.text(root).count() == 600


def test_stream_lands_bounded_files_once(spark):
    work = scratch_path(spark, "landing_stream")
    lines(spark).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(lines(spark).schema).parquet(f"{work}/in")
    for _ in range(2):  # the second run has nothing to land
        bronze.land_stream(stream, f"{work}/raw", f"{work}/ckpt", max_file_bytes=BOUND)
        sizes = landed(f"{work}/raw")
        assert max(max(s) for s in sizes.values()) <= BOUND and spark.read.text(f"{work}/raw").count() == 3000
    assert not os.path.exists(f"{local(work)}/raw/_staging/{bronze.stream_name(spark, f'{work}/ckpt')}-0")
