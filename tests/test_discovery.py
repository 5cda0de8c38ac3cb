"""The raw schema by discovery: folders are looked at once, types widen, nothing is inferred twice."""

import gzip
import json
import os
import time

from pyspark.sql import types as T

from tallyflow.session import scratch_path
from tallyflow.sources import commits, discovery


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def put(root, hour, name, *rows, age=0):
    folder = f"{local(root)}/year=2026/month=03/day=05/hour={hour:02d}"
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}", "wt") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)
    os.utime(f"{folder}/{name}", (time.time() - age,) * 2)


def types(schema):
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def test_lattice():
    kinds = [T.NullType(), T.BooleanType(), T.LongType(), T.DoubleType(), T.StringType(), T.ArrayType(T.LongType()),
             T.StructType([T.StructField("a", T.LongType())]), T.StructType([T.StructField("b", T.DoubleType())])]
    join = discovery.widened
    for a in kinds:
        assert join(a, a) == a and join(T.NullType(), a) == a == join(a, T.NullType())
        for b in kinds:
            assert join(a, b).simpleString().replace("b:double,a:bigint", "a:bigint,b:double") == join(b, a).simpleString().replace("b:double,a:bigint", "a:bigint,b:double")
            for c in kinds:
                assert len(join(join(a, b), c).simpleString()) == len(join(a, join(b, c)).simpleString())
    assert join(T.LongType(), T.DoubleType()) == T.DoubleType() and join(T.BooleanType(), T.LongType()) == T.StringType()
    assert join(T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())) == T.ArrayType(T.DoubleType())
    assert join(kinds[-2], kinds[-1]).simpleString() == "struct<a:bigint,b:double>"


def test_new_folders_add_columns_and_widen_types(spark):
    work = scratch_path(spark, "discovery")
    root, log = f"{work}/raw", f"{work}/schema"
    put(root, 1, "a.gz", {"id": "x", "n": 1, "none": None}, {"id": "y", "n": 2, "o": {"p": 1}}, age=500)
    first = discovery.discover(spark, root, log)
    assert types(first.schema) == {"id": "string", "n": "bigint", "o": "struct<p:bigint>"} and first.version == 1
    # nothing new: no version, and no file is opened
    assert discovery.discover(spark, root, log) == first
    put(root, 2, "a.gz", {"id": 7, "n": 2.5, "o": {"q": True}, "late": [1]}, "{broken", age=400)
    second = discovery.discover(spark, root, log)
    known = types(second.schema)
    assert known.pop("_corrupt_record", "string") == "string"
    assert known == {"id": "string", "n": "double", "o": "struct<p:bigint,q:boolean>", "late": "array<bigint>"}
    assert commits.load(spark, log, second.version)["added"][-1:] == ["late"] or "late" in commits.load(spark, log, second.version)["added"]
    # a late file in a folder that was seen
    put(root, 1, "b.gz", {"later": "x"}, age=0)
    third = discovery.discover(spark, root, log)
    assert types(third.schema)["later"] == "string" and third.version == 3
    # types never narrow
    put(root, 3, "a.gz", {"n": 4}, age=0)
    assert types(discovery.discover(spark, root, log).schema)["n"] == "double"


def test_exploring_infers_nothing(spark):
    work = scratch_path(spark, "explore")
    root, log = f"{work}/raw", f"{work}/schema"
    for hour in range(3):
        put(root, hour, "a.gz", {"id": str(hour), "n": hour, "o": {"p": [1, 2]}}, {"id": "k", "n": 0.5})
    discovery.discover(spark, root, log)
    sc = spark.sparkContext
    sc.setJobGroup("explore", "no job may run")
    try:
        df = discovery.explore(spark, root, log, refresh=False)
        assert sc.statusTracker().getJobIdsForGroup("explore") == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert df.columns == ["id", "n", "o", "year", "month", "day", "hour"]
    assert sorted((r.hour, r.id, r.n) for r in df.collect()) == sorted([(h, str(h), float(h)) for h in range(3)] + [(h, "k", 0.5) for h in range(3)])
    assert "PartitionFilters: [isnotnull(hour" in df.where("hour = 2")._jdf.queryExecution().executedPlan().toString()


def test_the_log_keeps_all_folders(spark, monkeypatch):
    work = scratch_path(spark, "folders")
    root, log = f"{work}/raw", f"{work}/schema"
    monkeypatch.setattr(discovery, "COMPACT", 2)
    for hour in range(5):
        put(root, hour, "a.gz", {f"c{hour}": hour})
        discovery.discover(spark, root, log)
    state = discovery.known(spark, log)
    assert len(state.folders) == 5 and state.schema.fieldNames() == [f"c{i}" for i in range(5)]
