"""The declared pipeline graph: datasets, partitions, and its flows run in
declaration order over named views."""

import gzip
import json
import os

from pyspark.pipelines.graph_element_registry import (
    GraphElementRegistry,
    graph_element_registration_context,
)
from pyspark.pipelines.output import MaterializedView, StreamingTable, TemporaryView

from tallyflow.plans.declarative import declare
from tallyflow.session import scratch_path
from test_bronze import TWICE


class Collected(GraphElementRegistry):
    def __init__(self):
        self.outputs, self.flows = [], []

    def register_output(self, output):
        self.outputs.append(output)

    def register_flow(self, flow):
        self.flows.append(flow)

    def register_sql(self, sql_text, file_path):
        raise AssertionError("no SQL definitions expected")


def _declared(spark, root):
    reg = Collected()
    with graph_element_registration_context(reg):
        declare(spark, root)
    return reg


def test_declared_datasets(spark):
    reg = _declared(spark, "/nonexistent")
    kinds = {o.name: type(o) for o in reg.outputs}
    assert kinds["bronze_payments"] is StreamingTable
    assert kinds["silver_payments_temp"] is TemporaryView
    assert kinds["fact_payments_temp"] is TemporaryView
    for name in ("silver_payments", "silver_payments_rejected", "fact_payments",
                 "fact_payments_rejected", "dim_status", "dim_country", "dim_date"):
        assert kinds[name] is MaterializedView
    parts = {o.name: getattr(o, "partition_cols", None) for o in reg.outputs}
    assert parts["silver_payments"] == ["year", "month", "day"]
    assert parts["fact_payments"] == ["full_date", "country"]
    assert parts["dim_date"] is None
    from tallyflow.sources.tables import TABLES

    for o in reg.outputs:
        if o.name in TABLES:
            assert o.comment == TABLES[o.name].comment != ""
            assert o.table_properties == TABLES[o.name].properties != {}
    assert [f.target for f in reg.flows][0] == "bronze_payments"
    assert len(reg.flows) == 10


def test_flows_run_in_declared_order(spark):
    work = scratch_path(spark, "declared")
    root = work[len("file:"):] if work.startswith("file:") else work
    os.makedirs(f"{root}/raw", exist_ok=True)
    with gzip.open(f"{root}/raw/a.json.gz", "wt") as f:
        for line in TWICE:
            f.write(json.dumps(line) + "\n")
    reg = _declared(spark, f"{root}/raw")
    outputs = {}
    for flow in reg.flows:
        df = flow.func()
        if df.isStreaming:
            q = df.writeStream.format("parquet").option("checkpointLocation", f"{work}/ckpt") \
                .trigger(availableNow=True).start(f"{work}/bronze")
            q.awaitTermination()
            df = spark.read.parquet(f"{work}/bronze")
        df.createOrReplaceTempView(flow.target)
        outputs[flow.target] = df
    assert outputs["bronze_payments"].count() == 2
    assert outputs["silver_payments"].count() == 1
    assert outputs["silver_payments_rejected"].count() == 0
    (fact,) = outputs["fact_payments"].collect()
    assert (fact.full_date, fact.country, fact.amount_band) == ("2026-03-05", "unknown", "medium")
    assert outputs["dim_date"].count() == 4018


def test_example_spec_is_well_formed():
    """The spec uses only the documented fields (name and storage required)."""
    from pathlib import Path

    import pytest

    yaml = pytest.importorskip("yaml")
    root = Path(__file__).resolve().parent.parent
    spec = yaml.safe_load((root / "examples" / "payments-pipeline" / "spark-pipeline.yml").read_text())
    allowed = {"name", "storage", "catalog", "database", "schema", "configuration", "libraries"}
    assert set(spec) <= allowed and {"name", "storage"} <= set(spec)
    assert all(isinstance(k, str) and isinstance(v, str) for k, v in spec["configuration"].items())
    assert [lib["glob"]["include"] for lib in spec["libraries"]] == ["transformations/**"]
