"""The medallion run: raw -> bronze (stream) -> silver -> gold + dimensions.

Each layer is published as a table and the next layer reads the published
table, so lineage is cut at every layer (a lost executor re-runs at most the
current layer's tasks, never the whole chain) and no intermediate is cached
in executor memory. Typing and the eleven rules run once over bronze, into a
validated scratch table split by its verdict; quarantine and silver each read
their half. The daily aggregate is written once too, split by failed or not.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyflow.functions import domain
from tallyflow.operators import dims, gold, silver
from tallyflow.session import path_bytes, path_exists, remove, scratch_path, sized_for, use_utc
from tallyflow.sources import publish as pub
from tallyflow.sources.tables import TABLES
from tallyflow.streaming import bronze as bronze_stream
from tallyflow.streaming import ledger

TABLE_PARTITIONS = {name: t.partitions for name, t in TABLES.items()}
TABLE_COMMENTS = {name: t.comment for name, t in TABLES.items()}
BRONZE = "bronze_payments"


@dataclass
class Warehouse:
    """Table locations below one root (a shared folder on a cluster). Everything
    needed to read is declared in ``sources.tables`` or stored beside the data."""

    root: str
    fmt: str = "parquet"
    quality: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, df: DataFrame, name: str) -> pub.WriteMetrics:
        table = TABLES[name]
        df = df.select(*table.schema.fieldNames())
        return pub.publish(df, self.path(name), name, table.partitions, table.coded, self.fmt, table.comment, table.properties)

    def append_bronze(self, df: DataFrame, run_id: str) -> pub.WriteMetrics:
        """Append a batch under its run's name; the same name again replaces it."""
        added = bronze_stream.write_batch(df, self.path(BRONZE), "run", run_id, self.fmt)
        return pub.WriteMetrics(BRONZE, added, ledger.state(df.sparkSession, self.path(BRONZE), self.fmt).total)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        table = TABLES[name]
        if name == BRONZE:
            return bronze_stream.read_bronze(spark, self.path(name), table.schema, self.fmt)
        return pub.read_published(spark, self.path(name), table.schema, table.coded, self.fmt)

    def register_views(self, spark: SparkSession, names=None) -> list[str]:
        """Expose published tables under their names (S11), so analyst SQL runs
        through ``spark.sql``; partition filters still prune folders."""
        done = []
        for name in names or TABLES:
            if path_exists(spark, self.path(name)):
                self.read(spark, name).createOrReplaceTempView(name)
                done.append(name)
        return done


def publish_downstream(spark: SparkSession, wh: Warehouse) -> list[pub.WriteMetrics]:
    """Silver, quarantine, facts and dimensions from the bronze table. The validated and
    daily rows that two tables share are written once, and go when these are published."""
    use_utc(spark)
    work = scratch_path(spark, "layers")
    try:
        return _publish_layers(spark, wh, work)
    finally:
        remove(spark, work)


def _publish_layers(spark: SparkSession, wh: Warehouse, work: str) -> list[pub.WriteMetrics]:
    out = []
    quality = Observation()
    validated = silver.with_reasons(wh.read(spark, BRONZE), quality)
    validated = _written(validated.withColumn("_bad", F.size("rejection_reasons") > 0), f"{work}/validated", "_bad")
    wh.quality = dict(quality.get)
    out.append(wh.write(validated.where("_bad").drop("_bad"), "silver_payments_rejected"))
    kept = silver.accepted(validated.where("not _bad").drop("_bad"))
    out.append(wh.write(silver.project_silver(silver.dedup(kept)), "silver_payments"))
    daily = gold.daily(wh.read(spark, "silver_payments"))
    daily = _written(daily.withColumn("_failed", F.col("status") == domain.FAILED_STATUS), f"{work}/daily", "_failed")
    out.append(wh.write(daily.where("not _failed"), "fact_payments"))
    out.append(wh.write(daily.where("_failed"), "fact_payments_rejected"))
    out.append(wh.write(dims.dim_status(spark), "dim_status"))
    out.append(wh.write(dims.dim_country(spark), "dim_country"))
    out.append(wh.write(dims.dim_date(spark), "dim_date"))
    return out


def _written(df: DataFrame, path: str, split: str) -> DataFrame:
    """``df`` as a scratch table, one folder for each value of the boolean ``split``."""
    df.write.partitionBy(split).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_all(spark: SparkSession, bronze: DataFrame, wh: Warehouse, run_id: str) -> list[pub.WriteMetrics]:
    """Batch run: append ``bronze`` to the bronze table, then everything below.
    ``run_id`` names the delivery: a retry under the same name adds nothing."""
    use_utc(spark)
    first = wh.append_bronze(bronze, run_id)
    with sized_for(spark, path_bytes(spark, wh.path(BRONZE))):
        return [first, *publish_downstream(spark, wh)]


def run_from_raw(
    spark: SparkSession,
    raw_root: str,
    wh: Warehouse,
    checkpoint: str,
    definition=None,
) -> list[pub.WriteMetrics]:
    """Streaming run: ingest new raw files into bronze (exactly once through
    ``checkpoint``), then recompute silver, gold and dimensions."""
    use_utc(spark)
    with sized_for(spark, path_bytes(spark, raw_root)):
        added, total = bronze_stream.append_bronze(
            bronze_stream.bronze_stream(spark, raw_root, definition), wh.path(BRONZE), checkpoint, fmt=wh.fmt
        )
    first = pub.WriteMetrics(BRONZE, added, total)
    with sized_for(spark, path_bytes(spark, wh.path(BRONZE))):
        return [first, *publish_downstream(spark, wh)]
