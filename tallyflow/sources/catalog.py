"""The published tables in a catalog, written with ``DataFrameWriterV2``.

In a catalog whose tables can be replaced in one step (Iceberg and the like, configured
under ``spark.sql.catalog.<name>``, see ``iceberg_settings``) every write is one
``createOrReplace``: readers see the old or the new snapshot, and properties and
partitions are those of the declaration. Spark's own session catalog cannot replace a
table of files, so there the first write creates it and later ones overwrite all its
rows; its blank partition values would come back null, hence values that may be blank
are stored as ordinary columns there.

Comment and properties are kept by the catalog and read back with ``described``.
``CatalogWarehouse`` takes the place of ``Warehouse`` in the runs of ``plans.pipeline``:
only bronze, with its batch folders, stays below the root.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyflow.plans.pipeline import BRONZE, Warehouse
from tallyflow.session import settings
from tallyflow.sources import publish as pub
from tallyflow.sources.tables import TABLES

SESSION_CATALOG = "spark_catalog"


def iceberg_settings(catalog: str, warehouse: str, implementation: str | None = None, io: str | None = None) -> dict[str, str]:
    """Session settings of an Iceberg catalog: a folder catalog at ``warehouse``, or the
    ``implementation`` (and file ``io``) that is named. Its jar must be installed."""
    key = f"spark.sql.catalog.{catalog}"
    out = {key: "org.apache.iceberg.spark.SparkCatalog", f"{key}.warehouse": warehouse}
    out[f"{key}.catalog-impl" if implementation else f"{key}.type"] = implementation or "hadoop"
    if io:
        out[f"{key}.io-impl"] = io
    out["spark.sql.extensions"] = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class CatalogWarehouse(Warehouse):
    catalog: str = SESSION_CATALOG
    database: str = "payments"

    def table(self, name: str) -> str:
        return ".".join(map(quoted, (self.catalog, self.database, name)))

    def create_database(self, spark: SparkSession, location: str | None = None) -> None:
        where = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(self.catalog)}.{quoted(self.database)}{where}")

    def replaces(self, spark: SparkSession) -> bool:
        """Whether tables can be replaced in one step."""
        return self.catalog != SESSION_CATALOG or spark.conf.get(f"spark.sql.catalog.{SESSION_CATALOG}", "builtin") != "builtin"

    def properties(self, name: str) -> dict[str, str]:
        extra = {"format-version": "2"} if self.fmt == "iceberg" else {}
        return {**TABLES[name].properties, **extra}

    def partitions(self, spark: SparkSession, name: str) -> list[str]:
        table = TABLES[name]
        return [p for p in table.partitions if self.replaces(spark) or p not in table.coded]

    def write(self, df: DataFrame, name: str) -> pub.WriteMetrics:
        spark, target = df.sparkSession, self.table(name)
        parts = self.partitions(spark, name)
        obs = Observation(f"catalog_{name}_{uuid.uuid4().hex[:8]}")
        df = df.select(*TABLES[name].schema.fieldNames())
        df = (df.hint("rebalance", *parts) if parts else df).observe(obs, F.count(F.lit(1)).alias("rows"))
        writer = df.writeTo(target).using(self.fmt)
        for key, value in self.properties(name).items():
            writer = writer.tableProperty(key, value)
        if parts:
            writer = writer.partitionedBy(*map(F.col, parts))
        if self.replaces(spark):
            writer.createOrReplace()
        elif not spark.catalog.tableExists(target):
            writer.create()
        else:  # all rows, whatever the session says about partitions
            with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
                df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
            pairs = ", ".join(f"'{k}' = '{v}'" for k, v in self.properties(name).items())
            spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({pairs})")
        text = TABLES[name].comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {target} IS '{text}'")
        rows = int(obs.get["rows"])
        return pub.WriteMetrics(name, rows, rows)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name == BRONZE:
            return super().read(spark, name)
        if not spark.catalog.tableExists(self.table(name)):
            return spark.createDataFrame([], TABLES[name].schema)
        return spark.table(self.table(name)).select(*TABLES[name].schema.fieldNames())

    def described(self, spark: SparkSession, name: str) -> dict:
        """Comment, properties and partition columns as the catalog has them."""
        target = self.table(name)
        kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}
        parts = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
        return {
            "comment": spark.catalog.getTable(target).description,
            "properties": {k: v for k, v in kept.items() if k in self.properties(name)},
            "partitions": parts,
        }

    def register_views(self, spark: SparkSession, names=None) -> list[str]:
        done = []
        for name in names or TABLES:
            if name != BRONZE and spark.catalog.tableExists(self.table(name)) or name == BRONZE:
                self.read(spark, name).createOrReplaceTempView(name)
                done.append(name)
        return done
