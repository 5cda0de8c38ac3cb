"""The medallion graph as lazily derived DataFrames.

``Layers`` wires bronze -> validated view -> {silver, quarantine} -> daily
fact -> {fact, failed fact}. Nothing runs until an action; each consumer gets
one Catalyst plan from the bronze scan to its answer. Publishing
(``tallyflow.sources.publish``) cuts this lineage into written tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyflow.operators import gold, silver
from tallyflow.session import use_utc
from tallyflow.sources import fixture


class Layers:
    """Each layer is built (and analysed by Spark) when it is first asked for, together
    with those below it and no others."""

    def __init__(self, bronze: DataFrame):
        self.bronze = bronze

    @cached_property
    def validated(self) -> DataFrame:
        return silver.with_reasons(self.bronze)

    @cached_property
    def accepted(self) -> DataFrame:
        return silver.accepted(self.validated)

    @cached_property
    def rejected(self) -> DataFrame:
        return silver.rejected(self.validated)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.project_silver(silver.dedup(self.accepted))

    @cached_property
    def daily(self) -> DataFrame:
        return gold.daily(self.silver)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_payments(self.daily)

    @cached_property
    def fact_rejected(self) -> DataFrame:
        return gold.fact_payments_rejected(self.daily)

    @property
    def all_payments(self) -> DataFrame:
        """O3 over unpublished layers: the daily rows themselves, since each is in
        exactly one fact; uniting the two would work out silver twice."""
        return self.daily


def derive(bronze: DataFrame) -> Layers:
    return Layers(bronze)


def from_testdata(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers over the payments bronze derived from ``{sf_dir}/events.parquet``,
    with the files that are there now."""
    use_utc(spark)
    return derive(fixture.bronze_from_dir(spark, sf_dir))
