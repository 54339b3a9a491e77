"""The warehouse load: staging, dimensions, facts, mart, gate, publication."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from epidw import domain as d
from epidw.operators import aggregates, dimensions, facts, mart, quality
from epidw.operators.staging import build_staging
from epidw.plans import shared_refresh
from epidw.session import cut_lineage, tune
from epidw.sources.warehouse import Warehouse

STAGING = "stg.notificacao_raw"
DIMENSIONS = ("dw.dim_tempo", "dw.dim_localidade", *(j.table for j in d.JUNK_DIMENSIONS))


class Load(Warehouse):
    """A version under construction. Asking for a table builds and writes it, and what it needs, once."""

    raw: DataFrame
    seconds: dict[str, float]
    locks: dict[str, Lock]

    @classmethod
    def start(cls, spark: SparkSession, raw: DataFrame, root: str) -> Load:
        load = cls.new_version(tune(spark), root)
        load.raw = raw
        load.seconds = {}
        load.locks = {table: Lock() for table in BUILDERS}
        return load

    @property
    def rows(self) -> DataFrame:
        """The raw rows for passes over them; a load may have them in a form that is cheaper to come by than ``raw``."""
        return self.raw

    def __getitem__(self, table: str) -> DataFrame:
        with self.locks[table]:
            if table not in self._frames:
                began = time.perf_counter()
                self.write(table, BUILDERS[table](self))
                self.seconds[table] = time.perf_counter() - began
        return self._frames[table]

    def __contains__(self, table: object) -> bool:
        return table in self._frames

    def build(self, *tables: str) -> None:
        for table in tables:
            self[table]

    def build_together(self, *tables: str) -> None:
        """Build tables that do not depend on each other as concurrent Spark jobs."""
        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(self.__getitem__, tables))

    def check(self) -> None:
        """Run the quality gate; raises :class:`quality.QualityError` on any failure."""
        began = time.perf_counter()
        mismatched = [f"schema:{table}" for table in quality.schema_differences(self)]
        quality.enforce(quality.quality_report(self), mismatched)
        self.seconds["gate"] = time.perf_counter() - began


def _junk(dimension: d.JunkDimension) -> Callable[[Load], DataFrame]:
    return lambda load: dimensions.build_junk_dimension(load[STAGING], dimension)


def _aggregate(aggregate: aggregates.Aggregate) -> Callable[[Load], DataFrame]:
    finer = next((a for a in aggregates.STORED if a is not aggregate and set(aggregate.grain) < set(a.grain)), aggregates.FACT)
    # a few thousand rows per dimension member at most; sorted files skip what a key filter leaves out
    return lambda load: aggregates.build_aggregate(aggregate, load, finer).sortWithinPartitions(*aggregate.grain)


def _notification_fact(load: Load) -> DataFrame:
    fact = facts.build_notification_fact(load[STAGING], load)
    # ordered inside each task only: no shuffle, tighter pages and min/max statistics per municipio
    return fact.sortWithinPartitions("sk_local", "sk_data_notificacao")


BUILDERS: dict[str, Callable[[Load], DataFrame]] = {
    STAGING: lambda load: build_staging(load.rows),
    "dw.dim_tempo": lambda load: dimensions.build_date_dimension(load.spark),
    "dw.dim_localidade": lambda load: dimensions.build_locality_dimension(
        cut_lineage(dimensions.build_locality_base(load[STAGING]))
    ),
    **{j.table: _junk(j) for j in d.JUNK_DIMENSIONS},
    facts.NOTIFICATION: _notification_fact,
    facts.EXAM: lambda load: facts.build_exam_fact(load[facts.NOTIFICATION], load[d.TEST_DIM.table]),
    mart.MART: lambda load: mart.refresh_mart(load[facts.NOTIFICATION], load["dw.dim_localidade"]).orderBy(
        "municipio", "ano_mes"
    ),
    **{a.table: _aggregate(a) for a in aggregates.STORED},
    shared_refresh.PANELS: lambda load: shared_refresh.panel_cube(load).coalesce(1),
    "dw.dim_municipio": lambda load: dimensions.build_snowflake_municipio(load["dw.dim_localidade"]),
    "dw.dim_bairro": lambda load: dimensions.build_snowflake_bairro(load["dw.dim_localidade"], load["dw.dim_municipio"]),
}


def run_pipeline(spark: SparkSession, raw: DataFrame, root: str) -> Load:
    """Load a new version and publish it only if the gate passes; readers keep the old one otherwise."""
    load = Load.start(spark, raw, root)
    load.build(STAGING)
    load.build_together(*DIMENSIONS)
    load.build(facts.NOTIFICATION)
    load.build_together(facts.EXAM, mart.MART, *(a.table for a in aggregates.STORED))
    load.build(shared_refresh.PANELS)
    load.check()
    load.publish()
    return load
