"""A load from the changes between two snapshots: stable keys, signed fact rows, a merged mart."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from threading import RLock

from pyspark.sql import DataFrame

from epidw import domain as d
from epidw.operators import facts, increments, mart
from epidw.plans.pipeline import Load
from epidw.session import cut_lineage


class IncrementalLoad:
    """What changes in a complete load when the raw rows become ``raw``. Every part is worked out and written once.

    Nothing but the digests of the two snapshots is worked out for all rows: dimensions are extended from changed rows,
    which hold every new member, and lookups and sums see the changes only.
    """

    def __init__(self, before: Load, raw: DataFrame) -> None:
        self.before, self.raw = before, raw
        self._lock = RLock()
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            if name not in self._made:
                self._made[name] = cut_lineage(make())
            return self._made[name]

    @property
    def delta(self) -> DataFrame:
        """Changed raw rows with their signed multiplicity."""
        return self._once("delta", lambda: increments.snapshot_delta(self.before.rows, self.raw))

    @property
    def staged(self) -> DataFrame:
        return self._once("staged", lambda: increments.staged_delta(self.delta))

    def dimension(self, table: str) -> DataFrame:
        """A dimension with the members that the added rows bring; a member that no row has any more stays."""
        added = self.staged.filter(f"{increments.CHANGE} > 0")
        if table == "dw.dim_localidade":
            return self._once(table, lambda: increments.extend_locality(self.before[table], added))
        junk = next(j for j in d.JUNK_DIMENSIONS if j.table == table)
        return self._once(table, lambda: increments.extend_junk_dimension(self.before[table], added, junk))

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        return {t: self.dimension(t) for t in ("dw.dim_localidade", *(j.table for j in d.JUNK_DIMENSIONS))}

    @property
    def fact_delta(self) -> DataFrame:
        return self._once("fact_delta", lambda: increments.fact_delta(self.staged, self.dimensions))

    @property
    def fact(self) -> DataFrame:
        return self._once("fact", lambda: increments.apply_to_fact(self.before[facts.NOTIFICATION], self.fact_delta))

    @property
    def mart(self) -> DataFrame:
        locality = self.dimensions["dw.dim_localidade"]
        return self._once("mart", lambda: increments.merge_mart(self.before[mart.MART], increments.mart_delta(self.fact_delta, locality)))
