"""Aggregate navigation: a request is answered from the smallest stored aggregate that can, the fact as a last resort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from epidw import domain as d
from epidw.functions.dates import month_of_key
from epidw.operators.aggregates import (
    DIMENSIONS, FACT, MART_AGGREGATE, MONTH, STORED, Aggregate, Request, answers, month_number, summed,
)
from epidw.plans.star import Tables, restrict


class Navigator:
    """The stored aggregates of one warehouse version."""

    def __init__(self, tables: Tables, aggregates: Sequence[Aggregate] = (*STORED, MART_AGGREGATE)) -> None:
        self.tables, self.aggregates = tables, tuple(aggregates)
        self._rows: dict[str, int] = {}

    def rows(self, aggregate: Aggregate) -> int:
        """Rows of a stored aggregate, counted once, from the footers of its files."""
        if aggregate.table not in self._rows:
            self._rows[aggregate.table] = self.tables[aggregate.table].count()
        return self._rows[aggregate.table]

    def choose(self, request: Request) -> Aggregate:
        """The aggregate with fewest rows of those that answer; equal ones by name."""
        able = [a for a in self.aggregates if answers(a, request)]
        return min(able, key=lambda a: (self.rows(a), a.table)) if able else FACT

    def answer(self, request: Request, route: Aggregate | None = None) -> DataFrame:
        """A row per combination of the attributes; without attributes a single row, 0 where nothing matches.

        Filters on a dimension become key filters before anything is summed, and rows are summed per key before a join.
        """
        route = route or self.choose(request)
        if not answers(route, request):
            raise ValueError(f"{route.table} does not answer {request}")
        rows, stored = self.tables[route.table], route is not FACT
        if not stored:
            rows = rows.withColumn(MONTH, month_number())
        described = self._by_dimension(rows, set(request.filters) | set(request.attributes))
        for attribute, values in request.filters.items():
            key = next((k for k, wanted in described.items() if attribute in wanted), None)
            if values and key:
                rows = restrict(rows, self.tables[DIMENSIONS[key][0]], key, attribute, values)
        described = self._by_dimension(rows, set(request.attributes))
        joined = {a for wanted in described.values() for a in wanted}
        own = [a for a in (*request.attributes, *request.filters) if a in rows.columns]
        months = {"ano_mes", "ano"} & request.needs() - set(own)
        held = dict.fromkeys([*described, *own, *([MONTH if MONTH in rows.columns else "ano_mes"] if months else [])])
        rows = rows.groupBy(*held).agg(*summed(request.measures, stored))
        for key, wanted in described.items():
            rows = rows.join(self.tables[DIMENSIONS[key][0]].select(key, *wanted), key)
        if months and MONTH in rows.columns:
            first_day = F.when(F.col(MONTH) > 0, F.col(MONTH) * 100 + 1).otherwise(d.UNKNOWN_KEY)
            rows = rows.withColumn("ano_mes", month_of_key(first_day))
        if "ano" in months:
            rows = rows.withColumn("ano", F.when(F.col("ano_mes") == d.UNKNOWN, 0).otherwise(F.substring("ano_mes", 1, 4).cast("int")))
        for attribute, values in request.filters.items():
            if values and (attribute in own or attribute in months) and attribute not in joined:
                rows = rows.filter(F.col(attribute).isin(*values))
        found = rows.groupBy(*request.attributes).agg(*summed(request.measures, stored=True))
        return found if request.attributes else found.na.fill(0)

    @staticmethod
    def _by_dimension(rows: DataFrame, attributes: set[str]) -> Mapping[str, list[str]]:
        """Key column of ``rows`` -> those of the attributes that are not in ``rows`` and follow from it."""
        present = set(rows.columns)
        found = {k: [a for a in known if a in attributes and a not in present] for k, (_, known) in DIMENSIONS.items() if k in present}
        return {k: wanted for k, wanted in found.items() if wanted}
