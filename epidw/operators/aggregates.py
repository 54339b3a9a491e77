"""Stored aggregates of the notification fact, and which requests they can answer.

Aggregates form a lattice: one with a finer grain answers whatever a coarser one does. A request names attributes to
group by, filters and measures. An aggregate answers it if every attribute, also those only filtered by, follows from
its grain: it is part of it, or belongs to a dimension whose key is, or derives from another attribute that follows.
Measures are sums, so any coarser grouping is a sum of stored rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from epidw import domain as d
from epidw.operators.facts import NOTIFICATION
from epidw.operators.mart import MART, MEASURES

LOCALITY = "dw.dim_localidade"
#: key column -> dimension table and the attributes that follow from the key
DIMENSIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "sk_local": (LOCALITY, ("municipio", "bairro", "regiao_es", "macrorregiao", "uf")),
    **{j.key: (j.table, tuple(j.attributes.values())) for j in d.JUNK_DIMENSIONS},
}
#: attribute -> the attribute it follows from; regions follow from a locality only, as an unknown municipio has several
COARSER = {"ano_mes": "mes_notificacao", "ano": "ano_mes"}
MONTH = "mes_notificacao"  # yyyymm of the notification, 0 if unknown
DATE = "sk_data_notificacao"
#: measures of the fact that aggregates keep as sums
SUMS = {**MEASURES, "obitos_confirmados": "flag_confirmado * flag_obito_covid"}


@dataclass(frozen=True)
class Aggregate:
    """A stored table of sums: its grain (key columns or attributes) and its measures."""

    table: str
    grain: tuple[str, ...]
    measures: tuple[str, ...] = tuple(SUMS)


@dataclass(frozen=True)
class Request:
    """Measures summed by attributes, over the rows whose attributes have one of the given values."""

    attributes: tuple[str, ...]
    measures: tuple[str, ...] = ("notificacoes",)
    filters: Mapping[str, Sequence] = field(default_factory=dict)

    def needs(self) -> set[str]:
        return {*self.attributes, *(a for a, values in self.filters.items() if values)}


#: the aggregates that a load stores besides the mart
STORED = (
    Aggregate("mart.agg_local_class_mes", ("sk_local", "sk_class", MONTH)),
    Aggregate("mart.agg_local_class_perfil", ("sk_local", "sk_class", "sk_perfil")),
    Aggregate("mart.agg_local_class_sint", ("sk_local", "sk_class", "sk_sint")),
    Aggregate("mart.agg_local_class_como", ("sk_local", "sk_class", "sk_como")),
    Aggregate("mart.agg_class_perfil", ("sk_class", "sk_perfil")),
)
MART_AGGREGATE = Aggregate(MART, ("municipio", "ano_mes"), tuple(MEASURES))
FACT = Aggregate(NOTIFICATION, (*DIMENSIONS, DATE))


def month_number() -> Column:
    return F.expr(f"CAST({DATE} div 100 AS INT) AS {MONTH}")


def summed(measures: Iterable[str], stored: bool) -> list[Column]:
    """Sums of measures, from their stored sums or from the columns of the fact."""
    return [F.expr(f"CAST(sum({name if stored else SUMS[name]}) AS LONG) AS {name}") for name in measures]


def build_aggregate(aggregate: Aggregate, tables: Mapping[str, DataFrame], source: Aggregate = FACT) -> DataFrame:
    """The rows of a stored aggregate, from the fact or from a finer aggregate."""
    rows = tables[source.table]
    if source is FACT:
        rows = rows.select(*DIMENSIONS, month_number(), *MEASURES.values())
    return rows.groupBy(*aggregate.grain).agg(*summed(aggregate.measures, source is not FACT))


def follows(grain: Iterable[str]) -> set[str]:
    """Everything that follows from a grain."""
    known = set(grain)
    while True:
        more = {a for key, (_, attributes) in DIMENSIONS.items() if key in known for a in attributes}
        more |= {a for a, source in COARSER.items() if source in known}
        more |= {MONTH} if DATE in known else set()
        if more <= known:
            return known
        known |= more


def answers(aggregate: Aggregate, request: Request) -> bool:
    return request.needs() <= follows(aggregate.grain) and set(request.measures) <= set(aggregate.measures)
