"""The municipio-by-month mart, and queries across the two facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from epidw.functions.dates import month_of_key
from epidw.operators.lookup import fits_broadcast

MART = "mart.mv_resumo_municipio_mes"
MEASURES = {
    "confirmados": "flag_confirmado",
    "obitos": "flag_obito_covid",
    "internacoes": "flag_internado",
    "notificacoes": "qtd_notificacao",
}


def _sums(measures: Mapping[str, str]) -> list[Column]:
    return [F.sum(source).cast("long").alias(name) for name, source in measures.items()]


def by_municipio_month(
    fact: DataFrame, date: str, locality: DataFrame, measures: Mapping[str, str], budget: int | None = None
) -> DataFrame:
    """Sum measures per municipio and month of a date role.

    The month is part of the calendar key, so no calendar join is needed. A locality
    dimension that fits the budget is broadcast, which leaves few groups per task to
    shuffle. A larger one meets the fact only after it has been summed per locality
    and month, when no key is hot any more.
    """
    names = locality.select("sk_local", "municipio")
    month = F.expr(f"{date} div 100").alias("_month")
    rows = fact.select("sk_local", month, *measures.values())
    if fits_broadcast(locality, budget):
        placed = rows.join(F.broadcast(names), "sk_local")
    else:
        per_locality = rows.groupBy("sk_local", "_month").agg(*(F.sum(c).alias(c) for c in measures.values()))
        placed = per_locality.join(names, "sk_local")
    summed = placed.groupBy("municipio", "_month").agg(*_sums(measures))
    # key -1 is alone in month 0
    key = F.when(F.col("_month") > 0, F.col("_month") * 100 + 1).otherwise(-1)
    return summed.select("municipio", month_of_key(key).alias("ano_mes"), *measures)


def refresh_mart(fact: DataFrame, locality: DataFrame, budget: int | None = None) -> DataFrame:
    return by_municipio_month(fact, "sk_data_notificacao", locality, MEASURES, budget)


def mart_differences(mart: DataFrame, fact: DataFrame, locality: DataFrame) -> DataFrame:
    """Rows of the stored mart that a fresh aggregation does not give, and the reverse; both should be 0."""
    fresh = refresh_mart(fact, locality)
    columns = mart.columns
    only_mart = mart.exceptAll(fresh.select(*columns)).agg(F.count("*").alias("only_in_mart"))
    only_base = fresh.select(*columns).exceptAll(mart).agg(F.count("*").alias("only_in_base"))
    sides = only_mart.withColumn("only_in_base", F.lit(0).cast("long")).unionByName(
        only_base.withColumn("only_in_mart", F.lit(0).cast("long"))
    )
    return sides.agg(F.sum("only_in_mart").alias("only_in_mart"), F.sum("only_in_base").alias("only_in_base"))


def drill_across(notifications: DataFrame, exams: DataFrame, locality: DataFrame) -> DataFrame:
    """Both facts side by side on their conformed municipio and month.

    Each fact is summed to the shared grain first; only the small results are joined.
    """
    left = by_municipio_month(
        notifications, "sk_data_notificacao", locality, {"notificacoes": "qtd_notificacao", "confirmados": "flag_confirmado"}
    )
    right = by_municipio_month(exams, "sk_data_coleta", locality, {"exames": "qtd_exames", "positivos": "flag_positivo"})
    joined = left.join(right, ["municipio", "ano_mes"], "full_outer")
    zero = F.lit(0).cast("long")
    measures = ("notificacoes", "confirmados", "exames", "positivos")
    return joined.select("municipio", "ano_mes", *(F.coalesce(m, zero).alias(m) for m in measures))
