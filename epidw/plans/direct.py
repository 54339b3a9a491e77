"""Dashboard panels straight from the raw microdata.

Values are compared and grouped exactly as they stand in the file, and rows
without a value do not show up as a group. Each panel reads only its columns and
hands its filters to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from epidw import domain as d
from epidw.functions.dates import month_start, try_date
from epidw.functions.measures import (
    has_covid_death_loose, how_many, padded_percent_text, percent, rounded_percent,
)
from epidw.operators.profile import answers_with_yes, value_counts

Values = Sequence[str]


def selected(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    """Rows of the chosen municipios and classifications; an empty choice filters nothing."""
    for column, values in (("Municipio", municipios), ("Classificacao", classes)):
        if values:
            raw = raw.filter(F.col(column).isin(*values))
    return raw


def kpis(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    status = F.col("Classificacao")
    return selected(raw, municipios, classes).agg(
        F.count("*").alias("total"),
        how_many(status == d.SUSPECTED).alias("suspeitos"),
        how_many(status == d.CONFIRMED).alias("confirmados"),
    )


def class_distribution(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    return value_counts(selected(raw, municipios, classes), "Classificacao")


def top_municipios(raw: DataFrame, municipios: Values = (), classes: Values = (), n: int = 10) -> DataFrame:
    return value_counts(selected(raw, municipios, classes), "Municipio").limit(n)


def age_band(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    return value_counts(selected(raw, municipios, classes), "FaixaEtaria").orderBy("FaixaEtaria")


def symptoms(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    return answers_with_yes(selected(raw, municipios, classes), list(d.SYMPTOMS), "sintoma")


def comorbidities_in_deaths(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    deaths = selected(raw, municipios, classes).filter(has_covid_death_loose(F.col("Evolucao")))
    return answers_with_yes(deaths, list(d.COMORBIDITIES), "comorbidade", "obitos")


def monthly_series(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    notified = selected(raw, municipios, classes).select(try_date(F.col("DataNotificacao")).alias("_date"))
    dated = notified.dropna(subset=["_date"])
    return dated.groupBy(month_start(F.col("_date")).alias("mes")).agg(F.count("*").alias("total")).orderBy("mes")


def lethality_by_municipio(raw: DataFrame, municipios: Values = (), classes: Values = (), n: int = 5) -> DataFrame:
    """Confirmed cases, deaths and lethality of the municipios with most confirmed cases, in one pass."""
    confirmed = selected(raw, municipios, classes).filter(
        (F.col("Classificacao") == d.CONFIRMED) & F.col("Municipio").isNotNull()
    )
    cases = confirmed.groupBy("Municipio").agg(
        F.count("*").alias("casos_confirmados"),
        how_many(has_covid_death_loose(F.col("Evolucao"))).alias("obitos_covid"),
    )
    rate = percent(F.col("obitos_covid"), F.col("casos_confirmados"))
    return cases.orderBy(F.desc("casos_confirmados"), "Municipio").limit(n).select(
        "Municipio", "casos_confirmados", "obitos_covid",
        rounded_percent(F.col("obitos_covid"), F.col("casos_confirmados")).alias("taxa_pct"),
        padded_percent_text(rate).alias("taxa_letalidade"),
    )


def filter_options(raw: DataFrame) -> DataFrame:
    """Values to choose from, as (filtro, valor)."""
    return options(raw, "Municipio").unionByName(options(raw, "Classificacao")).orderBy("filtro", "valor")


def options(rows: DataFrame, column: str, hidden: str | None = None) -> DataFrame:
    value = F.col(column)
    shown = value.isNotNull() if hidden is None else value != hidden
    return rows.filter(shown).select(F.lit(column.lower()).alias("filtro"), value.alias("valor")).distinct()


PANELS = {
    "kpis": kpis,
    "class_distribution": class_distribution,
    "top_municipios": top_municipios,
    "age_band": age_band,
    "symptoms": symptoms,
    "comorbidities_in_deaths": comorbidities_in_deaths,
    "monthly_series": monthly_series,
    "lethality_by_municipio": lethality_by_municipio,
}
