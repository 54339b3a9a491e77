"""Exploratory analyses of the raw microdata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from epidw import domain as d
from epidw.functions.dates import month_start, strict_date
from epidw.functions.measures import how_many, rounded_percent
from epidw.operators.profile import answers_with_yes, leader, value_counts, value_frequencies


def confirmed(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("Classificacao") == d.CONFIRMED)


def class_frequency(raw: DataFrame) -> DataFrame:
    return value_frequencies(raw, "Classificacao")


def sex_distribution(raw: DataFrame) -> DataFrame:
    return value_frequencies(raw, "Sexo")


def leading_municipio(raw: DataFrame) -> DataFrame:
    return leader(value_counts(raw, "Municipio"), "Municipio", "total")


def leading_age_band(raw: DataFrame) -> DataFrame:
    return leader(value_counts(raw, "FaixaEtaria"), "FaixaEtaria", "total")


def outcomes_confirmed(raw: DataFrame) -> DataFrame:
    """How confirmed cases ended, in one row; an outcome that never occurs is 0."""
    names = ("obitos_covid", "obitos_outras_causas", "cura", "ignorado")
    outcome = F.col("Evolucao")
    counts = (how_many(outcome == value).alias(name) for name, value in zip(names, d.OUTCOMES))
    return confirmed(raw).agg(F.count("*").alias("total_confirmados"), *counts)


def lethality_overall(raw: DataFrame) -> DataFrame:
    counts = outcomes_confirmed(raw)
    rate = rounded_percent(F.col("obitos_covid"), F.col("total_confirmados"))
    return counts.select("total_confirmados", "obitos_covid", rate.alias("taxa_letalidade"))


def comorbidities_in_deaths(raw: DataFrame) -> DataFrame:
    """Comorbidities among deaths whose outcome is spelled exactly as the COVID death label."""
    deaths = raw.filter(F.col("Evolucao") == d.COVID_DEATH)
    return answers_with_yes(deaths, list(d.COMORBIDITIES), "comorbidade", "obitos")


def leading_comorbidity(raw: DataFrame) -> DataFrame:
    return leader(comorbidities_in_deaths(raw), "comorbidade", "obitos")


def monthly_series_strict(raw: DataFrame, date: str = "DataNotificacao") -> DataFrame:
    """Notifications per month where every present date must parse; fails on the first that does not."""
    dated = raw.select(strict_date(F.col(date)).alias("_date")).filter(F.col("_date").isNotNull())
    return dated.groupBy(month_start(F.col("_date")).alias("mes")).agg(F.count("*").alias("total")).orderBy("mes")


def _cases(raw: DataFrame) -> DataFrame:
    """Confirmed cases per municipio and outcome: at most one row a pair."""
    located = confirmed(raw).filter(F.col("Municipio").isNotNull())
    return located.groupBy("Municipio", "Evolucao").agg(F.count("*").alias("casos"))


def outcome_crosstab(raw: DataFrame, n: int = 5) -> DataFrame:
    """Municipios with most confirmed cases by every outcome that occurs among them, 0 where a pair does not occur.

    One scan and one aggregation: the few rows of the top meet in one row, which is unfolded again.
    """
    outcome = F.when(F.col("Evolucao").isNotNull(), F.struct("Evolucao", "casos"))
    by_place = _cases(raw).groupBy("Municipio").agg(
        F.sum("casos").alias("total"), F.map_from_entries(F.collect_list(outcome)).alias("por_evolucao")
    )
    top = by_place.orderBy(F.desc("total"), "Municipio").limit(n)
    folded = top.agg(
        F.collect_list(F.struct("Municipio", "por_evolucao")).alias("linhas"),
        F.array_distinct(F.flatten(F.collect_list(F.map_keys("por_evolucao")))).alias("evolucoes"),
    )
    pairs = folded.select("evolucoes", F.explode("linhas").alias("linha")).select("linha", F.explode("evolucoes").alias("Evolucao"))
    cases = F.coalesce(F.col("linha.por_evolucao")[F.col("Evolucao")], F.lit(0).cast("long"))
    return pairs.select(F.col("linha.Municipio").alias("Municipio"), "Evolucao", cases.alias("casos")).orderBy("Municipio", "Evolucao")


def lethality_of_busiest(raw: DataFrame, n: int = 5) -> DataFrame:
    located = confirmed(raw).filter(F.col("Municipio").isNotNull())
    cases = located.groupBy("Municipio").agg(
        F.count("*").alias("casos"), how_many(F.col("Evolucao") == d.COVID_DEATH).alias("obitos")
    )
    top = cases.orderBy(F.desc("casos"), "Municipio").limit(n)
    return top.withColumn("taxa_letalidade", rounded_percent(F.col("obitos"), F.col("casos")))


def highest_lethality(raw: DataFrame, n: int = 5) -> DataFrame:
    """The most lethal of the municipios with most confirmed cases."""
    return leader(lethality_of_busiest(raw, n), "Municipio", "taxa_letalidade")
