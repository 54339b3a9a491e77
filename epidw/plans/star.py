"""Dashboard panels and BI queries on the warehouse.

The pattern throughout: reduce the fact to one row per surrogate key first, then
join the descriptive attributes. The join then works on a few rows per dimension
member whatever the size of the fact, and no frequent key is ever shuffled row by
row. The mart answers whatever it can.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from epidw import domain as d
from epidw.functions.dates import month_from_label, month_of_key
from epidw.functions.measures import percent, rounded_percent, short_percent_text, total
from epidw.operators.facts import NOTIFICATION
from epidw.operators.mart import MART
from epidw.plans.direct import options

Tables = Mapping[str, DataFrame]
Values = Sequence[str]
PUSHED_KEYS = 10_000


def restrict(fact: DataFrame, dimension: DataFrame, key: str, attribute: str, values: Values) -> DataFrame:
    """Fact rows whose dimension member has one of the values; no values, no restriction.

    A bounded set of keys becomes a literal list that reaches the Parquet scan of the
    fact; a larger one stays a semi join.
    """
    if not values:
        return fact
    members = dimension.filter(F.col(attribute).isin(*values)).select(key)
    keys = [row[0] for row in members.limit(PUSHED_KEYS + 1).collect()]
    if len(keys) <= PUSHED_KEYS:
        return fact.filter(F.col(key).isin(keys))
    return fact.join(members, key, "left_semi")


def notifications(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    fact = restrict(tables[NOTIFICATION], tables["dw.dim_localidade"], "sk_local", "municipio", municipios)
    return restrict(fact, tables[d.CLASS_DIM.table], "sk_class", "classificacao", classes)


def _per_member(fact: DataFrame, dimension: DataFrame, key: str, **measures: str) -> DataFrame:
    """Measures summed per surrogate key, with the attributes of the member."""
    sums = [F.sum(source).cast("long").alias(name) for name, source in measures.items()]
    return fact.groupBy(key).agg(*sums).join(dimension, key)


def _by_attribute(
    fact: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str], measure: str, name: str
) -> DataFrame:
    members = _per_member(fact, dimension.select(key, *attributes), key, **{name: measure})
    return members.groupBy(*attributes).agg(F.sum(name).alias(name))


def _yes_per_indicator(
    fact: DataFrame, dimension: DataFrame, junk: d.JunkDimension, label: str, count: str
) -> DataFrame:
    members = _per_member(fact, dimension, junk.key, _n="qtd_notificacao")
    yes: list[Column] = [
        total(F.when(F.col(attribute) == d.YES, F.col("_n"))).alias(raw) for raw, attribute in junk.attributes.items()
    ]
    return members.agg(*yes).unpivot([], list(junk.attributes), label, count).orderBy(count, label)


def kpis(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    fact = notifications(tables, municipios, classes)
    members = _per_member(fact, tables[d.CLASS_DIM.table], "sk_class", _n="qtd_notificacao")
    status = F.col("classificacao")
    return members.agg(
        total("_n").alias("total"),
        total(F.when(status == d.SUSPECTED, F.col("_n"))).alias("suspeitos"),
        total(F.when(status == d.CONFIRMED, F.col("_n"))).alias("confirmados"),
    )


def class_distribution(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    fact = notifications(tables, municipios, classes)
    counts = _by_attribute(fact, tables[d.CLASS_DIM.table], "sk_class", ["classificacao"], "qtd_notificacao", "total")
    return counts.orderBy(F.desc("total"), "classificacao")


def mart_answers(classes: Values) -> bool:
    """The mart has no classification, so it serves every request that does not filter by one."""
    return not classes


def _mart_rows(tables: Tables, municipios: Values) -> DataFrame:
    rows = tables[MART]
    return rows.filter(F.col("municipio").isin(*municipios)) if municipios else rows


def municipio_totals(tables: Tables, municipios: Values = (), classes: Values = (), use_mart: bool | None = None) -> DataFrame:
    if mart_answers(classes) if use_mart is None else use_mart:
        return _mart_rows(tables, municipios).groupBy("municipio").agg(F.sum("notificacoes").alias("total"))
    fact = notifications(tables, municipios, classes)
    return _by_attribute(fact, tables["dw.dim_localidade"], "sk_local", ["municipio"], "qtd_notificacao", "total")


def top_municipios(
    tables: Tables, municipios: Values = (), classes: Values = (), n: int = 10, use_mart: bool | None = None
) -> DataFrame:
    """Municipios with most notifications; the route is chosen by the filters unless given."""
    return municipio_totals(tables, municipios, classes, use_mart).orderBy(F.desc("total"), "municipio").limit(n)


def age_band(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    fact = notifications(tables, municipios, classes)
    return _by_attribute(
        fact, tables[d.PROFILE_DIM.table], "sk_perfil", ["faixa_etaria"], "qtd_notificacao", "total"
    ).orderBy("faixa_etaria")


def symptoms(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    fact = notifications(tables, municipios, classes)
    return _yes_per_indicator(fact, tables[d.SYMPTOM_DIM.table], d.SYMPTOM_DIM, "sintoma", "registros")


def comorbidities_in_deaths(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    deaths = notifications(tables, municipios, classes).filter("flag_obito_covid = 1")
    return _yes_per_indicator(deaths, tables[d.COMORBIDITY_DIM.table], d.COMORBIDITY_DIM, "comorbidade", "obitos")


def month_totals(tables: Tables, municipios: Values = (), classes: Values = (), use_mart: bool | None = None) -> DataFrame:
    """Notifications per ``ano_mes``, the unknown month included."""
    if mart_answers(classes) if use_mart is None else use_mart:
        return _mart_rows(tables, municipios).groupBy("ano_mes").agg(F.sum("notificacoes").alias("total"))
    month = F.expr("sk_data_notificacao div 100").alias("_month")
    counts = notifications(tables, municipios, classes).groupBy(month).agg(F.sum("qtd_notificacao").alias("total"))
    key = F.when(F.col("_month") > 0, F.col("_month") * 100 + 1).otherwise(d.UNKNOWN_KEY)
    return counts.select(month_of_key(key).alias("ano_mes"), "total")


def monthly_series(
    tables: Tables, municipios: Values = (), classes: Values = (), use_mart: bool | None = None
) -> DataFrame:
    """Notifications per calendar month; rows without a valid date belong to no month."""
    known = month_totals(tables, municipios, classes, use_mart).filter(F.col("ano_mes") != d.UNKNOWN)
    return known.select(month_from_label(F.col("ano_mes")).alias("mes"), "total").orderBy("mes")


def lethality_by_municipio(tables: Tables, municipios: Values = (), classes: Values = (), n: int = 5) -> DataFrame:
    """Confirmed cases, deaths among them and lethality of the municipios with most confirmed cases."""
    confirmed = notifications(tables, municipios, classes).filter("flag_confirmado = 1")
    members = _per_member(
        confirmed, tables["dw.dim_localidade"].select("sk_local", "municipio"), "sk_local",
        casos_confirmados="flag_confirmado", obitos_covid="flag_obito_covid",
    )
    cases = members.groupBy("municipio").agg(
        F.sum("casos_confirmados").alias("casos_confirmados"), F.sum("obitos_covid").alias("obitos_covid")
    )
    rate = percent(F.col("obitos_covid"), F.col("casos_confirmados"))
    return cases.orderBy(F.desc("casos_confirmados"), "municipio").limit(n).select(
        "municipio", "casos_confirmados", "obitos_covid",
        rounded_percent(F.col("obitos_covid"), F.col("casos_confirmados")).alias("taxa_pct"),
        short_percent_text(rate).alias("taxa_letalidade"),
    )


def filter_options(tables: Tables) -> DataFrame:
    """Values to choose from, as (filtro, valor), without the unknown members."""
    municipios = options(tables["dw.dim_localidade"], "municipio", d.UNKNOWN_UPPER)
    classes = options(tables[d.CLASS_DIM.table], "classificacao", d.UNKNOWN)
    return municipios.unionByName(classes).orderBy("filtro", "valor")


def monthly_series_all(tables: Tables) -> DataFrame:
    """Whole series by ``yyyy-MM`` label, unknown included."""
    return month_totals(tables).withColumnRenamed("total", "notificacoes").orderBy("ano_mes")


def confirmed_map(tables: Tables) -> DataFrame:
    counts = tables[MART].groupBy("municipio").agg(F.sum("confirmados").alias("confirmados"))
    return counts.orderBy(F.desc("confirmados"), "municipio")


def age_pyramid(tables: Tables) -> DataFrame:
    """Deaths by age band and sex."""
    return _by_attribute(
        tables[NOTIFICATION], tables[d.PROFILE_DIM.table], "sk_perfil", ["faixa_etaria", "sexo"],
        "flag_obito_covid", "obitos",
    ).orderBy("faixa_etaria", "sexo")


def first_comorbidity(labels: Sequence[tuple[str, str]] = d.COMORBIDITY_LABELS) -> Column:
    """Label of the first comorbidity present, in order of priority; NULL without any."""
    return F.coalesce(*(F.when(F.col(attribute) == d.YES, F.lit(label)) for attribute, label in labels))


def top_comorbidities(tables: Tables, n: int = 5) -> DataFrame:
    """Deaths by leading comorbidity. Each death counts once, unlike in the per-indicator panel."""
    members = _per_member(
        tables[NOTIFICATION], tables[d.COMORBIDITY_DIM.table], "sk_como", obitos="flag_obito_covid"
    )
    labelled = members.withColumn("comorbidade", first_comorbidity()).filter(F.col("comorbidade").isNotNull())
    counts = labelled.groupBy("comorbidade").agg(F.sum("obitos").alias("obitos"))
    return counts.orderBy(F.desc("obitos"), "comorbidade").limit(n)


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
