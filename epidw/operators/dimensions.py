"""Builders of the calendar, locality and junk dimensions, and the snowflaked locality."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from epidw import domain as d, schemas
from epidw.functions.dates import all_of, date_key, pick_label
from epidw.functions.text import remove_accents
from epidw.operators.keys import contiguous_ids
from epidw.operators.lookup import fits_broadcast
from epidw.operators.scd2 import apply_changes, open_version
from epidw.session import literal_rows


def unknown_member(spark: SparkSession, table: str, **values) -> DataFrame:
    """One row with key -1; text columns carry the unknown label unless given."""
    schema = schemas.TABLES[table]
    key = schemas.DIMENSION_KEYS.get(table, schema.names[0])
    row = []
    for field in schema:
        if field.name == key:
            row.append(d.UNKNOWN_KEY)
        elif field.name in values:
            row.append(values[field.name])
        else:
            row.append(d.UNKNOWN if field.dataType.simpleString() == "string" else None)
    return literal_rows(spark, schema, [tuple(row)])


def _declared(df: DataFrame, table: str) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schemas.TABLES[table]))


def build_date_dimension(
    spark: SparkSession,
    start: dt.date = d.CALENDAR_START,
    end: dt.date = d.CALENDAR_END,
    months: Sequence[str] = d.MONTHS,
    weekdays: Sequence[str] = d.WEEKDAYS,
) -> DataFrame:
    """One row per day plus the unknown member. The week is the ISO week."""
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("data"))
    day = F.col("data")
    calendar = days.select(
        date_key(day, start, end).alias("sk_tempo"),
        day,
        F.dayofmonth(day).alias("dia"),
        F.month(day).alias("mes"),
        F.year(day).alias("ano"),
        F.quarter(day).alias("trimestre"),
        pick_label(F.month(day), tuple(months)).alias("nome_mes"),
        pick_label(F.weekday(day) + 1, tuple(weekdays)).alias("dia_semana"),
        F.weekofyear(day).alias("semana_epidemiologica"),
        F.date_format(day, "yyyy-MM").alias("ano_mes"),
    )
    unknown = unknown_member(spark, "dw.dim_tempo", dia=0, mes=0, ano=0, trimestre=0, semana_epidemiologica=0)
    # the number of days is fixed by the arguments; one small file serves readers best
    return unknown.unionByName(_declared(calendar, "dw.dim_tempo")).coalesce(1)


def region_lookup(
    spark: SparkSession,
    regions: Mapping[tuple[str, str], Sequence[str]] = d.REGIONS,
    populations: Mapping[str, int] = d.POPULATIONS,
) -> DataFrame:
    """municipio (without accents) -> region, macro-region, inhabitants; one row per configured municipio."""
    regional = {m: region for region, members in regions.items() for m in members}
    rows = [
        (m, *regional.get(m, (None, None)), d.HOME_STATE if m in regional else None, populations.get(m))
        for m in dict.fromkeys([*regional, *populations])
    ]
    names = ("_plain", "regiao_es", "macrorregiao", "uf")
    schema = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("populacao_municipio", T.IntegerType())])
    return literal_rows(spark, schema, rows)


def with_region(localities: DataFrame, municipio: str = "municipio", lookup: DataFrame | None = None) -> DataFrame:
    """Add uf, region, macro-region and inhabitants; a municipio outside the table gets the defaults."""
    if lookup is None:
        lookup = F.broadcast(region_lookup(localities.sparkSession))
    elif fits_broadcast(lookup):
        lookup = F.broadcast(lookup)
    known = localities.withColumn("_plain", remove_accents(F.col(municipio)))
    # the configured table has a fixed number of rows, far below any broadcast limit; another one is measured
    joined = known.join(lookup, "_plain", "left").drop("_plain")
    elsewhere = F.lit(d.ELSEWHERE)
    return joined.withColumns({
        "uf": F.coalesce("uf", elsewhere),
        "regiao_es": F.coalesce("regiao_es", elsewhere),
        "macrorregiao": F.coalesce("macrorregiao", elsewhere),
        "populacao_municipio": F.coalesce("populacao_municipio", F.lit(d.DEFAULT_POPULATION)),
    })


def build_locality_base(staging: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Distinct (municipio, bairro) with their region, each in one open version; unknown member included."""
    spark = staging.sparkSession
    pairs = staging.select(*(F.col(d.clean_name(raw)).alias(name) for raw, name in d.PLACE.items())).distinct()
    known = pairs.filter(~all_of([F.col(name) == d.UNKNOWN_UPPER for name in d.PLACE.values()]))
    numbered = contiguous_ids(known, ["municipio", "bairro"], "sk_local")
    described = with_region(numbered, lookup=lookup).withColumns({
        **open_version(d.CALENDAR_START),
        "nk_municipio_bairro": F.concat_ws("|", "municipio", "bairro"),
    })
    texts = dict.fromkeys(("municipio", "bairro", "uf", "regiao_es", "macrorregiao"), d.UNKNOWN_UPPER)
    unknown = unknown_member(
        spark, "dw.dim_localidade", **texts, populacao_municipio=0, data_inicio=d.CALENDAR_START, flag_atual=True,
        nk_municipio_bairro=f"{d.UNKNOWN_UPPER}|{d.UNKNOWN_UPPER}",
    )
    return unknown.unionByName(_declared(described, "dw.dim_localidade"))


def build_locality_dimension(
    base: DataFrame,
    populations: Mapping[str, int] = d.POPULATION_CHANGES,
    since: dt.date = d.POPULATION_CHANGE_DATE,
) -> DataFrame:
    """The base localities after the population changes: old versions closed, new ones appended."""
    locality = schemas.TABLES["dw.dim_localidade"]
    changed = T.StructType([locality["municipio"], locality["populacao_municipio"]])
    changes = literal_rows(base.sparkSession, changed, list(populations.items()))
    return apply_changes(base, changes, ["municipio"], since, "sk_local", ["municipio", "bairro"])


def build_junk_dimension(staging: DataFrame, dimension: d.JunkDimension) -> DataFrame:
    """Distinct attribute tuples with contiguous keys; the all-unknown tuple is the unknown member."""
    names = list(dimension.attributes.values())
    tuples = staging.select(*(F.col(c).alias(a) for c, a in dimension.staged().items())).distinct()
    known = tuples.filter(~all_of([F.col(a) == d.UNKNOWN for a in names]))
    numbered = contiguous_ids(known, names, dimension.key)
    return unknown_member(staging.sparkSession, dimension.table).unionByName(_declared(numbered, dimension.table))


def build_snowflake_municipio(locality: DataFrame) -> DataFrame:
    """Municipio level of the normalized locality."""
    names = ["municipio", "regiao_es", "macrorregiao", "uf"]
    distinct = locality.filter(F.col("sk_local") != d.UNKNOWN_KEY).select(*names).distinct()
    numbered = contiguous_ids(distinct, names, "sk_municipio")
    unknown = unknown_member(locality.sparkSession, "dw.dim_municipio", **dict.fromkeys(names, d.UNKNOWN_UPPER))
    return unknown.unionByName(_declared(numbered, "dw.dim_municipio"))


def build_snowflake_bairro(locality: DataFrame, municipio: DataFrame) -> DataFrame:
    """Bairro level, each row pointing at its municipio."""
    names = ["municipio", "regiao_es", "macrorregiao", "uf"]
    distinct = locality.filter(F.col("sk_local") != d.UNKNOWN_KEY).select("bairro", *names).distinct()
    numbered = contiguous_ids(distinct, ["bairro", *names], "sk_bairro").join(municipio, names)
    unknown = unknown_member(
        locality.sparkSession, "dw.dim_bairro", bairro=d.UNKNOWN_UPPER, sk_municipio=d.UNKNOWN_KEY
    )
    return unknown.unionByName(_declared(numbered, "dw.dim_bairro"))
