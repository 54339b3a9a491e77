"""Data-quality checks and the gate that guards publication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from epidw import domain as d, schemas
from epidw.functions.dates import any_of
from epidw.session import literal_rows

Tables = Mapping[str, DataFrame]


class QualityError(ValueError):
    """Raised by the gate after every check has run; lists all failures."""


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_profile(tables: Tables) -> DataFrame:
    """Unknown members (-1), repeated and missing keys of every table with a primary key.

    Distinct keys are counted exactly, in bitmaps of 32,768 consecutive keys that are
    built before the shuffle: about one bit per row moves, not one key per row. A table
    without rows still gets its line.
    """
    keys = _union(
        tables[table].select(F.lit(table).alias("tabela"), F.col(key).cast("long").alias("_key"))
        for table, key in schemas.PRIMARY_KEYS.items()
    )
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_key"))
    buckets = keys.groupBy("tabela", F.bitmap_bucket_number("_key").alias("_bucket")).agg(
        F.count("*").alias("_rows"),
        F.count_if(F.col("_key") == d.UNKNOWN_KEY).alias("_unknown"),
        F.bitmap_count(bits).alias("_distinct"),
    )
    present = F.col("_bucket").isNotNull()
    found = buckets.groupBy("tabela").agg(
        F.sum("_unknown").alias("membros"),
        F.sum(F.when(present, F.col("_rows") - F.col("_distinct"))).alias("duplicadas"),
        F.sum(F.when(~present, F.col("_rows"))).alias("nulas"),
    )
    columns = T.StructType([T.StructField("tabela", T.StringType()), T.StructField("chave", T.StringType())])
    expected = literal_rows(keys.sparkSession, columns, list(schemas.PRIMARY_KEYS.items()))
    return expected.join(found, "tabela", "left").fillna(0)


def unknown_members(tables: Tables) -> DataFrame:
    """Number of unknown members in each dimension; there should be one."""
    dimensions = {table: tables[table] for table in schemas.DIMENSION_KEYS}
    return _union(
        df.agg(F.count_if(F.col(schemas.DIMENSION_KEYS[table]) == d.UNKNOWN_KEY).alias("membros"))
        .select(F.lit(table).alias("tabela"), "membros")
        for table, df in dimensions.items()
    )


def duplicate_keys(tables: Tables) -> DataFrame:
    """Repeated and missing primary keys; both should be 0."""
    return key_profile(tables).drop("membros")


def orphan_rows(fact: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Number of fact rows whose key is missing from the dimension.

    The fact is reduced to its distinct keys before the anti join, so a frequent key
    travels once, not once per row.
    """
    used = fact.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("_rows"))
    known = dimension.select(F.col(key).alias("_key"))
    return used.join(known, "_key", "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orfaos"))


def foreign_key_orphans(tables: Tables, keys: Iterable[schemas.ForeignKey] = schemas.FOREIGN_KEYS) -> DataFrame:
    """Orphan rows of every foreign key: one pass per fact, all its keys at once."""
    keys = list(keys)
    used = []
    for fact in dict.fromkeys(k.fact for k in keys):
        columns = [k.column for k in keys if k.fact == fact]
        long = tables[fact].select(*(F.col(c).cast("int") for c in columns)).unpivot([], columns, "coluna", "_key")
        used.append(long.groupBy("coluna", "_key").agg(F.count("*").alias("_rows")).withColumn("fato", F.lit(fact)))
    target = F.create_map(*(F.lit(v) for k in keys for v in (f"{k.fact}/{k.column}", k.dimension)))
    named = _union(used).withColumn("dimensao", target[F.concat_ws("/", "fato", "coluna")])
    members = _union(
        tables[table].select(F.lit(table).alias("dimensao"), F.col(schemas.DIMENSION_KEYS[table]).alias("_key"))
        for table in dict.fromkeys(k.dimension for k in keys)
    ).withColumn("_member", F.lit(True))
    checked = named.join(members, ["dimensao", "_key"], "left")
    lost = F.when(F.col("_member").isNull(), F.col("_rows")).otherwise(0)
    return checked.groupBy("fato", "coluna", "dimensao").agg(F.sum(lost).cast("long").alias("orfaos"))


def reconcile(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Row counts of staging and fact, and the summed quantity; all three should agree."""
    staged = staging.agg(F.count("*").alias("n")).select(F.lit("linhas_staging").alias("medida"), "n")
    loaded = fact.agg(
        F.count("*").alias("linhas_fato"), F.coalesce(F.sum("qtd_notificacao"), F.lit(0)).cast("long").alias("soma_quantidade")
    ).unpivot([], ["linhas_fato", "soma_quantidade"], "medida", "n")
    return staged.unionByName(loaded)


def exam_rows(staging: DataFrame, exams: DataFrame) -> DataFrame:
    """Staged notifications with a known result against rows of the exam fact."""
    known = any_of([F.col(c) != d.UNKNOWN for c in ("ResultadoRT_PCR_clean", "ResultadoTesteRapido_clean", "ResultadoSorologia_clean")])
    return staging.agg(F.count_if(known).alias("n")).select(F.lit("staging").alias("medida"), "n").unionByName(
        exams.agg(F.count("*").alias("n")).select(F.lit("exames").alias("medida"), "n")
    )


def missing_required(tables: Tables) -> DataFrame:
    """NULLs in columns declared as always filled, one pass per table."""
    def check(table: str, columns: tuple[str, ...]) -> DataFrame:
        wide = tables[table].agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
        return wide.unpivot([], list(columns), "coluna", "nulas").select(F.lit(table).alias("tabela"), "coluna", "nulas")

    return _union(check(table, columns) for table, columns in schemas.REQUIRED.items())


def schema_differences(tables: Tables) -> list[str]:
    """Tables whose columns or types are not the declared ones (metadata only, no job)."""
    return [
        table for table, declared in schemas.TABLES.items()
        if table in tables
        and [(f.name, f.dataType) for f in tables[table].schema] != [(f.name, f.dataType) for f in declared]
    ]


def quality_report(tables: Tables) -> DataFrame:
    """Every check as (verificacao, situacao, detalhe); situacao is OK or ERRO."""
    staging, fact = tables["stg.notificacao_raw"], tables["dw.fato_notificacao_covid"]

    def rows(found: DataFrame, label: Column, ok: Column, detail: Column) -> DataFrame:
        return found.select(
            label.alias("verificacao"),
            F.when(ok, F.lit("OK")).otherwise(F.lit("ERRO")).alias("situacao"),
            detail.cast("string").alias("detalhe"),
        )

    def equal(found: DataFrame, label: str) -> DataFrame:
        spread = found.agg(F.min("n").alias("low"), F.max("n").alias("high"))
        return rows(spread, F.lit(label), F.col("low") == F.col("high"), F.concat_ws("..", "low", "high"))

    # one pass over the keys of each table serves both the unknown-member and the primary-key check
    keys = key_profile(tables)
    lacks_unknown = F.col("tabela").isin(list(schemas.DIMENSION_KEYS)) & (F.col("membros") == 0)
    clean = (F.col("duplicadas") == 0) & (F.col("nulas") == 0) & ~lacks_unknown
    found = F.concat_ws("/", "membros", "duplicadas", "nulas")
    orphans, required = foreign_key_orphans(tables), missing_required(tables)
    return _union([
        rows(keys, F.concat(F.lit("chave:"), "tabela"), clean, found),
        rows(orphans, F.concat(F.lit("orfaos:"), "fato", F.lit("."), "coluna"), F.col("orfaos") == 0, F.col("orfaos")),
        rows(required, F.concat(F.lit("obrigatoria:"), "tabela", F.lit("."), "coluna"), F.col("nulas") == 0, F.col("nulas")),
        equal(reconcile(staging, fact), "reconciliacao:notificacoes"),
        equal(exam_rows(staging, tables["dw.fato_exame"]), "reconciliacao:exames"),
    ])


def enforce(report: DataFrame, other_failures: Iterable[str] = ()) -> None:
    """Raise :class:`QualityError` naming every failed check. The report has one short row per check."""
    failed = [f"{row.verificacao} ({row.detalhe})" for row in report.filter("situacao <> 'OK'").collect()]
    failed += list(other_failures)
    if failed:
        raise QualityError("load rejected: " + "; ".join(sorted(failed)))
