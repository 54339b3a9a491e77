"""The notification fact and the exam fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from epidw import domain as d, schemas
from epidw.functions.dates import any_of, date_key, day_gap
from epidw.functions.measures import any_positive, flag, has_covid_death
from epidw.operators.keys import contiguous_ranges, repeat_numbered
from epidw.operators.lookup import lookup, measure, with_salt
from epidw.operators.scd2 import lookup_as_of

NOTIFICATION = "dw.fato_notificacao_covid"
EXAM = "dw.fato_exame"


def declared(table: str, columns: Mapping[str, Column]) -> list[Column]:
    """The columns in the order and with the types of the declared table."""
    return [columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.TABLES[table]]


def notification_flags() -> dict[str, Column]:
    outcome = F.col("Evolucao_clean")
    return {
        "flag_confirmado": flag(F.col("Classificacao_clean") == d.CONFIRMED),
        "flag_obito_covid": flag(has_covid_death(outcome)),
        "flag_internado": flag(F.col(d.HOSPITALISED) == d.YES),
        "flag_cura": flag(outcome == d.CURED),
    }


def notification_gaps() -> dict[str, Column]:
    notified = F.col("DataNotificacao_date")
    return {
        "dias_notif_encerramento": day_gap(notified, F.col("DataEncerramento_date")),
        "dias_notif_obito": day_gap(notified, F.col("DataObito_date")),
    }


def build_notification_fact(
    staging: DataFrame, dimensions: Mapping[str, DataFrame], budget: int | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """One fact row per staged notification, and the staged columns in ``carry`` as they are.

    The six date keys are computed, not joined. The other keys are left lookups into
    dimensions that are broadcast while they fit the budget, so the load is one
    map-only stage over the staging table.
    """
    locality = dimensions["dw.dim_localidade"]
    measure(locality, *(dimensions[junk.table] for junk in d.JUNK_DIMENSIONS))
    rows = lookup_as_of(
        with_salt(staging),
        locality,
        {d.clean_name(raw): name for raw, name in d.PLACE.items()},
        "DataNotificacao_date",
        "sk_local",
        budget,
    )
    for junk in d.JUNK_DIMENSIONS:
        rows = lookup(rows, dimensions[junk.table], junk.staged(), junk.key, budget=budget)
    keys = ["sk_local", *(junk.key for junk in d.JUNK_DIMENSIONS)]
    columns = {
        **{role: date_key(F.col(date)) for role, date in d.DATE_ROLES.items()},
        "sk_data_Campanhas": F.lit(None),
        **{key: F.coalesce(F.col(key), F.lit(d.UNKNOWN_KEY)) for key in keys},
        **notification_flags(),
        "idade_anos": F.col("Idade_clean"),
        **notification_gaps(),
        "qtd_notificacao": F.lit(1),
    }
    return rows.select(*declared(NOTIFICATION, columns), *carry)


def has_known_result(default: str = d.UNKNOWN) -> Column:
    return any_of([F.col(a) != default for a in d.RESULT_ATTRIBUTES])


def build_exam_fact(notifications: DataFrame, tests: DataFrame) -> DataFrame:
    """One row per notification with at least one known result (not one per single exam).

    Whether a notification qualifies, and whether it is positive, depends only on its
    member of the test dimension, so the exam fact follows from four key columns of
    the notification fact. Rows that agree in them are identical; they are counted
    before anything is shuffled, numbered as a block, and unfolded at the end. The
    numbering is a function of the data alone: reruns give the same table.
    """
    grain = ["sk_data_coleta", "sk_local", "sk_perfil", "sk_teste"]
    counted = notifications.groupBy(*grain).agg(F.count("*").alias("_rows"))
    qualifying = tests.filter(has_known_result()).select(
        "sk_teste", flag(any_positive([F.col(a) for a in d.RESULT_ATTRIBUTES])).alias("flag_positivo")
    )
    exams = counted.join(qualifying, "sk_teste")
    blocks = contiguous_ranges(exams, [*grain, "flag_positivo"], F.col("_rows"), "_first")
    rows = repeat_numbered(blocks, "_rows", "_first", "sk_fato_exame")
    columns = {
        **{c: F.col(c) for c in ("sk_fato_exame", *grain, "flag_positivo")},
        "sk_data_resultado": F.lit(d.UNKNOWN_KEY),
        "qtd_exames": F.lit(1),
        "dias_coleta_result": F.lit(None),
    }
    return rows.select(*declared(EXAM, columns))


def dates_by_join(staging: DataFrame, calendar: DataFrame) -> DataFrame:
    """The six date keys by role-playing left joins; reference form of ``date_key``."""
    days = F.broadcast(calendar.select("sk_tempo", "data").filter(F.col("data").isNotNull()))
    rows = staging.select(*d.DATE_ROLES.values())
    for role, date in d.DATE_ROLES.items():
        side = days.select(F.col("sk_tempo").alias(role), F.col("data").alias(f"_{role}"))
        rows = rows.join(side, F.col(date) == F.col(f"_{role}"), "left").drop(f"_{role}")
    return rows.select(*(F.coalesce(role, F.lit(d.UNKNOWN_KEY)).alias(role) for role in d.DATE_ROLES))


def dates_by_key(staging: DataFrame) -> DataFrame:
    return staging.select(*(date_key(F.col(date)).alias(role) for role, date in d.DATE_ROLES.items()))
