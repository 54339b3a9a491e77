"""Ages, flags, ratios and percentages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from epidw import domain as d
from epidw.functions.dates import any_of


def parse_age_years(text: Column) -> Column:
    """Age in completed years from free text.

    A bare number is the age; ``.. anos ..`` gives its first number; ages in months
    or days are 0; other text gives its first number. What does not fit a SMALLINT
    is NULL, so one bad row cannot stop a load.
    """
    first_number = F.regexp_extract(text, "([0-9]+)", 1).try_cast("smallint")
    return (
        F.when(text.rlike("^[0-9]+$"), text.try_cast("smallint"))
        .when(text.contains("ano"), first_number)
        .when(text.contains("mes") | text.contains("dia"), F.lit(0).cast("smallint"))
        .otherwise(first_number)
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0).cast("smallint")


def has_covid_death(outcome: Column) -> Column:
    return outcome.contains(d.COVID_DEATH_MARK)


def has_covid_death_loose(outcome: Column) -> Column:
    """Spelling used on raw rows: the accented initial is left out; a missing outcome is no death."""
    return F.coalesce(outcome.contains(d.COVID_DEATH_LOOSE_MARK), F.lit(False))


def any_positive(results: list[Column]) -> Column:
    return any_of([result == d.POSITIVE for result in results])


def how_many(condition: Column) -> Column:
    """Number of rows that satisfy the condition, 0 on an empty input."""
    return F.count_if(condition)


def total(measure: Column | str) -> Column:
    """Sum that is 0 rather than NULL on an empty input."""
    return F.coalesce(F.sum(measure).cast("long"), F.lit(0).cast("long"))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, 0 when there is no whole."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def rounded_percent(part: Column, whole: Column) -> Column:
    return F.round(percent(part, whole), 2)


def padded_percent_text(value: Column) -> Column:
    """Two decimals and a percent sign."""
    return F.format_string("%.2f%%", F.round(value, 2))


def short_percent_text(value: Column) -> Column:
    """Rounded to two decimals, without padding zeros."""
    return F.concat(F.round(value, 2).cast("string"), F.lit("%"))
