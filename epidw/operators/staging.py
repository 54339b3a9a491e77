"""Staging: one narrow pass that cleans and types the raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from epidw import domain as d
from epidw.functions.dates import first_collection_date, try_date
from epidw.functions.measures import parse_age_years
from epidw.functions.text import clean_text, clean_upper


def build_staging(raw: DataFrame, carry: Sequence[str] = (d.HOSPITALISED,)) -> DataFrame:
    """Typed dates, cleaned text, parsed age, and the raw columns in ``carry`` as they are.

    Only the hospitalisation answer is read in its raw form further on.
    """
    dates = {d.date_name(c): try_date(F.col(c)) for c in d.PLAIN_DATES}
    dates["DataColeta_date"] = first_collection_date(*map(F.col, d.COLLECTION_DATES))
    places = {d.clean_name(c): clean_upper(F.col(c)) for c in d.PLACE}
    texts = {d.clean_name(raw_name): clean_text(F.col(raw_name)) for j in d.JUNK_DIMENSIONS for raw_name in j.attributes}
    columns = {
        **{name: dates[name] for name in d.DATE_ROLES.values()},
        **places,
        **texts,
        "Idade_clean": parse_age_years(F.col(d.AGE)),
        **{c: F.col(c) for c in carry},
    }
    return raw.select(*(column.alias(name) for name, column in columns.items()))
