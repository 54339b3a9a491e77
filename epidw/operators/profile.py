"""Column profiles and value counts of a wide table, one pass each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from epidw import domain as d
from epidw.functions.measures import how_many, rounded_percent


def count_columns(df: DataFrame, tests: Mapping[str, Column], label: str, count: str) -> DataFrame:
    """Count, in one pass, the rows that pass each named test; one output row per test plus the row total."""
    wide = df.agg(F.count("*").alias("_rows"), *(how_many(test).alias(name) for name, test in tests.items()))
    return wide.unpivot(["_rows"], list(tests), label, count)


def _missing_report(df: DataFrame, missing: Callable[[Column], Column]) -> DataFrame:
    tests = {c: missing(F.col(c)) for c in df.columns}
    counted = count_columns(df, tests, "coluna", "nulos")
    return counted.select(
        "coluna", "nulos", rounded_percent(F.col("nulos"), F.col("_rows")).alias("pct_nulo")
    )


def null_report(df: DataFrame) -> DataFrame:
    """Missing values per column, only columns that have some."""
    return _missing_report(df, lambda c: c.isNull()).filter("nulos > 0").orderBy(F.desc("nulos"), "coluna")


def null_or_empty_report(df: DataFrame) -> DataFrame:
    """Missing values and empty strings per column, every column, worst first."""
    return _missing_report(df, lambda c: c.isNull() | (c == "")).orderBy(F.desc("pct_nulo"), "coluna")


def table_profile(df: DataFrame) -> DataFrame:
    """Name, type, row count and present values of every column."""
    kinds = F.create_map(*(F.lit(v) for f in df.schema for v in (f.name, f.dataType.simpleString())))
    counted = count_columns(df, {c: F.col(c).isNotNull() for c in df.columns}, "coluna", "nao_nulos")
    return counted.select("coluna", kinds[F.col("coluna")].alias("tipo"), F.col("_rows").alias("linhas"), "nao_nulos")


def value_counts(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    """Rows per value, missing values left out, most frequent first."""
    present = df.filter(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), column)


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each value among the rows that have one, rarest first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("frequencia"))
    everything = counts.agg(F.sum("frequencia")).scalar()
    share = F.round(F.col("frequencia") * F.lit(100.0) / everything, 2).alias("percentual")
    return counts.select(column, "frequencia", share).orderBy("frequencia", column)


def answers_with_yes(df: DataFrame, columns: Sequence[str], label: str, count: str = "registros") -> DataFrame:
    """Rows answering yes, per indicator column, fewest first."""
    tests = {c: F.col(c) == d.YES for c in columns}
    return count_columns(df, tests, label, count).select(label, count).orderBy(count, label)


def leader(df: DataFrame, key: str, value: str) -> DataFrame:
    """The row with the highest value; ties go to the first key."""
    return df.orderBy(F.desc(value), key).limit(1)
