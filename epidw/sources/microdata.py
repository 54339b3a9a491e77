"""Reading and converting the raw notification microdata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from epidw import schemas


# fixed values: spellings of "no value" that the usual CSV tooling of data analysts reads as missing
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_microdata_csv(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    schema: T.StructType | None = None,
    missing: Sequence[str] = MISSING,
    multi_line: bool | None = None,
) -> DataFrame:
    """Delimited text with a header line; every column stays text, ``missing`` spellings become NULL.

    Without ``schema`` the names come from the header of the file (one line is
    read); types are never inferred, since one column mixes numbers and words.
    Quotes inside quoted fields are doubled. Fields with line breaks need
    ``multi_line``, which keeps a file from being split; unless it is given, one
    scan of the lines finds out whether any file has such a field.
    """
    if multi_line is None:
        multi_line = has_broken_lines(spark, path)
    reader = spark.read.options(sep=sep, header=True, encoding=encoding, quote='"', escape='"', multiLine=multi_line)
    if schema is not None:
        # columns are matched by position, so a header in another order must not pass silently
        reader = reader.schema(schema).option("enforceSchema", False)
    read = reader.csv(path)
    return read.select(*(F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in read.columns))


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a line opens a quoted field that it does not close: it then has an odd number of quotes."""
    lines = spark.read.text(path)
    return not lines.filter((F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1).isEmpty()


def csv_to_parquet(spark: SparkSession, source: str, target: str, **options) -> None:
    """Convert the delimited file to Parquet, column for column."""
    read_microdata_csv(spark, source, **options).write.mode("overwrite").parquet(target)


def read_microdata(spark: SparkSession, *candidates: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet microdata from the first candidate path that exists, optionally only some columns."""
    for path in candidates:
        try:
            found = spark.read.parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        return found.select(*columns) if columns else found
    raise FileNotFoundError(f"no microdata at any of: {', '.join(candidates)}")


def has_declared_columns(df: DataFrame) -> bool:
    """Whether the frame carries every raw column the warehouse load needs."""
    return set(schemas.RAW.names) <= set(df.columns)
