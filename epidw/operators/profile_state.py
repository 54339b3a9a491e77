"""Column profiles as mergeable states: counts per file that are stored once and added up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from epidw.functions.measures import how_many, rounded_percent

#: what identifies the content of a file
FILE = ("arquivo", "modificado", "bytes")
COUNTS = ("linhas", "nulos", "vazios")
_SCHEMA = "arquivo string, modificado timestamp, bytes long, coluna string, linhas long, nulos long, vazios long"


def _states(df: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """Rows, missing values and empty strings of each of ``columns``, in one pass, for each group of ``by``."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    counts, parts = [F.count("*").alias("_rows")], []
    for i, name in enumerate(columns):
        value = F.col(f"`{name}`")
        empty = value == "" if name in texts else F.lit(False)
        counts += [how_many(value.isNull()).cast("long").alias(f"_n{i}"), how_many(empty).cast("long").alias(f"_e{i}")]
        parts.append(F.struct(
            F.lit(name).alias("coluna"), F.col("_rows").alias("linhas"), F.col(f"_n{i}").alias("nulos"), F.col(f"_e{i}").alias("vazios")
        ))
    return df.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*parts)))


def state_of(df: DataFrame) -> DataFrame:
    """``coluna`` and the counts of a whole frame; an empty one has zeros."""
    return _states(df, df.columns)


def file_states(df: DataFrame) -> DataFrame:
    """The state of each file of a file scan, beside the file's name, time and size."""
    # names of a scan are encoded as in an address, those of a listing are not
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    known = (_plain(name), F.col("_metadata.file_modification_time"), F.col("_metadata.file_size"))
    named = df.select("*", *(value.alias(f"_{column}") for value, column in zip(known, FILE)))
    states = _states(named, df.columns, *(f"_{c}" for c in FILE))
    return states.withColumnsRenamed({f"_{c}": c for c in FILE})


def _plain(path: Column) -> Column:
    return F.replace(path, F.lit(":///"), F.lit(":/"))


def merge(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One state from several; the order of merging makes no difference."""
    together = first.select("coluna", *COUNTS)
    for other in others:
        together = together.unionByName(other.select("coluna", *COUNTS))
    return together.groupBy("coluna").agg(*(F.sum(c).alias(c) for c in COUNTS))


def _report(state: DataFrame, missing: Column) -> DataFrame:
    return state.select("coluna", missing.alias("nulos"), rounded_percent(missing, F.col("linhas")).alias("pct_nulo"))


def null_report(state: DataFrame) -> DataFrame:
    """Missing values per column from a state, only columns that have some."""
    return _report(state, F.col("nulos")).filter("nulos > 0").orderBy(F.desc("nulos"), "coluna")


def null_or_empty_report(state: DataFrame) -> DataFrame:
    """Missing values and empty strings per column from a state, worst first."""
    return _report(state, F.col("nulos") + F.col("vazios")).orderBy(F.desc("pct_nulo"), "coluna")


class ProfileStore:
    """States of the Parquet files of a folder, kept under ``root``: a new or changed file costs a scan of that file."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _listed(self, source: str) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(source)
        return files.select("path", _plain(F.col("path")).alias("arquivo"), F.col("modificationTime").alias("modificado"), F.col("length").alias("bytes"))

    def _stored(self) -> DataFrame:
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.root)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], _SCHEMA)

    def update(self, source: str) -> int:
        """Store the states of the files that have none yet; returns how many files were read."""
        fresh = self._listed(source).join(self._stored().select(*FILE).distinct(), list(FILE), "left_anti")
        paths = [row["path"] for row in fresh.select("path").collect()]  # names of new files
        if paths:
            file_states(self.spark.read.parquet(*paths)).coalesce(1).write.mode("append").parquet(self.root)
        return len(paths)

    def state(self, source: str) -> DataFrame:
        """The state of all files that are in the folder now, each counted once."""
        present = self._stored().join(self._listed(source).select(*FILE), list(FILE), "left_semi")
        return merge(present.dropDuplicates([*FILE, "coluna"]))
