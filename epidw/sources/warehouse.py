"""Versioned Parquet warehouse: every load writes its own version, readers see published ones only."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from epidw import schemas
from epidw.session import shuffles_dropped
from epidw.sources import files

_PUBLISHED = "published"
_STAMP = "%Y%m%dT%H%M%S%f"


class PublicationConflict(RuntimeError):
    """Another load published since this one began."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _publications(spark: SparkSession, root: str) -> DataFrame | None:
    """``version`` and ``publication``, counted from 1, of all publications; None if there are none."""
    try:
        return spark.read.schema("version string, publication long").parquet(f"{root.rstrip('/')}/{_PUBLISHED}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def _latest(spark: SparkSession, root: str) -> tuple[str | None, int]:
    log = _publications(spark, root)
    found = log.agg(F.max_by("version", "publication"), F.max("publication")).first() if log is not None else (None, None)
    return found[0], found[1] or 0


class Warehouse(Mapping[str, DataFrame]):
    """Tables of one version under ``<root>/versions/<version>/<namespace>/<table>``.

    Behaves as a mapping from table name (``dw.dim_tempo``) to a lazily read frame.
    """

    def __init__(self, spark: SparkSession, root: str, version: str, publication: int = 0):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version
        #: the publication that was the latest when this version was begun or opened
        self.publication = publication
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def new_version(cls, spark: SparkSession, root: str) -> Warehouse:
        return cls(spark, root, f"{_now().strftime(_STAMP)}-{uuid.uuid4().hex[:8]}", _latest(spark, root)[1])

    @classmethod
    def open(cls, spark: SparkSession, *roots: str) -> Warehouse:
        """The latest published version at the first root that has one."""
        for root in roots:
            version, publication = _latest(spark, root)
            if version is not None:
                return cls(spark, root, version, publication)
        raise FileNotFoundError(f"no published warehouse at any of: {', '.join(roots)}; run the load first")

    def path(self, table: str) -> str:
        return f"{self.root}/versions/{self.version}/{table.replace('.', '/')}"

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Full refresh of one table; declared tables take their declared columns and types."""
        declared = schemas.TABLES.get(table)
        if declared is not None:
            df = df.select(*(F.col(f.name).cast(f.dataType) for f in declared))
        with shuffles_dropped(self.spark):
            df.write.mode("overwrite").parquet(self.path(table))
        self._frames[table] = self.spark.read.schema(declared or df.schema).parquet(self.path(table))
        return self._frames[table]

    def publish(self) -> None:
        """Make this version the one readers open, if none has been published since it was begun.

        The publication that follows the one this load began from is claimed by renaming a folder, which only one load
        can do; the other gets a :class:`PublicationConflict` and readers keep the first.
        """
        pending = f"{self.root}/pending/{self.version}"
        row = self.spark.createDataFrame([(self.version,)], "version string")
        row.coalesce(1).write.mode("overwrite").parquet(pending)
        following = self.publication + 1
        if not files.move_if_free(self.spark, pending, f"{self.root}/{_PUBLISHED}/publication={following}"):
            files.delete(self.spark, pending)
            raise PublicationConflict(f"publication {following} of {self.root} was made by another load")
        self.publication = following

    def _is_published(self) -> bool:
        log = _publications(self.spark, self.root)
        return log is not None and not log.filter(F.col("version") == self.version).isEmpty()

    @contextmanager
    def lease(self, duration: dt.timedelta = dt.timedelta(days=1)) -> Iterator[Warehouse]:
        """Keep a published version from being expired while it is read, for ``duration`` at most."""
        until = (_now() + duration).strftime(_STAMP)
        path = f"{self.root}/leases/{self.version}~{until}~{uuid.uuid4().hex}"
        files.create_empty(self.spark, path)
        try:
            # an expiry that has not seen the lease has taken the version off the log before
            if not self._is_published():
                raise FileNotFoundError(f"version {self.version} has expired")
            yield self
        finally:
            files.delete(self.spark, path)

    @staticmethod
    def expire(spark: SparkSession, root: str, keep: int = 3, grace: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
        """Delete versions, published or given up, and return their names.

        The ``keep`` latest publications, versions begun within ``grace`` (they may be loading still) and leased
        versions stay. A version leaves the log before the leases are read and its tables are deleted.
        """
        root = root.rstrip("/")
        log = _publications(spark, root)
        rows = sorted((r["publication"], r["version"]) for r in log.collect()) if log is not None else []  # one small row a version
        newest = {version for _, version in rows[-max(1, keep):]}
        oldest_loading = (_now() - grace).strftime(_STAMP)
        old = [v for v in files.children(spark, f"{root}/versions") if v not in newest and v < oldest_loading]
        for publication, version in rows:
            if version in old:
                files.delete(spark, f"{root}/{_PUBLISHED}/publication={publication}")
        now = _now().strftime(_STAMP)
        leases = [name.split("~") for name in files.children(spark, f"{root}/leases")]
        held = {lease[0] for lease in leases if len(lease) == 3 and lease[1] > now}
        gone = [version for version in old if version not in held]
        for version in gone:
            files.delete(spark, f"{root}/versions/{version}")
        return gone

    def create_views(self) -> None:
        """Temporary views of the tables there are, for SQL users, named like them with ``_`` for the dot."""
        for table in schemas.TABLES:
            try:
                Warehouse.__getitem__(self, table).createOrReplaceTempView(table.replace(".", "_"))
            except KeyError:
                continue

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._frames:
            try:
                reader = self.spark.read
                if table in schemas.TABLES:
                    reader = reader.schema(schemas.TABLES[table])
                self._frames[table] = reader.parquet(self.path(table))
            except AnalysisException as error:
                if "PATH_NOT_FOUND" not in str(error):
                    raise
                raise KeyError(table) from error
        return self._frames[table]

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)
