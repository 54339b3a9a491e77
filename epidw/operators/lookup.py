"""Left lookups of surrogate keys: broadcast behind a size check, salted shuffle beyond it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, functions as F, types as T

from epidw.functions.dates import all_of

BROADCAST_BUDGET = 64 * 1024 * 1024
SALTS = 32
_SALT = "_salt"


_measured: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def _bytes(df: DataFrame) -> DataFrame:
    """One row: size of the values of a frame (text by its length, other values as 8 bytes)."""
    width = F.lit(8 * len(df.columns))
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes"))


def measure(*frames: DataFrame) -> list[int]:
    """Measured sizes, all missing ones in a single job; a frame is measured once."""
    missing = [df for df in dict.fromkeys(frames) if df not in _measured]
    if missing:
        sizes = reduce(
            DataFrame.unionByName, (_bytes(df).withColumn("position", F.lit(i)) for i, df in enumerate(missing))
        )
        for row in sizes.collect():
            _measured[missing[row.position]] = row.bytes
    return [_measured[df] for df in frames]


def fits_broadcast(df: DataFrame, budget: int | None = None) -> bool:
    return measure(df)[0] <= (BROADCAST_BUDGET if budget is None else budget)


def with_salt(rows: DataFrame) -> DataFrame:
    """Attach a spreading number; call it on a file scan, where it repeats exactly on a task retry.

    The number does not depend on the row's values, so even a third of all rows
    being copies of one another spreads evenly. Pruned from the plan when unused.
    """
    return rows.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    key: str,
    also: Callable[[Callable[[str], Column]], Column] | None = None,
    needs: tuple[str, ...] = (),
    budget: int | None = None,
) -> DataFrame:
    """Left join that adds ``key`` from the dimension member whose attributes match.

    ``on`` maps row columns to dimension attributes; ``also`` may add a residual
    condition over the attributes named in ``needs``. While the dimension fits the
    budget it is broadcast and the rows do not move. Beyond it, every dimension row
    is copied once per salt and rows that were salted at the scan are shuffled on
    attributes plus salt; rows without a salt take a plain join, whose skewed
    partitions adaptive execution splits.
    """
    name = lambda attribute: f"_dim_{attribute}"
    kept = dict.fromkeys([*on.values(), *needs])
    side = dimension.select(F.col(key), *(F.col(a).alias(name(a)) for a in kept))
    conditions = [F.col(row) == F.col(name(attribute)) for row, attribute in on.items()]
    if also is not None:
        conditions.append(also(lambda attribute: F.col(name(attribute))))
    extra = []
    if fits_broadcast(dimension, budget):
        side = F.broadcast(side)
    elif _SALT in rows.columns:
        side = side.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        conditions.append(F.col(_SALT) == F.col("_dim_salt"))
        extra = ["_dim_salt"]
    return rows.join(side, all_of(conditions), "left").drop(*map(name, kept), *extra)
