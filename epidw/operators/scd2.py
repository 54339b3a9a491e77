"""Type 2 history: versions, validity intervals and the lookup as of a date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from epidw.functions.dates import all_of, day_before
from epidw.operators.keys import contiguous_ids
from epidw.operators.lookup import lookup
from epidw.session import cut_lineage

START, END, CURRENT = "data_inicio", "data_fim", "flag_atual"
FIRST_DAY = dt.date(2000, 1, 1)


def open_version(since: dt.date = FIRST_DAY) -> dict[str, Column]:
    """Control columns of a version that is still valid."""
    return {START: F.lit(since), END: F.lit(None).cast("date"), CURRENT: F.lit(True)}


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col(CURRENT))


def _check_changes(dimension: DataFrame, changes: DataFrame, on: Sequence[str], since: dt.date) -> None:
    """Raise on keys that two changes name, and on current versions that do not start before ``since``."""
    keys = list(on)
    repeated = changes.groupBy(*keys).count().filter("count > 1").select(*keys).limit(5).collect()
    if repeated:
        raise ValueError(f"several changes for one key: {[tuple(r) for r in repeated]}")
    late = current_versions(dimension).filter(F.col(START) >= F.lit(since)).join(changes.select(*keys), keys, "left_semi")
    early = late.select(*keys).distinct().limit(5).collect()
    if early:
        raise ValueError(f"changes as of {since}, not after the start of the current version: {[tuple(r) for r in early]}")


def _changed(dimension: DataFrame, changes: DataFrame, on: Sequence[str]) -> DataFrame:
    """The dimension with a ``_hit`` mark on current rows that a change names."""
    touched = changes.select(*on).distinct().withColumn("_named", F.lit(True))
    hit = F.coalesce(F.col("_named"), F.lit(False)) & F.col(CURRENT)
    return dimension.join(touched, list(on), "left").withColumn("_hit", hit).drop("_named")


def _close(dimension: DataFrame, since: dt.date, columns: Sequence[str]) -> DataFrame:
    return dimension.withColumns({
        END: F.when(F.col("_hit"), day_before(since)).otherwise(F.col(END)),
        CURRENT: F.col(CURRENT) & ~F.col("_hit"),
    }).select(*columns)


def _highest(dimension: DataFrame, key: str) -> int:
    return max(0, dimension.agg(F.coalesce(F.max(key), F.lit(0))).first()[0])


def apply_changes(
    dimension: DataFrame, changes: DataFrame, on: Sequence[str], since: dt.date, key: str, order_by: Sequence[str]
) -> DataFrame:
    """Close every current row that a change names and append its next version.

    ``changes`` carries the columns of ``on`` plus the attributes that take a new
    value. New keys continue after the highest one, in ``order_by`` order. The
    dimension is read several times, so pass a written table. Two changes for one key, or a
    ``since`` that is not after the start of a version it closes, raise ``ValueError``.
    """
    _check_changes(dimension, changes, on, since)
    columns = dimension.columns
    marked = _changed(dimension, changes, on)
    replaced = [c for c in changes.columns if c not in on]
    hits = marked.filter("_hit").drop("_hit", key, *replaced)
    versions = hits.join(changes, list(on)).withColumns(open_version(since))
    numbered = contiguous_ids(versions, order_by, key, _highest(dimension, key) + 1)
    return _close(marked, since, columns).unionByName(numbered.select(*columns))


def upsert(dimension: DataFrame, members: DataFrame, natural_key: str, as_of: dt.date, key: str) -> DataFrame:
    """Close the current row of each given natural key the day before ``as_of`` and insert the new version.

    ``members`` carries all descriptive attributes. A natural key that is not there
    yet is simply inserted. Two members with one natural key, or an ``as_of`` that is not
    after the start of a version it closes, raise ``ValueError``.
    """
    _check_changes(dimension, members, [natural_key], as_of)
    columns = dimension.columns
    marked = _changed(dimension, members, [natural_key])
    versions = members.withColumns(open_version(as_of))
    numbered = contiguous_ids(versions, [natural_key], key, _highest(dimension, key) + 1)
    return _close(marked, as_of, columns).unionByName(numbered.select(*columns))


def lookup_as_of(
    rows: DataFrame, dimension: DataFrame, on: dict[str, str], date: str, key: str, budget: int | None = None
) -> DataFrame:
    """Left join to the version valid on the row's date.

    A row without a date matches only the version that is still open; a date before
    the first version matches none.
    """
    when = F.col(date)

    def valid(attribute) -> Column:
        started = when.isNull() | (when >= attribute(START))
        not_ended = attribute(END).isNull() | (when <= attribute(END))
        return all_of([started, not_ended])

    return lookup(rows, dimension, on, key, also=valid, needs=(START, END), budget=budget)


def lookup_as_of_merged(
    rows: DataFrame, dimension: DataFrame, on: dict[str, str], date: str, key: str, budget: int | None = None
) -> DataFrame:
    """The result of :func:`lookup_as_of` for members with a deep history, without pairing rows with versions.

    The distinct places and dates of the rows, few however often each occurs, are merged with the starts of the versions
    in order of time, and each takes the last version started. A version that has ended by then is none. Rows then take
    the answer of their place and date, at most one, by an equality join. So no join makes more rows than it reads, and
    a hot place is no larger here than the days it was seen on. A row without a date takes the version still open.
    Versions of one member must not overlap.
    """
    names = list(on.values())
    points = rows.select(*(F.col(r).alias(a) for r, a in on.items()), F.col(date).alias("_at")).distinct()
    points = points.filter(all_of([F.col(a).isNotNull() for a in names]))
    never = F.lit(dt.date(9999, 12, 31))
    version = F.struct(F.col(key).alias("key"), F.col(END).alias("ended"))
    started = dimension.select(*names, F.col(START).alias("_at"), F.col(START).alias("_time"), version.alias("_version"))
    asked = points.select(*names, "_at", F.coalesce("_at", never).alias("_time"), F.lit(None).cast(started.schema["_version"].dataType).alias("_version"))
    # a version holds from its first day on, so it comes before what was asked for that day
    so_far = Window.partitionBy(*names).orderBy("_time", F.col("_version").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    merged = started.withColumn("_asked", F.lit(False)).unionByName(asked.withColumn("_asked", F.lit(True)))
    valid = merged.withColumn("_last", F.last("_version", ignorenulls=True).over(so_far)).filter("_asked")
    ended = F.col("_last.ended")
    answered = valid.filter(F.col("_last").isNotNull() & (ended.isNull() | (F.col("_at").isNotNull() & (F.col("_at") <= ended))))
    answers = answered.select(*names, F.coalesce("_at", never).alias("_when"), F.col("_last.key").alias(key))
    with_time = rows.withColumn("_when_asked", F.coalesce(F.col(date), never))
    found = lookup(with_time, cut_lineage(answers), {**on, "_when_asked": "_when"}, key, budget=budget)
    return found.drop("_when_asked")


def timeline(changes: DataFrame, natural_key: str, date: str, end_of_time: dt.date | None = None) -> DataFrame:
    """Versions from a table of changes, in any order and any number for a key: each holds until the day before the next.

    Several changes of one key on one day leave the last in order of their other columns. A change that repeats what
    holds already starts no version, so a late change only splits the interval it falls into. Adds ``data_inicio`` (the
    date), ``data_fim`` (None, or ``end_of_time``, for the version that still holds) and ``flag_atual``. Rows without a
    key or a date are no changes. Intervals of a key have no gaps and no overlaps.
    """
    described = [c for c in changes.columns if c not in (natural_key, date)]
    known = changes.filter(F.col(natural_key).isNotNull() & F.col(date).isNotNull())
    state = F.struct(*described) if described else F.struct(F.lit(0).alias("_none"))
    daily = known.groupBy(natural_key, date).agg(F.max(state).alias("_state"))
    in_time = Window.partitionBy(natural_key).orderBy(date)
    before = F.lag("_state").over(in_time)
    starts = daily.withColumn("_same", F.coalesce(before.eqNullSafe(F.col("_state")) & (F.row_number().over(in_time) > 1), F.lit(False))).filter("NOT _same")
    following = F.lead(date).over(in_time)
    last = F.lit(end_of_time).cast("date")
    return starts.select(
        natural_key, *(F.col(f"_state.{c}").alias(c) for c in described), F.col(date).alias(START),
        F.coalesce(day_before(following), last).alias(END), following.isNull().alias(CURRENT),
    )


def apply_timeline(dimension: DataFrame, changes: DataFrame, natural_key: str, date: str, key: str, attributes: Sequence[str]) -> DataFrame:
    """The dimension after changes of ``attributes``, several for a key and late ones included, at their dates.

    A change holds from its date until the next change of its key, stored or given; on the day of a stored start it
    replaces that version's values. Versions that keep start and values keep their key; others are numbered on, in order
    of natural key and start. Other attributes are those of the stored version that held at the time, or, before the first
    one, of the first. Changes of unknown keys are left out. Members without a change stay as they are.
    """
    columns = dimension.columns
    others = [c for c in columns if c not in (natural_key, key, START, END, CURRENT, *attributes)]
    touched = changes.filter(F.col(date).isNotNull()).select(natural_key).distinct()
    stored = dimension.join(touched, natural_key, "left_semi")
    given = changes.filter(F.col(date).isNotNull()).join(stored.select(natural_key).distinct(), natural_key, "left_semi").groupBy(natural_key, date).agg(
        F.max(F.struct(*attributes)).alias("_new")).select(natural_key, F.col(date).alias(START), "_new")
    base = stored.select(natural_key, START, F.struct(F.col(key), *attributes).alias("_old"), F.struct(*others).alias("_rest"))
    events = base.join(given, [natural_key, START], "full_outer")
    in_time = Window.partitionBy(natural_key).orderBy(START)
    rest = F.coalesce(F.last("_rest", True).over(in_time.rowsBetween(Window.unboundedPreceding, 0)), F.first("_rest", True).over(
        in_time.rowsBetween(0, Window.unboundedFollowing)))
    following = F.lead(START).over(in_time)
    value = lambda a: F.when(F.col("_new").isNotNull(), F.col(f"_new.{a}")).otherwise(F.col(f"_old.{a}"))
    same = F.col("_old").isNotNull() & (F.col("_new").isNull() | all_of([F.col(f"_new.{a}").eqNullSafe(F.col(f"_old.{a}")) for a in attributes]))
    versions = events.select(
        natural_key, START, day_before(following).alias(END), following.isNull().alias(CURRENT), rest.alias("_rest"),
        *(value(a).alias(a) for a in attributes), F.when(same, F.col(f"_old.{key}")).alias(key),
    ).select(natural_key, START, END, CURRENT, key, *attributes, "_rest.*")
    versions = cut_lineage(versions)
    numbered = contiguous_ids(versions.filter(F.col(key).isNull()).drop(key), [natural_key, START], key, _highest(dimension, key) + 1)
    untouched = dimension.join(touched, natural_key, "left_anti")
    return untouched.unionByName(versions.filter(F.col(key).isNotNull()).select(*columns)).unionByName(numbered.select(*columns))
