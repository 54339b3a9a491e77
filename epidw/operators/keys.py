"""Contiguous surrogate keys whose numbering never depends on one task holding all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from epidw.session import cut_lineage


ONE_TASK_ROWS = 100_000


def contiguous_ranges(
    df: DataFrame,
    order_by: Sequence[str],
    weight: Column | int,
    first: str,
    start: int = 1,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Give every row the first of ``weight`` consecutive numbers, in ``order_by`` order.

    Rows must differ in ``order_by``. They are written once and counted. Up to
    ``one_task_rows`` of them are numbered by a plain window. More are split by range,
    which distinct keys fill evenly; the ranges are written, so that the pass that
    totals them and the pass that numbers them agree, and only one total per range
    meets in a single task.
    """
    weight = weight if isinstance(weight, Column) else F.lit(weight)
    above = Window.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    rows = cut_lineage(df)
    if rows.count() <= one_task_rows:
        offset = F.coalesce(F.sum(weight).over(above), F.lit(0))
        return rows.withColumn(first, (offset + start).cast("long"))
    ranges = cut_lineage(rows.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id()))
    totals = ranges.groupBy("_part").agg(F.sum(weight).alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: the broadcast side is bounded by the number of partitions
    return (
        ranges.withColumn("_offset", F.coalesce(F.sum(weight).over(within), F.lit(0)))
        .join(F.broadcast(bases), "_part")
        .withColumn(first, (F.col("_base") + F.col("_offset") + start).cast("long"))
        .drop("_part", "_offset", "_base")
    )


def contiguous_ids(
    df: DataFrame, order_by: Sequence[str], name: str, start: int = 1, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Number distinct rows ``start, start + 1, ..`` in ``order_by`` order; the key is an INT."""
    ranges = contiguous_ranges(df, order_by, 1, name, start, one_task_rows)
    return ranges.withColumn(name, F.col(name).cast("int"))


def repeat_numbered(df: DataFrame, count: str, first: str, name: str, chunk: int = 10_000, rows_per_task: int = 4_000_000) -> DataFrame:
    """Emit every row ``count`` times, numbered from its ``first``.

    A row that stands for very many is cut into chunks, which are spread over the
    tasks before they are unfolded, so one heavy row cannot keep one task busy.
    """
    session = df.sparkSession
    rows = df.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    tasks = max(session.sparkContext.defaultParallelism, -(-rows // rows_per_task))
    last = F.col(first) + F.col(count) - 1
    cut = df.withColumn("_from", F.explode(F.sequence(F.col(first), last, F.lit(chunk).cast("long"))))
    spread = (
        cut.withColumn("_to", F.least(F.col("_from") + (chunk - 1), last))
        .repartition(tasks, "_from")
        .sortWithinPartitions("_from")
    )
    return spread.withColumn(name, F.explode(F.sequence("_from", "_to"))).drop("_from", "_to", count, *({first} - {name}))
