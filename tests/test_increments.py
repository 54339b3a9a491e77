"""A second load from changes: bags of rows, stable keys, signed facts, merged mart."""
from collections import Counter

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from epidw import domain as d, registry
from epidw.operators import facts, increments, mart


@pytest.fixture(scope="module")
def second(spark, small):
    return registry.increment_for(spark, SMALL)


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_differences_of_bags(spark):
    kind = "a string, b string, c string"
    old = [("x", None, "1"), (None, "x", "1"), ("y", "y", "y"), ("y", "y", "y"), ("y", "y", "y"), ("", None, None), ("g", "g", "g")]
    new = [("x", None, "1"), ("x", "1", None), ("y", "y", "y"), (None, "", None), ("g", "g", "g"), ("g", "g", "g"), ("g", "g", "g")]
    before, after = spark.createDataFrame(old, kind), spark.createDataFrame(new, kind)
    difference = Counter(new)
    difference.subtract(Counter(old))
    expected = {(*row, n) for row, n in difference.items() if n}
    assert set(map(tuple, increments.snapshot_delta(before, after).collect())) == expected
    assert increments.snapshot_delta(before, before).isEmpty()
    assert bag(increments.snapshot_delta(before.limit(0), after)) == Counter((*row, n) for row, n in Counter(new).items())
    assert bag(increments.snapshot_delta(before, after.limit(0))) == Counter((*row, -n) for row, n in Counter(old).items())


def test_a_change_of_many_copies_is_found_without_a_broadcast(spark, monkeypatch):
    rows_ = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    monkeypatch.setattr(increments, "fits_broadcast", lambda df: False)
    assert rows(increments.snapshot_delta(rows_, rows_.filter("a <> 'hot' OR a IS NULL"))) == [("hot", -2000)]


def test_old_and_changes_make_the_new_snapshot(small, second):
    total = bag(small.raw)
    for row in second.delta.collect():
        total[tuple(row)[:-1]] += row[increments.CHANGE]
    assert +total == bag(second.raw) and all(n >= 0 for n in total.values())


def test_old_members_keep_their_keys(small, second):
    for table in ("dw.dim_localidade", d.PROFILE_DIM.table, d.CLASS_DIM.table):
        before, after = small[table], second.dimension(table)
        key = before.columns[0]
        assert before.exceptAll(after).isEmpty()
        keys = sorted(r[0] for r in after.select(key).collect())
        assert keys == [-1, *range(1, len(keys))]
        attributes = [c for c in after.columns if c != key]
        assert after.select(*attributes).distinct().count() == len(keys)
    assert second.dimension("dw.dim_localidade").count() == small["dw.dim_localidade"].count() + 2  # a place with two versions


def test_members_that_repeat_or_are_known_get_no_key(spark):
    known = spark.createDataFrame([(-1, "?", "?"), (1, "a", "b"), (2, "b", "a")], "k int, x string, y string")
    tuples = spark.createDataFrame([("a", "b"), ("c", "c"), ("c", "c"), ("a", "c"), ("?", "?")], "x string, y string")
    assert rows(increments.extend_members(known, tuples, "k")) == [(-1, "?", "?"), (1, "a", "b"), (2, "b", "a"), (3, "a", "c"), (4, "c", "c")]
    assert rows(increments.extend_members(known.limit(0), tuples.limit(1), "k")) == [(1, "a", "b")]


def test_fact_and_mart_equal_a_full_load_with_the_same_keys(second):
    staged = increments.staged_delta(second.raw.withColumn(increments.CHANGE, F.lit(1))).drop(increments.CHANGE)
    full = facts.build_notification_fact(staged, second.dimensions)
    assert bag(second.fact) == bag(full)
    assert rows(second.mart) == rows(mart.refresh_mart(full, second.dimension("dw.dim_localidade")))


def test_a_group_without_rows_leaves_the_mart(spark):
    kind = "municipio string, ano_mes string, confirmados long, obitos long, internacoes long, notificacoes long"
    stored = spark.createDataFrame([("A", "2020-01", 2, 1, 0, 5), ("B", "2020-01", 0, 0, 0, 3), ("C", "2020-02", 1, 1, 1, 1)], kind)
    delta = spark.createDataFrame([("A", "2020-01", -1, -1, 0, -2), ("B", "2020-01", 0, 0, 0, -3), ("D", "2021-01", 0, 0, 0, 1)], kind)
    assert rows(increments.merge_mart(stored, delta)) == [("A", "2020-01", 1, 0, 0, 3), ("C", "2020-02", 1, 1, 1, 1), ("D", "2021-01", 0, 0, 0, 1)]
    assert rows(increments.merge_mart(stored, delta.limit(0))) == rows(stored)
