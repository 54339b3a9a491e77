import datetime as dt
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from epidw.operators import keys, lookup, scd2


@pytest.mark.parametrize("one_task_rows", [100_000, 0])
def test_contiguous_ids_follow_the_order(spark, one_task_rows):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).cast("string").alias("k"))
    numbered = keys.contiguous_ids(df, ["k"], "sk", start=10, one_task_rows=one_task_rows)
    found = rows(numbered.select("k", "sk"), "sk")
    assert [k for k, _ in found] == sorted(str(i) for i in range(5_000))
    assert [sk for _, sk in found] == list(range(10, 5_010))
    assert numbered.schema["sk"].dataType.simpleString() == "int"


@pytest.mark.parametrize("one_task_rows", [100_000, 0])
def test_ranges_unfold_heavy_and_light_groups(spark, one_task_rows):
    counts = {0: 50_001, 1: 1, 2: 2_500, 3: 10_000, 4: 7}
    df = spark.createDataFrame(list(counts.items()), "k int, n long")
    blocks = keys.contiguous_ranges(df, ["k"], F.col("n"), "first", one_task_rows=one_task_rows)
    unfolded = keys.repeat_numbered(blocks, "n", "first", "sk", chunk=1_000)
    assert unfolded.columns == ["k", "sk"]
    found = rows(unfolded, "sk")
    assert [sk for _, sk in found] == list(range(1, sum(counts.values()) + 1))
    assert [k for k, _ in found] == [k for k, n in counts.items() for _ in range(n)]
    # the heavy group is spread over several tasks
    tasks = unfolded.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


def test_numbering_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert keys.contiguous_ids(empty, ["k"], "sk").count() == 0


def test_broadcast_and_salted_lookup_agree_on_a_hot_key(spark, folder):
    hot = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"))
    hot.write.parquet(f"{folder}/rows")
    scanned = lookup.with_salt(spark.read.parquet(f"{folder}/rows"))
    members = spark.createDataFrame([("hot", 1)] + [(str(i), i + 10) for i in range(1, 2_000)], "name string, sk int")
    quick = lookup.lookup(scanned, members, {"a": "name"}, "sk").select("a", "sk")
    salted = lookup.lookup(scanned, members, {"a": "name"}, "sk", budget=0).select("a", "sk")
    assert Counter(map(tuple, quick.collect())) == Counter(map(tuple, salted.collect()))
    assert salted.count() == 3_000
    assert salted.filter("a = 'hot' and sk = 1").count() == 1_000
    assert salted.filter("sk is null").count() > 0


def test_large_dimensions_join_rows_without_a_salt(spark):
    named = spark.createDataFrame([("a",), ("b",)], "name string")
    one = spark.createDataFrame([("a", 1)], "name string, sk int")
    assert rows(lookup.lookup(named, one, {"name": "name"}, "sk", budget=0)) == [("a", 1), ("b", None)]


DIM = "sk_local int, municipio string, populacao_municipio int, data_inicio date, data_fim date, flag_atual boolean, nk string"
START = dt.date(2000, 1, 1)


@pytest.fixture
def dimension(spark, folder):
    members = [(-1, "?", 0, START, None, True, "?"), (1, "A", 10, START, None, True, "a"), (2, "B", 20, START, None, True, "b")]
    spark.createDataFrame(members, DIM).write.parquet(f"{folder}/dim")
    return spark.read.parquet(f"{folder}/dim")


def test_apply_changes_and_as_of(spark, dimension):
    changes = spark.createDataFrame([("B", 25)], "municipio string, populacao_municipio int")
    after = scd2.apply_changes(dimension, changes, ["municipio"], dt.date(2022, 1, 1), "sk_local", ["municipio"])
    assert after.columns == dimension.columns
    assert rows(after, "sk_local")[2:] == [
        (2, "B", 20, START, dt.date(2021, 12, 31), False, "b"),
        (3, "B", 25, dt.date(2022, 1, 1), None, True, "b"),
    ]
    asked = [dt.date(2021, 12, 31), dt.date(2022, 1, 1), None, dt.date(1999, 12, 31)]
    for budget in (None, 0):
        df = lookup.with_salt(spark.createDataFrame([("B", day) for day in asked], "m string, day date"))
        found = scd2.lookup_as_of(df, after, {"m": "municipio"}, "day", "sk_local", budget)
        assert {(r.day, r.sk_local) for r in found.collect()} == set(zip(asked, [2, 3, 3, None]))


def test_changes_touch_only_current_rows(spark, dimension):
    first = spark.createDataFrame([("B", 25)], "municipio string, populacao_municipio int")
    once = scd2.apply_changes(dimension, first, ["municipio"], dt.date(2022, 1, 1), "sk_local", ["municipio"])
    second = spark.createDataFrame([("B", 30), ("nowhere", 1)], "municipio string, populacao_municipio int")
    twice = scd2.apply_changes(once, second, ["municipio"], dt.date(2023, 1, 1), "sk_local", ["municipio"])
    history = [(r.sk_local, r.data_fim, r.flag_atual) for r in twice.filter("municipio = 'B'").orderBy("sk_local").collect()]
    assert history == [(2, dt.date(2021, 12, 31), False), (3, dt.date(2022, 12, 31), False), (4, None, True)]


def test_upsert_closes_and_inserts(spark, dimension):
    members = spark.createDataFrame([("A", 11, "a"), ("C", 5, "c")], "municipio string, populacao_municipio int, nk string")
    after = scd2.upsert(dimension, members, "nk", dt.date(2023, 6, 1), "sk_local")
    assert [tuple(r)[:2] + tuple(r)[3:6] for r in after.filter("nk in ('a', 'c')").orderBy("sk_local").collect()] == [
        (1, "A", START, dt.date(2023, 5, 31), False),
        (3, "A", dt.date(2023, 6, 1), None, True),
        (4, "C", dt.date(2023, 6, 1), None, True),
    ]
    assert scd2.current_versions(after).count() == 4


def test_ambiguous_and_early_changes_are_refused(spark, dimension):
    day = dt.date(2022, 1, 1)
    name = dimension.first()["municipio"]
    changes = dimension.filter(F.col("municipio") == name).select("municipio").distinct().withColumn("regiao_saude", F.lit("A"))
    twice = changes.unionByName(changes.withColumn("regiao_saude", F.lit("B")))
    with pytest.raises(ValueError, match="several changes"):
        scd2.apply_changes(dimension, twice, ["municipio"], day, "sk_local", ["municipio"])
    with pytest.raises(ValueError, match="not after the start"):
        scd2.apply_changes(dimension, changes, ["municipio"], scd2.FIRST_DAY, "sk_local", ["municipio"])
