"""What the loads shuffle and leave on disk; rows are built here."""

import os
import time
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from epidw import domain as d, session
from epidw.operators import facts, increments, mart
from epidw.plans.incremental import IncrementalLoad
from epidw.plans.pipeline import Load
from epidw.sources.warehouse import Warehouse


def bag(df):
    return Counter(map(tuple, df.collect()))


def snapshots(spark):
    """Two bags of 4,000 rows and some: rows with missing values, copies, one row of many copies, a tenth of them changed."""
    n = F.col("id")
    old = spark.range(4000).select(
        F.when(n % 7 == 0, None).otherwise(F.concat(F.lit("a"), n)).alias("a"),
        F.when(n % 5 == 0, None).when(n % 5 == 1, "").otherwise(n.cast("string")).alias("b"),
        F.when(n < 1500, "hot").otherwise((n % 300).cast("string")).alias("c"),
    ).withColumn("a", F.when(F.col("c") != "hot", F.col("a"))).withColumn("b", F.when(F.col("c") != "hot", F.col("b")))
    new = old.filter("c <> '17'").withColumn("b", F.when(F.col("c") == "42", "other").otherwise(F.col("b")))
    return old, new.unionByName(old.filter("c = '99' OR c = 'hot'"))


@pytest.fixture
def shuffled(spark, monkeypatch):
    """No side of a join is small enough for a broadcast that nothing bounds."""
    monkeypatch.setattr(increments, "fits_broadcast", lambda df: False)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("largest", [1, increments.FILTER_BLOCKS])
def test_many_changes_are_counted_right_by_a_filter_full_or_not(spark, shuffled, monkeypatch, largest):
    old, new = snapshots(spark)
    full = increments.digest_filter
    monkeypatch.setattr(increments, "digest_filter", lambda digests: full(digests, largest))
    expected = bag(new)
    expected.subtract(bag(old))
    found = [tuple(r) for r in increments.snapshot_delta(old, new).collect()]
    assert sorted(found, key=str) == sorted(((*row, n) for row, n in expected.items() if n), key=str)
    assert increments.snapshot_delta(old, old).isEmpty() and increments.snapshot_delta(new.limit(0), new.limit(0)).isEmpty()


def test_only_changed_rows_are_shuffled_whole(spark, shuffled):
    old, new = snapshots(spark)
    delta = increments.snapshot_delta(old, new)
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("LeftSemi") >= 2


def test_a_filter_misses_no_digest_and_lets_few_others_pass(spark):
    rows = spark.range(60_000).select(*increments.row_digest(["id"]), "id")
    marked = increments.digest_filter(rows.filter("id % 10 = 0"))
    passed = {r.id for r in increments.may_hold(rows, marked).collect()}
    assert passed >= set(range(0, 60_000, 10)) and len(passed) < 6_000 + 54_000 // 50
    assert marked.count() <= 6_000 * increments.BITS_PER_DIGEST / (64 * increments.BLOCK_WORDS) * 2


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for _, _, names in os.walk(folder) for f in names if f.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark, folder):
    counted = spark.range(50_000).groupBy((F.col("id") % 20_011).alias("k")).agg(F.count("*").alias("n"))
    before = shuffle_files(spark)
    tables = [session.cut_lineage(counted), Warehouse.new_version(spark, folder).write("x.counted", counted)]
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:  # they go soon after a write ends
        time.sleep(0.2)
    assert not left and [t.count() for t in tables] == [20_011, 20_011]
    assert [len(counted.collect()), len(counted.collect()), counted.count()] == [20_011] * 3


def test_the_setting_of_the_session_is_as_before_after_writes_that_overlap(spark):
    both, key = Barrier(2, timeout=60), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)

    def inside(fail):
        with session.shuffles_dropped(spark):
            both.wait()
            held = spark.conf.get(key)
            both.wait()
            if fail:
                raise ValueError
            return held

    with ThreadPoolExecutor(2) as pool:
        one, other = pool.submit(inside, True), pool.submit(inside, False)
        assert isinstance(one.exception(), ValueError) and other.result() == "true"
    assert spark.conf.get(key, None) == before


def test_facts_and_mart_of_a_second_load_are_right_with_many_changes(spark, shuffled, folder):
    n = F.col("id")
    values = {
        "DataNotificacao": F.concat(F.lit("2021-"), F.lpad((n % 12 + 1).cast("string"), 2, "0"), F.lit("-05")),
        "Municipio": F.when(n % 9 > 0, F.concat(F.lit("Lugar "), n % 9)), "Bairro": F.concat(F.lit("B"), n % 4), "Sexo": F.when(n % 3 == 0, "F"),
        "Classificacao": F.when(n % 2 == 0, d.CONFIRMED), "Evolucao": F.when(n % 10 == 0, d.COVID_DEATH).otherwise(d.CURED), d.HOSPITALISED: F.when(n % 8 == 0, d.YES),
    }
    raw = spark.range(600).select(*(values.get(c, F.lit(None).cast("string")).alias(c) for c in d.RAW_COLUMNS))
    changed = raw.filter("Bairro <> 'B3' OR Municipio = 'Lugar 1'").withColumn("Municipio", F.when(F.col("Municipio") == "Lugar 2", "vitoria").otherwise(F.col("Municipio")))
    second = IncrementalLoad(Load.start(spark, session.cut_lineage(raw), folder), session.cut_lineage(changed.unionByName(raw.filter("Sexo = 'F'"))))
    staged = increments.staged_delta(second.raw.withColumn(increments.CHANGE, F.lit(1))).drop(increments.CHANGE)
    full = facts.build_notification_fact(staged, second.dimensions)
    assert bag(second.fact) == bag(full) and sum(bag(full).values()) == second.raw.count()
    assert bag(second.mart) == bag(mart.refresh_mart(full, second.dimension("dw.dim_localidade")))
    assert "VITORIA" in {r.municipio for r in second.mart.collect()}
