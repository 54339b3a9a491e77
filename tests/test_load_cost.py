"""What a load writes and copies for each raw row; rows are built here."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import rows
from epidw import domain as d, registry
from epidw.functions import dates, text
from epidw.session import shared_folder
from epidw.sources.fixture import raw_from_test_tables

DAY = dt.datetime(1996, 1, 2)


def tables(spark, folder):
    """Five lines of two orders: one line twice, one without values, one whose order is not there."""
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    twice = (1, 8, 5, 1, 41.0, "R", "O", DAY)
    held = {
        "nation": ([(0, "ALGERIA"), (7, "GERMANY")], "n_nationkey int, n_name string"),
        "customer": ([(1, 0, "BUILDING"), (2, 7, None)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": ([(1, 1, "F", "1-URGENT", DAY), (2, 2, None, None, None)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
        "lineitem": ([twice, twice, (2, 9, 19, 2, 11.0, "A", "F", DAY), (2, *[None] * 7), (3, 1, 1, 1, 1.0, "N", "O", DAY)], lines),
    }
    for name, (values, schema) in held.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_a_load_does_not_write_the_raw_text_that_nothing_reads_as_files(spark, folder):
    sf_dir = tables(spark, folder)
    staged = registry.queries()["stg_notificacao"](spark, sf_dir)
    load = registry.load_for(spark, sf_dir)
    assert staged.count() == load["stg.notificacao_raw"].count() == 4
    registry.queries()["dim_comorbidade"](spark, sf_dir).count()
    local = load.root.removeprefix("file:")
    assert local.startswith(shared_folder(spark).removeprefix("file:")) and not os.path.exists(f"{local}/raw")
    expected = sorted(map(str, rows(raw_from_test_tables(spark, sf_dir))))
    assert sorted(map(str, rows(load.rows))) == sorted(map(str, rows(load.raw))) == expected
    assert os.path.exists(f"{local}/raw") and load.rows.columns == load.raw.columns == list(d.RAW_COLUMNS)


def test_a_single_pass_over_staging_does_not_write_it_and_gives_its_rows(spark, folder):
    sf_dir = tables(spark, folder)
    load = registry.load_for(spark, sf_dir)
    names = ("dim_comorbidade", "role_playing_dates", "fact_flags", "dim_localidade_base")
    alone = {name: sorted(map(str, registry.queries()[name](spark, sf_dir).collect())) for name in names}
    assert "stg.notificacao_raw" not in load
    load.build("stg.notificacao_raw")
    assert alone == {name: sorted(map(str, registry.queries()[name](spark, sf_dir).collect())) for name in names}


def test_cleaning_is_one_projection_and_as_before_on_odd_text(spark):
    spaces = [" ", " ", " ", "　", "\t"]
    odd = [None, "", "x", "é", "Não", " é", "é ", "a b", "!", "\x1f", "\x7f", "日本", " 日　"]
    values = [*odd, *spaces, *(a + (b or "") + c for a in spaces for b in odd for c in spaces)]
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    cleaned = df.select("v", text.clean_text(F.col("v")).alias("c"))
    trimmed = F.btrim(F.col("v"), F.lit(text.SPACES))
    before = df.select("v", F.coalesce(F.nullif(trimmed, F.lit("")), F.lit(d.UNKNOWN)).alias("c"))
    assert cleaned.collect() == before.collect()
    assert "_common_expr" not in cleaned._jdf.queryExecution().optimizedPlan().toString()


def test_iso_dates_need_no_pattern_and_odd_dates_are_as_before(spark):
    values = [None, "", "2020-01-02", "2020-1-2", "2020-13-01", "2020-02-30", "2020-01-1 ", " 2020-1-01", "2020-01-1\x01", "+202-01-01",
              "-202-01-01", "20200-01-1", "2020/01/02", "é020-01-02", "2020-01-é", "2020-01-02 10:00", "31/12/2020", "n/d", "----------"]
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    iso = F.when(F.col("v").like("____-__-__"), F.col("v").try_cast("date")).cast("string")
    parsed = df.select("v", dates.try_date(F.col("v")).cast("string").alias("d"))
    found = {r.v: r.d for r in parsed.collect()}
    assert all(found[r.v] == r.d for r in df.select("v", iso.alias("d")).collect() if r.d is not None)
    assert found["2020-01-1 "] == "2020-01-01" and found["2020/01/02"] == "2020-01-02" and found["31/12/2020"] is None
    assert "LIKE" not in parsed._jdf.queryExecution().optimizedPlan().toString()
