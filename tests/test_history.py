"""Deep histories: the merged as-of join, timelines from changes, late changes."""
import datetime as dt
import random
import re

from conftest import rows
from pyspark.sql import functions as F
from test_panels import plan

from epidw.operators import scd2
from epidw.operators.lookup import with_salt

DAY0 = dt.date(2000, 1, 1)
VERSION = "place string, city string, data_inicio date, data_fim date, sk int"


def day(n):
    return DAY0 + dt.timedelta(n)


def deep(spark, count=10_000):
    """One place of ``count`` versions with a gap after every seventh, and a few others."""
    versions = [("hot", "a", day(2 * i), day(2 * i + (0 if i % 7 == 0 else 1)) if i < count - 1 else None, i) for i in range(count)]
    versions += [("hot", "b", day(5), day(9), 90_001), ("cold", "a", day(3), None, 90_002), ("gone", "a", day(3), day(4), 90_003)]
    return spark.createDataFrame(versions, VERSION)


def test_the_merged_join_equals_the_interval_join(spark):
    random.seed(1)
    asked = [(random.choice(["hot", "hot", "hot", "cold", "gone", "none", None]), random.choice(["a", "a", "b", None]),
              None if random.random() < 0.1 else day(random.randrange(-5, 20_100)), n) for n in range(3000)]
    asked += [("hot", "a", day(14), 5000 + n) for n in range(3000)]  # a third of all rows on one day of one place
    events = spark.createDataFrame(asked, "p string, c string, seen date, n int")
    on = {"p": "place", "c": "city"}
    versions = deep(spark)
    expected = rows(scd2.lookup_as_of(events, versions, on, "seen", "sk"))
    assert rows(scd2.lookup_as_of_merged(events, versions, on, "seen", "sk")) == expected
    shuffled = scd2.lookup_as_of_merged(with_salt(events), versions, on, "seen", "sk", budget=0).drop("_salt")
    assert rows(shuffled) == expected


def test_the_merged_join_makes_no_more_rows_than_it_reads(spark):
    events = spark.range(20_000).select(F.lit("hot").alias("p"), F.lit("a").alias("c"), F.date_add(F.lit(DAY0), (F.col("id") % 20_000).cast("int")).alias("seen"))
    found = scd2.lookup_as_of_merged(events, deep(spark), {"p": "place", "c": "city"}, "seen", "sk")
    assert found.count() == 20_000
    text = plan(found)
    conditions = re.findall(r"Join condition: (.*)", text)
    assert conditions and set(c.strip() for c in conditions) == {"None"}  # equality on place and date only


def test_empty_histories_and_events(spark):
    events = spark.createDataFrame([("x", "a", None), ("x", "a", day(1))], "p string, c string, seen date")
    on = {"p": "place", "c": "city"}
    assert rows(scd2.lookup_as_of_merged(events, deep(spark, 2).limit(0), on, "seen", "sk")) == [("x", "a", None, None), ("x", "a", day(1), None)]
    assert scd2.lookup_as_of_merged(events.limit(0), deep(spark, 2), on, "seen", "sk").count() == 0


def test_a_timeline_has_no_gaps_and_no_overlaps(spark):
    random.seed(2)
    changes = [(random.choice("abc"), day(random.randrange(60)), random.choice([1, 2, None])) for _ in range(300)]
    changes += [("d", day(7), 1), (None, day(1), 1), ("d", None, 2)]
    random.shuffle(changes)
    found = scd2.timeline(spark.createDataFrame(changes, "who string, at date, value int"), "who", "at").collect()
    for who in "abcd":
        mine = sorted((r for r in found if r.who == who), key=lambda r: r.data_inicio)
        assert all(r.data_fim + dt.timedelta(1) == s.data_inicio and not r.flag_atual for r, s in zip(mine, mine[1:]))
        assert mine[-1].data_fim is None and mine[-1].flag_atual
        assert all(r.value != s.value for r, s in zip(mine, mine[1:]))
        for n in range(60):
            before = [(c[1], c[2] is not None, c[2] or 0, c[2]) for c in changes if c[0] == who and c[1] and c[1] <= day(n)]
            holds = [r.value for r in mine if r.data_inicio <= day(n) and (r.data_fim is None or day(n) <= r.data_fim)]
            assert holds == ([max(before)[3]] if before else [])
    assert {r.who for r in found} == set("abcd")


def test_late_and_several_changes_of_one_member(spark):
    kind = "nk string, name string, pop int, data_inicio date, data_fim date, flag_atual boolean, sk int"
    stored = [("a", "A", 10, day(10), day(19), False, 1), ("a", "A2", 20, day(20), None, True, 2), ("b", "B", 5, day(0), None, True, 3)]
    changes = [("a", day(5), 1), ("a", day(15), 15), ("a", day(20), 20), ("a", day(30), 30), ("a", day(30), 29), ("z", day(1), 1), ("a", None, 9)]
    found = scd2.apply_timeline(spark.createDataFrame(stored, kind), spark.createDataFrame(changes, "nk string, at date, pop int"), "nk", "at", "sk", ["pop"])
    assert rows(found, "nk", "data_inicio") == [
        ("a", "A", 1, day(5), day(9), False, 4), ("a", "A", 10, day(10), day(14), False, 1), ("a", "A", 15, day(15), day(19), False, 5),
        ("a", "A2", 20, day(20), day(29), False, 2), ("a", "A2", 30, day(30), None, True, 6), ("b", "B", 5, day(0), None, True, 3)]
