import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from epidw import domain as d
from epidw.functions import dates, measures, text


def apply(spark, values, result, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", result(F.col("v")).alias("r")).orderBy("i").collect()]


def test_clean_text(spark):
    values = [None, "", "   ", " a ", " b ", " ção　", "\tc", "São  José", " ", " Não"]
    cleaned = apply(spark, values, text.clean_text)
    assert cleaned == [d.UNKNOWN] * 3 + ["a", "b", "ção", "\tc", "São  José", d.UNKNOWN, "Não"]


def test_clean_upper_keeps_accents(spark):
    assert apply(spark, [" Vitória ", None, " "], text.clean_upper) == ["VITÓRIA", "DESCONHECIDO", "DESCONHECIDO"]


def test_remove_accents(spark):
    values = ["SÃO JOSÉ DO CALÇADO", None, "", "Vitória", "½ ĳ Ŀ", "Ǻ", "abc", "nº ª ²"]
    assert apply(spark, values, text.remove_accents) == [
        "SAO JOSE DO CALCADO", "", "", "Vitoria", "1⁄2 ij L·", "A", "abc", "no a 2",
    ]


@pytest.mark.parametrize(
    "value, day",
    [
        ("2020-01-05", "2020-01-05"), ("2020-1-5", "2020-01-05"), ("2020/01/05", "2020-01-05"),
        ("2020 01 05", "2020-01-05"), ("2020-01-05 10:11:12", "2020-01-05"), ("2020-01-05T10:11:12", "2020-01-05"),
        ("2020-01-05 10:11:12.123456", "2020-01-05"), ("2020-01-05 10:11:12+03:00", "2020-01-05"),
        (" 2020-01-05 ", "2020-01-05"), ("31/12/20", "0031-12-20"), ("5-1-2", "0005-01-02"),
        ("31/12/2020", None), ("2020", None), ("2020-01", None), ("", None), (None, None), ("n/d", None),
        ("2020/01-05", None), ("2020-01-05T10", None), ("2020-01-05abc", None), ("2020-02-30", None),
        ("2020-01-05 99:00:00", None), ("20200105", None),
    ],
)
def test_try_date(spark, value, day):
    found = apply(spark, [value], dates.try_date)[0]
    assert found == (dt.date.fromisoformat(day) if day else None)


def test_strict_date(spark):
    assert apply(spark, ["2020-01-05", None], dates.strict_date) == [dt.date(2020, 1, 5), None]
    with pytest.raises(PySparkException, match="not a date"):
        apply(spark, ["n/d"], dates.strict_date)


def test_first_collection_date_takes_the_first_present_value(spark):
    df = spark.createDataFrame(
        [(None, "n/d", "2020-01-05", None), (None, None, "2020-01-05", "2020-01-06")], "a string, b string, c string, d string"
    )
    found = [r[0] for r in df.select(dates.first_collection_date(*map(F.col, df.columns))).collect()]
    assert found == [None, dt.date(2020, 1, 5)]


def test_date_key_and_month(spark):
    days = [dt.date(2000, 1, 1), dt.date(2030, 12, 31), dt.date(2031, 1, 1), dt.date(1999, 12, 31), None]
    assert apply(spark, days, dates.date_key, "date") == [20000101, 20301231, -1, -1, -1]
    assert apply(spark, [20000101, 20301231, -1], dates.month_of_key, "int") == ["2000-01", "2030-12", d.UNKNOWN]
    assert apply(spark, ["2021-02", d.UNKNOWN], dates.month_from_label) == [dt.date(2021, 2, 1), None]


def test_day_gap(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 10), dt.date(2020, 1, 3)), (None, dt.date(2020, 1, 3))], "a date, b date")
    assert [r[0] for r in df.select(dates.day_gap(F.col("a"), F.col("b"))).collect()] == [-7, None]


def test_parse_age(spark):
    values = [None, "42", "65 anos, 8 meses, 6 dias", "9 meses", "15 dias", "idade 7", "x", "65 ANOS", "99999", "ano", "-5"]
    assert apply(spark, values, measures.parse_age_years) == [None, 42, 65, 0, 0, 7, None, 65, None, None, 5]


def test_flags(spark):
    sick = lambda c: measures.flag(c == d.YES)
    assert apply(spark, [" Sim", "Sim", None], sick) == [0, 1, 0]
    positive = lambda c: measures.flag(measures.any_positive([c, F.lit(None).cast("string")]))
    assert apply(spark, ["Positivo", "POSITIVO", None], positive) == [0, 1, 0]
    assert apply(spark, ["Óbito pelo COVID-19", "obito pelo COVID", None], measures.has_covid_death_loose) == [True, True, False]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (1, 8)], "a long, b long")
    a, b = F.col("a"), F.col("b")
    rate = measures.percent(a, b)
    found = df.select(
        measures.rounded_percent(a, b), measures.padded_percent_text(rate), measures.short_percent_text(rate)
    ).collect()
    assert [tuple(r) for r in found] == [(33.33, "33.33%", "33.33%"), (0.0, "0.00%", "0.0%"), (12.5, "12.50%", "12.5%")]
