"""Both dashboard modes against each other, and routing."""
import contextlib
import io

import pytest
from conftest import rows
from pyspark.sql import functions as F

from epidw import domain as d, registry
from epidw.functions.dates import try_date
from epidw.functions.text import clean_text, clean_upper
from epidw.plans import direct, star
from epidw.plans.refresh import refresh_direct, refresh_star

MUNICIPIOS, CLASSES = registry.WAREHOUSE_MUNICIPIOS, registry.CLASSES


@pytest.fixture(scope="module")
def normalized(small):
    """Raw rows cleaned like the warehouse, where no locality version is valid before the calendar starts."""
    raw = small.raw
    changes = {c: clean_text(F.col(c)) for j in d.JUNK_DIMENSIONS for c in j.attributes}
    too_old = F.coalesce(try_date(F.col("DataNotificacao")) < F.lit(d.CALENDAR_START), F.lit(False))
    changes |= {c: F.when(too_old, F.lit(d.UNKNOWN_UPPER)).otherwise(clean_upper(F.col(c))) for c in d.PLACE}
    return raw.withColumns(changes)


@pytest.mark.parametrize("municipios, classes", [((), ()), (MUNICIPIOS, ()), ((), CLASSES), (MUNICIPIOS, CLASSES)])
@pytest.mark.parametrize("panel", [name for name in direct.PANELS if name not in ("monthly_series", "lethality_by_municipio")])
def test_modes_agree_on_clean_rows(small, normalized, panel, municipios, classes):
    left = [tuple(r) for r in direct.PANELS[panel](normalized, municipios, classes).collect()]
    right = [tuple(r) for r in star.PANELS[panel](small, municipios, classes).collect()]
    assert left == right


@pytest.mark.parametrize("municipios, classes", [((), ()), (MUNICIPIOS, CLASSES)])
def test_modes_agree_on_lethality(small, normalized, municipios, classes):
    left = direct.lethality_by_municipio(normalized, municipios, classes).drop("taxa_letalidade")
    right = star.lethality_by_municipio(small, municipios, classes).drop("taxa_letalidade")
    assert [tuple(r) for r in left.collect()] == [tuple(r) for r in right.collect()]


@pytest.mark.parametrize("municipios, classes", [((), ()), (MUNICIPIOS, CLASSES)])
def test_modes_agree_on_months_inside_the_calendar(small, normalized, municipios, classes):
    left = direct.monthly_series(normalized, municipios, classes).filter(F.col("mes") >= F.lit(d.CALENDAR_START))
    assert rows(left) == rows(star.monthly_series(small, municipios, classes))


@pytest.mark.parametrize("municipios", [(), MUNICIPIOS])
def test_mart_and_fact_routes_agree(small, municipios):
    assert star.mart_answers(()) and not star.mart_answers(CLASSES)
    for query in (star.top_municipios, star.monthly_series):
        assert rows(query(small, municipios)) == rows(query(small, municipios, use_mart=False))


def test_a_filter_that_matches_nothing(small):
    assert rows(star.kpis(small, ("nowhere",))) == [(0, 0, 0)]
    assert rows(direct.kpis(small.raw, ("nowhere",))) == [(0, 0, 0)]
    assert star.lethality_by_municipio(small, ("nowhere",)).isEmpty()


def test_many_keys_fall_back_to_a_semi_join(small, monkeypatch):
    pushed = rows(star.age_band(small, MUNICIPIOS, CLASSES))
    monkeypatch.setattr(star, "PUSHED_KEYS", 0)
    assert rows(star.age_band(small, MUNICIPIOS, CLASSES)) == pushed


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filters_and_columns_reach_the_scan(small):
    raw = plan(direct.kpis(small.raw, ("x",), CLASSES))
    assert "In(Municipio" in raw or "EqualTo(Municipio" in raw
    assert "ReadSchema: struct<Municipio:string,Classificacao:string>" in raw
    fact = plan(star.kpis(small, MUNICIPIOS))
    assert "In(sk_local" in fact
    assert "flag_cura" not in fact


def test_refresh_returns_every_panel(small):
    for result in (refresh_direct(small.raw), refresh_star(small, MUNICIPIOS)):
        assert set(result) == set(direct.PANELS)
        assert len(result["kpis"]) == 1 and len(result["symptoms"]) == 7
