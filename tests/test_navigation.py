"""Aggregate navigation and the refresh from one scan."""
import re

import pytest
from conftest import rows
from test_panels import plan

from epidw import registry
from epidw.operators import aggregates as a
from epidw.operators.facts import NOTIFICATION
from epidw.plans import shared_refresh, star
from epidw.plans.navigate import Navigator

MUNICIPIOS, CLASSES = registry.WAREHOUSE_MUNICIPIOS, registry.CLASSES


@pytest.fixture(scope="module")
def navigator(small):
    return Navigator(small)


@pytest.mark.parametrize("name", registry.REQUESTS)
def test_every_route_that_answers_gives_the_answer_of_the_fact(navigator, name):
    request = registry.REQUESTS[name]
    expected = rows(navigator.answer(request, a.FACT))
    able = [x for x in navigator.aggregates if a.answers(x, request)]
    for route in able:
        assert rows(navigator.answer(request, route)) == expected
    chosen = navigator.choose(request)
    assert chosen in able and all(navigator.rows(chosen) <= navigator.rows(x) for x in able) if able else chosen is a.FACT


def test_what_follows_from_a_grain():
    assert {"municipio", "ano_mes", "ano", "classificacao"} <= a.follows(("sk_local", "sk_class", a.MONTH))
    assert "regiao_es" not in a.follows(("municipio", "ano_mes"))  # an unknown municipio has several
    assert not a.answers(a.MART_AGGREGATE, a.Request(("municipio",), ("obitos_confirmados",)))
    assert not a.answers(a.MART_AGGREGATE, a.Request(("municipio",), filters={"classificacao": CLASSES}))
    assert a.answers(a.MART_AGGREGATE, a.Request(("municipio",), filters={"classificacao": ()}))
    assert a.answers(a.FACT, a.Request(("febre", "sexo", "ano")))


def test_a_route_that_cannot_answer_is_refused(navigator):
    with pytest.raises(ValueError):
        navigator.answer(a.Request(("sexo",)), a.MART_AGGREGATE)


def test_nothing_chosen_gives_zero(navigator):
    request = a.Request((), ("notificacoes", "obitos"), {"municipio": ("nowhere",)})
    assert rows(navigator.answer(request)) == rows(navigator.answer(request, a.FACT)) == [(0, 0)]


def test_coarser_aggregates_come_from_finer_ones(small):
    finer, coarser = a.STORED[1], a.STORED[4]
    assert rows(a.build_aggregate(coarser, small, finer)) == rows(a.build_aggregate(coarser, small))


@pytest.mark.parametrize("municipios, classes", [((), ()), (MUNICIPIOS, ()), ((), CLASSES), (MUNICIPIOS, CLASSES), (("nowhere",), ())])
def test_refreshes_agree_with_the_single_panels(small, municipios, classes):
    stored = shared_refresh.refresh_stored(small, municipios, classes)
    assert rows(stored) == rows(shared_refresh.refresh_all_dw(small, municipios, classes))
    found = shared_refresh.by_panel(stored)
    for name in ("top_municipios", "class_distribution", "age_band"):
        assert {(r.chave, r.valor) for r in found.get(name, ())} == {tuple(r) for r in star.PANELS[name](small, municipios, classes).collect()}
    lethal = star.lethality_by_municipio(small, municipios, classes).drop("taxa_letalidade")
    assert {(r.chave, r.valor, r.segundo, r.taxa_pct) for r in found.get("lethality_by_municipio", ())} == {tuple(r) for r in lethal.collect()}
    assert len(found["kpis"]) == 3 and len(found["symptoms"]) == 7


def test_a_refresh_scans_its_source_once(small):
    fact = plan(shared_refresh.refresh_all_dw(small, MUNICIPIOS, CLASSES))
    details = fact[fact.index("\n\n"):] if "\n\n" in fact else fact
    assert len(re.findall(rf"Location: .*{re.escape(NOTIFICATION.split('.')[1])}", details)) == 1
    assert "In(sk_local" in fact and "flag_cura" not in fact
    assert len(re.findall("Location: ", plan(shared_refresh.refresh_all_direct(small.raw)))) == 1
    assert len(re.findall("Location: ", plan(shared_refresh.refresh_stored(small, MUNICIPIOS)))) == 1


def test_many_keys_of_a_refresh_fall_back_to_a_semi_join(small, monkeypatch):
    pushed = rows(shared_refresh.refresh_all_dw(small, MUNICIPIOS, CLASSES))
    monkeypatch.setattr(shared_refresh, "PUSHED_KEYS", 0)
    assert rows(shared_refresh.refresh_all_dw(small, MUNICIPIOS, CLASSES)) == pushed
