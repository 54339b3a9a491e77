"""A whole dashboard refresh from one pass over the rows: all panels as (painel, chave, valor, segundo, taxa_pct).

The rows are summed once by several groupings, one per dimension that some panel shows. What comes out is a row per
dimension member, and each member says which panels it counts for, under which label. So the panels are one grouping
of a few thousand rows, without a scan or a job of their own. ``segundo`` and ``taxa_pct`` are filled in the panel of
lethality: deaths among the confirmed cases, and their share.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from epidw import domain as d
from epidw.functions.dates import try_date
from epidw.functions.measures import has_covid_death_loose
from epidw.operators.aggregates import MONTH, STORED, month_number, summed
from epidw.operators.facts import NOTIFICATION
from epidw.plans.direct import selected
from epidw.plans.star import PUSHED_KEYS, Tables

Values = Sequence[str]
MEASURES = ("notificacoes", "confirmados", "obitos", "obitos_confirmados")
KEYS = ("sk_class", "sk_local", "sk_perfil", "sk_sint", "sk_como", MONTH)
PANELS = "mart.painel_municipio_classe"
#: panels that show their first rows only, and how many
SHOWN = {"top_municipios": 10, "lethality_by_municipio": 5}


def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "\\'") + "'"


def _entry(panel: str, label: str, first: str, second: str | None = None, when: str | None = None) -> str:
    """What a member counts for: a panel, a label in it (an expression), and the sums that go there.

    Expressions are text, which is parsed in one go: a refresh of many small parts must not spend its time on building them.
    """
    entry = f"named_struct('painel', {_text(panel)}, 'chave', {label}, 'soma', {_text(first)}, 'soma2', {_text(second)})"
    return entry if when is None else f"IF({when}, {entry}, NULL)"


def _entries(entries: Sequence[str]) -> str:
    return f"inline(array_compact(array({', '.join(entries)})))"


def _kpis(status: str) -> list[str]:
    return [
        _entry("kpis", "'total'", "notificacoes"),
        _entry("kpis", "'suspeitos'", "notificacoes", when=f"{status} = {_text(d.SUSPECTED)}"),
        _entry("kpis", "'confirmados'", "notificacoes", when=f"{status} = {_text(d.CONFIRMED)}"),
    ]


def _always_shown(spark: SparkSession) -> DataFrame:
    """Entries that a refresh shows even where nothing matches, with zero."""
    entries = [("kpis", k) for k in ("total", "suspeitos", "confirmados")]
    entries += [("symptoms", s) for s in d.SYMPTOMS] + [("comorbidities_in_deaths", c) for c in d.COMORBIDITIES]
    listed = ", ".join(f"({_text(p)}, {_text(k)}, 0L, CAST(NULL AS LONG))" for p, k in entries)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS shown(painel, chave, valor, segundo)")


def _panels(counted: DataFrame) -> DataFrame:
    """Sums per panel and label, cut to what a panel shows."""
    sums = counted.unionByName(_always_shown(counted.sparkSession)).groupBy("painel", "chave").agg(
        F.expr("sum(valor) AS valor"), F.expr("sum(segundo) AS segundo"))
    limit = " ".join(f"WHEN {_text(p)} THEN {n}" for p, n in SHOWN.items())
    shown = sums.filter("painel <> 'lethality_by_municipio' OR valor > 0").selectExpr(
        "*", "row_number() OVER (PARTITION BY painel ORDER BY valor DESC, chave) AS _place",
    ).filter(f"_place <= CASE painel {limit} ELSE {2**31 - 1} END")
    rate = "IF(painel = 'lethality_by_municipio', round(segundo * 100.0D / valor, 2), NULL) AS taxa_pct"
    return shown.selectExpr("painel", "chave", "valor", "segundo", rate)


def _values() -> list[str]:
    """The sums that an entry names."""
    cases = " ".join(f"WHEN '{m}' THEN {m}" for m in MEASURES)
    return [f"CASE soma {cases} END AS valor", f"CASE soma2 {cases} END AS segundo"]


def members(tables: Tables) -> DataFrame:
    """(conjunto, membro) -> painel, chave, soma, soma2, for every member of every dimension shown."""
    def yes(j: d.JunkDimension, panel: str, measure: str) -> list[str]:
        return [_entry(panel, _text(raw), measure, when=f"{a} = {_text(d.YES)}") for raw, a in j.attributes.items()]

    shown = {
        "sk_class": (d.CLASS_DIM.table, [*_kpis("classificacao"), _entry("class_distribution", "classificacao", "notificacoes")]),
        "sk_local": ("dw.dim_localidade", [
            _entry("top_municipios", "municipio", "notificacoes"),
            _entry("lethality_by_municipio", "municipio", "confirmados", "obitos_confirmados")]),
        "sk_perfil": (d.PROFILE_DIM.table, [_entry("age_band", "faixa_etaria", "notificacoes")]),
        "sk_sint": (d.SYMPTOM_DIM.table, yes(d.SYMPTOM_DIM, "symptoms", "notificacoes")),
        "sk_como": (d.COMORBIDITY_DIM.table, yes(d.COMORBIDITY_DIM, "comorbidities_in_deaths", "obitos")),
    }
    frames = [
        tables[table].selectExpr(f"'{key}' AS conjunto", f"{key} AS membro", _entries(entries)) for key, (table, entries) in shown.items()
    ]
    months = tables["dw.dim_tempo"].filter(f"sk_tempo <> {d.UNKNOWN_KEY}").selectExpr("ano * 100 + mes AS membro", "ano_mes").distinct()
    frames.append(months.selectExpr(f"'{MONTH}' AS conjunto", "membro", _entries([_entry("monthly_series", "ano_mes", "notificacoes")])))
    return reduce(DataFrame.unionByName, frames)


def chosen_keys(tables: Tables, municipios: Values, classes: Values) -> dict[str, list[int] | DataFrame]:
    """Key column -> the keys of the chosen members, found in one job; a frame where they are too many to list."""
    wanted = [
        tables[table].filter(F.col(attribute).isin(*values)).select(F.lit(key).alias("conjunto"), F.col(key).alias("membro"))
        for table, key, attribute, values in (
            ("dw.dim_localidade", "sk_local", "municipio", municipios), (d.CLASS_DIM.table, "sk_class", "classificacao", classes))
        if values
    ]
    if not wanted:
        return {}
    found = reduce(DataFrame.unionByName, [w.limit(PUSHED_KEYS + 1) for w in wanted]).collect()
    keys: dict[str, list[int]] = {"sk_local": []} if municipios else {}
    keys |= {"sk_class": []} if classes else {}
    for row in found:
        keys[row.conjunto].append(row.membro)
    frames = iter(wanted)
    return {k: v if len(v) <= PUSHED_KEYS else f.select(F.col("membro").alias(k)) for (k, v), f in zip(keys.items(), frames)}


def member_sums(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    """(conjunto, membro) and the sums of :data:`MEASURES`, by all groupings in one scan of the fact."""
    rows = tables[NOTIFICATION]
    for key, keys in chosen_keys(tables, municipios, classes).items():
        rows = rows.filter(F.col(key).isin(keys)) if isinstance(keys, list) else rows.join(keys, key, "left_semi")
    rows = rows.select(*KEYS[:-1], month_number(), "qtd_notificacao", "flag_confirmado", "flag_obito_covid", "flag_internado")
    sums = rows.groupingSets([[k] for k in KEYS], *KEYS).agg(F.expr("grouping_id() AS _set"), *summed(MEASURES, stored=False))
    own = [(2 ** len(KEYS) - 1) ^ (1 << (len(KEYS) - 1 - i)) for i in range(len(KEYS))]  # a bit is set for a key that is summed over
    which = " ".join(f"WHEN {mask} THEN '{k}'" for k, mask in zip(KEYS, own))
    return sums.selectExpr(f"CASE _set {which} END AS conjunto", f"coalesce({', '.join(KEYS)}) AS membro", *MEASURES)


def refresh_all_dw(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    """Every panel of the warehouse mode, in one scan of the fact."""
    counted = member_sums(tables, municipios, classes).join(members(tables), ["conjunto", "membro"])
    return _panels(counted.selectExpr("painel", "chave", *_values()))


def panel_cube(tables: Tables) -> DataFrame:
    """What each municipio and classification adds to each entry of each panel; the stored form of a refresh.

    Built from the stored aggregates, so no further scan of the fact. Its size is that of the attributes alone: every
    refresh, whatever its filters, is a sum of some of its rows.
    """
    keys = (MONTH, "sk_perfil", "sk_sint", "sk_como")
    sources = {key: next(a for a in STORED if a.grain == ("sk_local", "sk_class", key)) for key in keys}
    frames = [
        tables[a.table].selectExpr("sk_local", "sk_class", f"'{key}' AS conjunto", f"{key} AS membro", *MEASURES) for key, a in sources.items()
    ]
    pairs = tables[sources["sk_como"].table].groupBy("sk_local", "sk_class").agg(*summed(MEASURES, stored=True))
    frames += [pairs.selectExpr("sk_local", "sk_class", f"'{key}' AS conjunto", f"{key} AS membro", *MEASURES) for key in ("sk_local", "sk_class")]
    counted = reduce(DataFrame.unionByName, frames).join(members(tables), ["conjunto", "membro"])
    per_key = counted.selectExpr("sk_local", "sk_class", "painel", "chave", *_values()).groupBy("sk_local", "sk_class", "painel", "chave").agg(
        F.expr("sum(valor) AS valor"), F.expr("sum(segundo) AS segundo"))
    named = per_key.join(tables["dw.dim_localidade"].select("sk_local", "municipio"), "sk_local").join(
        tables[d.CLASS_DIM.table].select("sk_class", "classificacao"), "sk_class")
    return named.groupBy("municipio", "classificacao", "painel", "chave").agg(F.expr("sum(valor) AS valor"), F.expr("sum(segundo) AS segundo"))


def refresh_stored(tables: Tables, municipios: Values = (), classes: Values = ()) -> DataFrame:
    """Every panel of the warehouse mode from the stored panel cube."""
    rows = tables[PANELS]
    for column, values in (("municipio", municipios), ("classificacao", classes)):
        if values:
            rows = rows.filter(F.col(column).isin(*values))
    return _panels(rows.select("painel", "chave", "valor", "segundo"))


def refresh_all_direct(raw: DataFrame, municipios: Values = (), classes: Values = ()) -> DataFrame:
    """Every panel straight from the raw rows, in one scan.

    The yes or no answers of a row are packed into one number beside its classification, so the 13 indicators cost one
    grouping with few values and no counter of their own.
    """
    answers = [*d.SYMPTOMS, *d.COMORBIDITIES]
    bit = {name: 1 << i for i, name in enumerate(answers)}
    dead = 1 << len(answers)
    marks = " + ".join(f"IF({c} = {_text(d.YES)}, {bit[c]}, 0)" for c in answers)
    confirmed = f"Classificacao = {_text(d.CONFIRMED)}"
    rows = selected(raw, municipios, classes).select(
        "*", try_date(F.col("DataNotificacao")).alias("_date"), has_covid_death_loose(F.col("Evolucao")).alias("_death"),
    ).selectExpr(
        "Classificacao", f"{marks} + IF(_death, {dead}, 0) AS marcas", "Municipio", "FaixaEtaria", "year(_date) * 100 + month(_date) AS mes",
        f"IF({confirmed}, 1, 0) AS _confirmed", f"IF({confirmed} AND _death, 1, 0) AS _dead")
    keys = ["Classificacao", "marcas", "Municipio", "FaixaEtaria", "mes"]
    sums = rows.groupingSets([keys[:2], keys[2:3], keys[3:4], keys[4:]], *keys).agg(*map(F.expr, (
        "grouping_id() AS _set", "count(*) AS notificacoes", "sum(_confirmed) AS confirmados", "0L AS obitos", "sum(_dead) AS obitos_confirmados")))
    by_class, by_place, by_age, by_month = (f"_set = {mask}" for mask in (0b00111, 0b11011, 0b11101, 0b11110))
    marked = lambda mask: f"{by_class} AND (marcas & {mask}) = {mask}"
    entries = [
        *(f"IF({by_class}, {e}, NULL)" for e in _kpis("Classificacao")),
        _entry("class_distribution", "Classificacao", "notificacoes", when=f"{by_class} AND Classificacao IS NOT NULL"),
        *(_entry("symptoms", _text(c), "notificacoes", when=marked(bit[c])) for c in d.SYMPTOMS),
        *(_entry("comorbidities_in_deaths", _text(c), "notificacoes", when=marked(bit[c] | dead)) for c in d.COMORBIDITIES),
        _entry("top_municipios", "Municipio", "notificacoes", when=f"{by_place} AND Municipio IS NOT NULL"),
        _entry("lethality_by_municipio", "Municipio", "confirmados", "obitos_confirmados", when=f"{by_place} AND Municipio IS NOT NULL"),
        _entry("age_band", "FaixaEtaria", "notificacoes", when=f"{by_age} AND FaixaEtaria IS NOT NULL"),
        _entry("monthly_series", "concat_ws('-', lpad(mes div 100, 4, '0'), lpad(mes % 100, 2, '0'))", "notificacoes", when=f"{by_month} AND mes IS NOT NULL"),
    ]
    return _panels(sums.selectExpr(*MEASURES, _entries(entries)).selectExpr("painel", "chave", *_values()))


def by_panel(refreshed: DataFrame) -> dict[str, list[Row]]:
    """The rows of each panel, fetched in one job: a few hundred rows."""
    found: dict[str, list[Row]] = {}
    for row in refreshed.collect():
        found.setdefault(row.painel, []).append(row)
    return found
