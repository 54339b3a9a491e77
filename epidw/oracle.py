"""ANSI-style SQL for DuckDB that states what each registered query must return.

The statements are assembled from a chain of common table expressions (raw rows,
staging, dimensions, facts, mart) and use plain joins and global windows, so they
share no operator with the Spark side. They do share its raw rows, labels, regions
and key lists, which a test pins to literal values. Only for tests: on a cluster nothing
here runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from epidw import domain as d, registry as r, schemas
from epidw.sources.fixture import EXPRESSIONS

UNKNOWN = f"'{d.UNKNOWN}'"


def _quoted(values: Iterable[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _clean(column: str, default: str = d.UNKNOWN) -> str:
    return f"coalesce(nullif(trim({column}), ''), '{default}')"


def _upper(column: str) -> str:
    return f"upper({_clean(column, d.UNKNOWN_UPPER)})"


def _date(column: str) -> str:
    return f"try_cast({column} AS DATE)"


def _age(column: str) -> str:
    number = f"try_cast(regexp_extract({column}, '([0-9]+)', 1) AS SMALLINT)"
    return (
        f"CASE WHEN {column} IS NULL THEN NULL"
        f" WHEN regexp_full_match({column}, '[0-9]+') THEN try_cast({column} AS SMALLINT)"
        f" WHEN contains({column}, 'ano') THEN {number}"
        f" WHEN contains({column}, 'mes') OR contains({column}, 'dia') THEN CAST(0 AS SMALLINT)"
        f" ELSE {number} END"
    )


COLLECTION = _date(f"coalesce({', '.join(d.COLLECTION_DATES)})")


def _ones(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS SMALLINT)"


FLAGS = {
    "flag_confirmado": _ones(f"Classificacao_clean = '{d.CONFIRMED}'"),
    "flag_obito_covid": _ones(f"Evolucao_clean LIKE '%{d.COVID_DEATH_MARK}%'"),
    "flag_internado": _ones(f"{d.HOSPITALISED} = '{d.YES}'"),
    "flag_cura": _ones(f"Evolucao_clean = '{d.CURED}'"),
}
GAPS = {
    "dias_notif_encerramento": "CAST(date_diff('day', DataNotificacao_date, DataEncerramento_date) AS INT)",
    "dias_notif_obito": "CAST(date_diff('day', DataNotificacao_date, DataObito_date) AS INT)",
}


def _named(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def _raw() -> str:
    return (
        f"SELECT {_named(EXPRESSIONS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
        " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    )


def _staging() -> str:
    columns = {d.date_name(c): _date(c) for c in d.PLAIN_DATES} | {"DataColeta_date": COLLECTION}
    columns |= {d.clean_name(c): _upper(c) for c in d.PLACE}
    columns |= {d.clean_name(c): _clean(c) for j in d.JUNK_DIMENSIONS for c in j.attributes}
    columns |= {"Idade_clean": _age(d.AGE), d.HOSPITALISED: d.HOSPITALISED}
    return f"SELECT {_named(columns)} FROM raw"


def _calendar() -> str:
    months = f"list_extract([{_quoted(d.MONTHS)}], month(t))"
    weekdays = f"list_extract([{_quoted(d.WEEKDAYS)}], isodow(t))"
    parts = {
        "sk_tempo": "CAST(strftime(t, '%Y%m%d') AS INT)", "data": "CAST(t AS DATE)", "dia": "CAST(day(t) AS INT)",
        "mes": "CAST(month(t) AS INT)", "ano": "CAST(year(t) AS INT)", "trimestre": "CAST(quarter(t) AS INT)",
        "nome_mes": months, "dia_semana": weekdays, "semana_epidemiologica": "CAST(week(t) AS INT)",
        "ano_mes": "strftime(t, '%Y-%m')",
    }
    return (
        f"SELECT -1 AS sk_tempo, CAST(NULL AS DATE) AS data, 0 AS dia, 0 AS mes, 0 AS ano, 0 AS trimestre,"
        f" {UNKNOWN} AS nome_mes, {UNKNOWN} AS dia_semana, 0 AS semana_epidemiologica, {UNKNOWN} AS ano_mes UNION ALL"
        f" SELECT {_named(parts)} FROM generate_series(TIMESTAMP '{d.CALENDAR_START}', TIMESTAMP '{d.CALENDAR_END}',"
        " INTERVAL 1 DAY) s(t)"
    )


def _regions() -> str:
    rows = [
        f"('{m}', '{region}', '{macro}', {d.POPULATIONS.get(m, d.DEFAULT_POPULATION)})"
        for (region, macro), members in d.REGIONS.items() for m in members
    ]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) v(plain, regiao, macro, pop)"


def _region_columns(municipio: str) -> str:
    return (
        f"CASE WHEN plain IS NULL THEN '{d.ELSEWHERE}' ELSE '{d.HOME_STATE}' END AS uf,"
        f" coalesce(regiao, '{d.ELSEWHERE}') AS regiao_es, coalesce(macro, '{d.ELSEWHERE}') AS macrorregiao,"
        f" CAST(coalesce(pop, {d.DEFAULT_POPULATION}) AS INT) AS populacao_municipio"
    )


def _locality_base() -> str:
    upper = f"'{d.UNKNOWN_UPPER}'"
    return (
        f"SELECT -1 AS sk_local, {upper} AS municipio, {upper} AS bairro, {upper} AS uf, {upper} AS regiao_es,"
        f" {upper} AS macrorregiao, 0 AS populacao_municipio, DATE '{d.CALENDAR_START}' AS data_inicio,"
        f" CAST(NULL AS DATE) AS data_fim, true AS flag_atual, {upper} || '|' || {upper} AS nk_municipio_bairro UNION ALL"
        f" SELECT CAST(row_number() OVER (ORDER BY m, b) AS INT), m, b, {_region_columns('m')},"
        f" DATE '{d.CALENDAR_START}', NULL, true, m || '|' || b"
        " FROM (SELECT DISTINCT Municipio_clean AS m, Bairro_clean AS b FROM stg) p"
        " LEFT JOIN regions ON strip_accents(m) = plain"
        f" WHERE NOT (m = {upper} AND b = {upper})"
    )


def _locality() -> str:
    cases = " ".join(f"WHEN '{m}' THEN {n}" for m, n in d.POPULATION_CHANGES.items())
    named = f"municipio IN ({_quoted(d.POPULATION_CHANGES)})"
    change = f"DATE '{d.POPULATION_CHANGE_DATE}'"
    return (
        f"SELECT sk_local, municipio, bairro, uf, regiao_es, macrorregiao, populacao_municipio, data_inicio,"
        f" CASE WHEN {named} THEN {change} - 1 END AS data_fim, NOT {named} AS flag_atual, nk_municipio_bairro"
        " FROM loc_base UNION ALL"
        " SELECT CAST((SELECT max(sk_local) FROM loc_base) + row_number() OVER (ORDER BY municipio, bairro) AS INT),"
        f" municipio, bairro, uf, regiao_es, macrorregiao, CASE municipio {cases} END, {change}, NULL, true,"
        f" nk_municipio_bairro FROM loc_base WHERE {named}"
    )


def _junk(j: d.JunkDimension) -> str:
    names = list(j.attributes.values())
    listed = ", ".join(names)
    all_unknown = " AND ".join(f"{n} = {UNKNOWN}" for n in names)
    return (
        f"SELECT -1 AS {j.key}, " + ", ".join(f"{UNKNOWN} AS {n}" for n in names) + " UNION ALL"
        f" SELECT CAST(row_number() OVER (ORDER BY {listed}) AS INT), {listed}"
        " FROM (SELECT DISTINCT " + ", ".join(f"{c} AS {n}" for c, n in j.staged().items()) + " FROM stg) u"
        f" WHERE NOT ({all_unknown})"
    )


CTE_OF = {j.table: j.table.split(".")[1] for j in d.JUNK_DIMENSIONS} | {
    "dw.dim_tempo": "dim_tempo", "dw.dim_localidade": "dim_localidade",
    "dw.fato_notificacao_covid": "fato", "dw.fato_exame": "exame",
}

LOCALITY_MATCH = (
    "s.Municipio_clean = l.municipio AND s.Bairro_clean = l.bairro"
    " AND (s.DataNotificacao_date IS NULL OR s.DataNotificacao_date >= l.data_inicio)"
    " AND (l.data_fim IS NULL OR s.DataNotificacao_date <= l.data_fim)"
)


def _junk_join(j: d.JunkDimension) -> str:
    match = " AND ".join(f"s.{c} = {j.key}_d.{a}" for c, a in j.staged().items())
    return f" LEFT JOIN {CTE_OF[j.table]} {j.key}_d ON {match}"


def _fact() -> str:
    columns = {role: f"coalesce({role}_d.sk_tempo, -1)" for role in d.DATE_ROLES}
    columns |= {"sk_data_Campanhas": "CAST(NULL AS INT)", "sk_local": "coalesce(l.sk_local, -1)"}
    columns |= {j.key: f"coalesce({j.key}_d.{j.key}, -1)" for j in d.JUNK_DIMENSIONS}
    columns |= FLAGS | {"idade_anos": "Idade_clean"} | GAPS | {"qtd_notificacao": "1"}
    ordered = {f.name: columns[f.name] for f in schemas.TABLES["dw.fato_notificacao_covid"]}
    return (
        f"SELECT {_named(ordered)} FROM stg s LEFT JOIN dim_localidade l ON {LOCALITY_MATCH}"
        + "".join(map(_junk_join, d.JUNK_DIMENSIONS))
        + "".join(f" LEFT JOIN dim_tempo {role}_d ON s.{date} = {role}_d.data" for role, date in d.DATE_ROLES.items())
    )


def _exam() -> str:
    results = [c for c, a in d.TEST_DIM.staged().items() if a in d.RESULT_ATTRIBUTES]
    positive = " OR ".join(f"{c} = '{d.POSITIVE}'" for c in results)
    known = " OR ".join(f"{c} <> {UNKNOWN}" for c in results)
    payload = "sk_data_coleta, sk_local, sk_perfil, sk_teste, flag_positivo"
    return (
        f"SELECT row_number() OVER (ORDER BY {payload}) AS sk_fato_exame, sk_data_coleta, -1 AS sk_data_resultado,"
        " sk_local, sk_perfil, sk_teste, CAST(1 AS SMALLINT) AS qtd_exames, flag_positivo,"
        " CAST(NULL AS INT) AS dias_coleta_result FROM (SELECT coalesce(c.sk_tempo, -1) AS sk_data_coleta,"
        " coalesce(l.sk_local, -1) AS sk_local, coalesce(sk_perfil_d.sk_perfil, -1) AS sk_perfil,"
        f" coalesce(sk_teste_d.sk_teste, -1) AS sk_teste, {_ones(positive)} AS flag_positivo"
        f" FROM stg s LEFT JOIN dim_localidade l ON {LOCALITY_MATCH}"
        + _junk_join(d.PROFILE_DIM) + _junk_join(d.TEST_DIM)
        + f" LEFT JOIN dim_tempo c ON s.DataColeta_date = c.data WHERE {known}) e"
    )


MART = (
    "SELECT municipio, ano_mes, CAST(sum(flag_confirmado) AS BIGINT) AS confirmados,"
    " CAST(sum(flag_obito_covid) AS BIGINT) AS obitos, CAST(sum(flag_internado) AS BIGINT) AS internacoes,"
    " CAST(sum(qtd_notificacao) AS BIGINT) AS notificacoes FROM fato f JOIN dim_localidade l USING (sk_local)"
    " JOIN dim_tempo t ON t.sk_tempo = f.sk_data_notificacao GROUP BY ALL"
)


def _within(select: str, **renamed: str) -> str:
    """A statement over tables that stand for others."""
    return f"WITH {', '.join(f'{name} AS (SELECT * FROM {other})' for name, other in renamed.items())} {select}"


def _second_raw() -> str:
    changed = ", ".join(f"{r.CHANGED[1]} AS {c}" if c == r.CHANGED[0] else c for c in d.RAW_COLUMNS)
    added = ", ".join(f"{r.ADDED_VALUES.get(c, c)} AS {c}" for c in d.RAW_COLUMNS)
    return f"SELECT {changed} FROM raw WHERE NOT coalesce({r.GONE}, false) UNION ALL SELECT {added} FROM raw WHERE {r.ADDED}"


def _second_locality() -> str:
    """The old rows, and the rows of new places as a full load has them, numbered on."""
    full = _within(f"SELECT * FROM (WITH loc_base AS ({_locality_base()}) {_locality()}) x", stg="stg2")
    columns = ", ".join(f.name for f in schemas.TABLES["dw.dim_localidade"] if f.name != "sk_local")
    return (
        "SELECT * FROM dim_localidade UNION ALL SELECT CAST((SELECT max(sk_local) FROM dim_localidade)"
        f" + row_number() OVER (ORDER BY municipio, bairro, data_inicio) AS INT), {columns} FROM ({full}) n"
        " WHERE nk_municipio_bairro NOT IN (SELECT nk_municipio_bairro FROM dim_localidade)"
    )


def _second_junk(j: d.JunkDimension) -> str:
    listed, table = ", ".join(j.attributes.values()), CTE_OF[j.table]
    named = ", ".join(f"{c} AS {a}" for c, a in j.staged().items())
    return (
        f"SELECT * FROM {table} UNION ALL SELECT CAST((SELECT max({j.key}) FROM {table})"
        f" + row_number() OVER (ORDER BY {listed}) AS INT), {listed} FROM"
        f" (SELECT DISTINCT {named} FROM stg2 EXCEPT SELECT {listed} FROM {table}) n"
    )


def _second() -> dict[str, tuple[str, tuple[str, ...]]]:
    """The tables of the second load."""
    dims = ("dim_localidade", *(CTE_OF[j.table] for j in d.JUNK_DIMENSIONS))
    seconds = {name: f"{name}2" for name in dims}
    return {
        "raw2": (_second_raw(), ("raw",)),
        "stg2": (_within(_staging(), raw="raw2"), ("raw2",)),
        "dim_localidade2": (_second_locality(), ("dim_localidade", "stg2", "regions")),
        **{f"{CTE_OF[j.table]}2": (_second_junk(j), (CTE_OF[j.table], "stg2")) for j in d.JUNK_DIMENSIONS},
        "fato2": (_within(_fact(), stg="stg2", **seconds), ("stg2", "dim_tempo", *seconds.values())),
        "mart2": (_within(MART, fato="fato2", dim_localidade="dim_localidade2"), ("fato2", "dim_localidade2", "dim_tempo")),
    }


def _changes(before: str, after: str, columns: Iterable[str]) -> str:
    """Rows whose number differs between two bags, with the difference."""
    listed = ", ".join(columns)
    return (
        f"SELECT {listed}, CAST(sum(n) AS BIGINT) AS variacao FROM (SELECT {listed}, -1 AS n FROM {before} UNION ALL"
        f" SELECT {listed}, 1 FROM {after}) x GROUP BY ALL HAVING sum(n) <> 0"
    )


def _increments() -> dict[str, str]:
    fact_columns = schemas.TABLES["dw.fato_notificacao_covid"].names
    return {
        "staging_delta": with_tables(_changes("raw", "raw2", d.RAW_COLUMNS), "raw", "raw2"),
        "dim_second_load": with_tables("SELECT * FROM dim_localidade2", "dim_localidade2"),
        "dim_perfil_second_load": with_tables("SELECT * FROM dim_perfil_paciente2", "dim_perfil_paciente2"),
        "fact_delta": with_tables(_changes("fato", "fato2", fact_columns), "fato", "fato2"),
        "mart_incremental": with_tables("SELECT * FROM mart2", "mart2"),
    }


def _histories() -> dict[str, str]:
    changes = (
        "SELECT CAST(c_nationkey AS BIGINT) AS nacao, CAST(o_orderdate AS DATE) AS dia, o_orderstatus AS estado, o_orderpriority AS prioridade"
        " FROM orders JOIN customer ON o_custkey = c_custkey"
    )
    timeline = (
        "SELECT nacao, estado, prioridade, dia AS data_inicio, CAST(lead(dia) OVER w - INTERVAL 1 DAY AS DATE) AS data_fim,"
        " lead(dia) OVER w IS NULL AS flag_atual FROM (SELECT *, lag(s) OVER (PARTITION BY nacao ORDER BY dia) AS antes FROM ("
        "SELECT nacao, dia, estado, prioridade, (estado, prioridade) AS s, row_number() OVER (PARTITION BY nacao, dia"
        f" ORDER BY estado DESC, prioridade DESC) AS n FROM ({changes}) c) d WHERE n = 1) e WHERE antes IS NULL OR antes <> s"
        " WINDOW w AS (PARTITION BY nacao ORDER BY dia)"
    )
    deep = (
        f"WITH v AS ({timeline}), s AS (SELECT CAST(c_nationkey AS BIGINT) AS nacao,"
        " CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) - INTERVAL 90 DAY AS DATE) END AS embarque"
        " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"
        " SELECT s.nacao, embarque, CASE WHEN v.nacao IS NOT NULL THEN concat_ws('|', v.nacao, data_inicio, estado, prioridade) END AS versao,"
        " count(*) AS linhas FROM s LEFT JOIN v ON s.nacao = v.nacao AND (embarque IS NULL OR embarque >= data_inicio)"
        " AND (data_fim IS NULL OR embarque <= data_fim) GROUP BY ALL"
    )
    given = ", ".join(f"(DATE '{day}', {n})" for day, n in r.LATE_CHANGES)
    rest = "municipio, bairro, uf, regiao_es, macrorregiao"
    late = (
        f"SELECT * FROM dim_localidade WHERE municipio <> 'VITORIA' UNION ALL"
        f" SELECT coalesce(old_key, CAST((SELECT max(sk_local) FROM dim_localidade) + count(*) FILTER (WHERE old_key IS NULL)"
        f" OVER (ORDER BY nk, since ROWS UNBOUNDED PRECEDING) AS INT)), {rest}, populacao, since,"
        " CAST(lead(since) OVER (PARTITION BY nk ORDER BY since) - INTERVAL 1 DAY AS DATE),"
        " lead(since) OVER (PARTITION BY nk ORDER BY since) IS NULL, nk FROM ("
        f"SELECT nk_municipio_bairro AS nk, {rest}, coalesce(g.n, populacao_municipio) AS populacao, data_inicio AS since,"
        " CASE WHEN g.n IS NULL OR g.n = populacao_municipio THEN sk_local END AS old_key FROM dim_localidade l"
        f" LEFT JOIN (VALUES {given}) g(dia, n) ON g.dia = l.data_inicio WHERE municipio = 'VITORIA' UNION ALL"
        f" SELECT nk_municipio_bairro, {rest}, g.n, g.dia, NULL FROM (SELECT DISTINCT nk_municipio_bairro, {rest} FROM dim_localidade"
        f" WHERE municipio = 'VITORIA') p CROSS JOIN (VALUES {given}) g(dia, n) WHERE NOT EXISTS (SELECT 1 FROM dim_localidade o"
        " WHERE o.nk_municipio_bairro = p.nk_municipio_bairro AND o.data_inicio = g.dia)) u"
    )
    return {"scd2_timeline": timeline, "scd2_asof_deep": deep, "scd2_late_changes": with_tables(late, "dim_localidade")}


def _chain() -> dict[str, tuple[str, tuple[str, ...]]]:
    """CTE name -> (definition, names it needs)."""
    junk = {CTE_OF[j.table]: (_junk(j), ("stg",)) for j in d.JUNK_DIMENSIONS}
    return {
        "raw": (_raw(), ()),
        "stg": (_staging(), ("raw",)),
        "dim_tempo": (_calendar(), ()),
        "regions": (_regions(), ()),
        "loc_base": (_locality_base(), ("stg", "regions")),
        "dim_localidade": (_locality(), ("loc_base",)),
        **junk,
        "fato": (_fact(), ("stg", "dim_tempo", "dim_localidade", *junk)),
        "exame": (_exam(), ("stg", "dim_tempo", "dim_localidade", "dim_perfil_paciente", "dim_teste")),
        "mart": (MART, ("fato", "dim_localidade", "dim_tempo")),
        **_second(),
    }


def with_tables(select: str, *names: str) -> str:
    """The statement preceded by the named CTEs and everything they depend on."""
    chain = _chain()
    needed: dict[str, None] = {}

    def visit(name: str) -> None:
        for other in chain[name][1]:
            visit(other)
        needed.setdefault(name)

    for name in names:
        visit(name)
    listed = ", ".join(f"{name} AS MATERIALIZED ({chain[name][0]})" for name in needed)
    return f"WITH {listed} {select}"


def _count(select: str, source: str) -> str:
    return f"SELECT {select}, count(*) AS linhas FROM {source} GROUP BY ALL"


def _per_column(columns: Iterable[str], one: str) -> str:
    return " UNION ALL ".join(one.format(c=c) for c in columns)


def _where(*conditions: str) -> str:
    present = [c for c in conditions if c]
    return f" WHERE {' AND '.join(present)}" if present else ""


def _in(column: str, values: Iterable[str]) -> str:
    values = tuple(values)
    return f"{column} IN ({_quoted(values)})" if values else ""


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(100.0 * {part} / {whole}, 2) ELSE 0.0 END"


YES = f"'{d.YES}'"
LOOSE_DEATH = f"Evolucao LIKE '%{d.COVID_DEATH_LOOSE_MARK}%'"


def _value_counts(column: str, where: str) -> str:
    return f"SELECT {column}, count(*) AS total FROM raw{where} GROUP BY 1"


def _direct(municipios: tuple[str, ...], classes: tuple[str, ...]) -> dict[str, str]:
    return {name: with_tables(sql, "raw") for name, sql in _direct_panels(municipios, classes).items()}


def _direct_panels(municipios: tuple[str, ...], classes: tuple[str, ...]) -> dict[str, str]:
    chosen = [_in("Municipio", municipios), _in("Classificacao", classes)]
    where = _where(*chosen)

    def present(column: str) -> str:
        return _where(*chosen, f"{column} IS NOT NULL")

    lethal = (
        "SELECT *, {share} AS taxa_pct, printf('%.2f%%', {share}) AS taxa_letalidade FROM ("
        f"SELECT Municipio, count(*) AS casos_confirmados, count(*) FILTER (WHERE {LOOSE_DEATH}) AS obitos_covid"
        f" FROM raw{_where(*chosen, 'Municipio IS NOT NULL', f_confirmed())} GROUP BY 1"
        " ORDER BY casos_confirmados DESC, Municipio LIMIT 5) x"
    ).format(share=_share("obitos_covid", "casos_confirmados"))
    month = f"CAST(date_trunc('month', {_date('DataNotificacao')}) AS DATE)"
    statements = {
        "kpis": (
            "SELECT count(*) AS total,"
            f" count(*) FILTER (WHERE Classificacao = '{d.SUSPECTED}') AS suspeitos,"
            f" count(*) FILTER (WHERE Classificacao = '{d.CONFIRMED}') AS confirmados FROM raw{where}"
        ),
        "class_distribution": _value_counts("Classificacao", present("Classificacao")),
        "top_municipios": _value_counts("Municipio", present("Municipio")) + " ORDER BY total DESC, Municipio LIMIT 10",
        "age_band": _value_counts("FaixaEtaria", present("FaixaEtaria")),
        "symptoms": _per_column(
            d.SYMPTOMS, f"SELECT '{{c}}' AS sintoma, count(*) FILTER (WHERE {{c}} = {YES}) AS registros FROM raw{where}"
        ),
        "comorbidities_in_deaths": _per_column(
            d.COMORBIDITIES,
            f"SELECT '{{c}}' AS comorbidade, count(*) FILTER (WHERE {{c}} = {YES}) AS obitos FROM raw"
            + _where(*chosen, LOOSE_DEATH),
        ),
        "monthly_series": (
            f"SELECT {month} AS mes, count(*) AS total FROM raw"
            f"{_where(*chosen, _date('DataNotificacao') + ' IS NOT NULL')} GROUP BY 1"
        ),
        "lethality_by_municipio": lethal,
    }
    return statements


def f_confirmed(column: str = "Classificacao") -> str:
    return f"{column} = '{d.CONFIRMED}'"


BASE = ("fato", "dim_localidade", "dim_classificacao")


def _dw(municipios: tuple[str, ...], classes: tuple[str, ...]) -> dict[str, str]:
    return {name: with_tables(sql, *BASE, *more) for name, (sql, more) in _dw_panels(municipios, classes).items()}


def _dw_panels(municipios: tuple[str, ...], classes: tuple[str, ...]) -> dict[str, tuple[str, tuple[str, ...]]]:
    chosen = [_in("l.municipio", municipios), _in("c.classificacao", classes)]
    star = "fato f JOIN dim_localidade l USING (sk_local) JOIN dim_classificacao c USING (sk_class)"

    def total(expression: str) -> str:
        return f"CAST(coalesce(sum({expression}), 0) AS BIGINT)"

    def grouped(column: str, joins: str = "", *more: str) -> str:
        return f"SELECT {column}, CAST(sum(qtd_notificacao) AS BIGINT) AS total FROM {star}{joins}{_where(*chosen, *more)} GROUP BY 1"

    def indicators(j: d.JunkDimension, label: str, count: str, *more: str) -> str:
        source = f"FROM {star} JOIN {CTE_OF[j.table]} x USING ({j.key}){_where(*chosen, *more)}"
        return " UNION ALL ".join(
            f"SELECT '{raw}' AS {label}, {total(f'CASE WHEN x.{a} = {YES} THEN 1 ELSE 0 END')} AS {count} {source}"
            for raw, a in j.attributes.items()
        )

    lethal = (
        "WITH_HERE SELECT municipio, casos_confirmados, obitos_covid, {share} AS taxa_pct,"
        " CAST({share} AS VARCHAR) || '%' AS taxa_letalidade FROM ("
        "SELECT l.municipio, CAST(sum(flag_confirmado) AS BIGINT) AS casos_confirmados,"
        " CAST(sum(CASE WHEN flag_confirmado = 1 THEN flag_obito_covid ELSE 0 END) AS BIGINT) AS obitos_covid"
        f" FROM {star}{_where(*chosen, f_confirmed('c.classificacao'))} GROUP BY 1"
        " ORDER BY casos_confirmados DESC, municipio LIMIT 5) x"
    ).format(share=f"CAST({_share('obitos_covid', 'casos_confirmados')} AS DOUBLE)").replace("WITH_HERE ", "")
    statements = {
        "kpis": (
            f"SELECT {total('qtd_notificacao')} AS total,"
            f" {total(f'''CASE WHEN c.classificacao = '{d.SUSPECTED}' THEN qtd_notificacao END''')} AS suspeitos,"
            f" {total(f'''CASE WHEN c.classificacao = '{d.CONFIRMED}' THEN qtd_notificacao END''')} AS confirmados"
            f" FROM {star}{_where(*chosen)}",
            (),
        ),
        "class_distribution": (grouped("c.classificacao"), ()),
        "top_municipios": (grouped("l.municipio") + " ORDER BY total DESC, 1 LIMIT 10", ()),
        "age_band": (grouped("p.faixa_etaria", " JOIN dim_perfil_paciente p USING (sk_perfil)"), ()),
        "symptoms": (indicators(d.SYMPTOM_DIM, "sintoma", "registros"), ()),
        "comorbidities_in_deaths": (
            indicators(d.COMORBIDITY_DIM, "comorbidade", "obitos", f"c.evolucao LIKE '%{d.COVID_DEATH_MARK}%'"), ()
        ),
        "monthly_series": (
            grouped(
                "CAST(t.ano_mes || '-01' AS DATE) AS mes",
                " JOIN dim_tempo t ON t.sk_tempo = f.sk_data_notificacao", "t.sk_tempo <> -1",
            ),
            ("dim_tempo",),
        ),
        "lethality_by_municipio": (lethal, ()),
    }
    return statements


def _panels() -> dict[str, str]:
    found = {}
    for name, sql in _direct((), ()).items():
        found[f"{name}_direct"] = sql
    for name, sql in _direct(r.RAW_MUNICIPIOS, r.CLASSES).items():
        found[f"{name}_direct_filtered"] = sql
    for suffix, chosen in (
        ("dw", ((), ())), ("dw_filtered", (r.WAREHOUSE_MUNICIPIOS, r.CLASSES)), ("dw_municipios", (r.WAREHOUSE_MUNICIPIOS, ()))
    ):
        for name, sql in _dw(*chosen).items():
            found[f"{name}_{suffix}"] = sql
    return found


def _refreshed(panels: dict[str, str]) -> str:
    """All panels below each other, from the statement of each."""
    municipio = "municipio"  # names are compared without case
    columns = {
        "class_distribution": "Classificacao", "top_municipios": municipio, "age_band": "FaixaEtaria",
        "symptoms": "sintoma", "comorbidities_in_deaths": "comorbidade", "monthly_series": "strftime(mes, '%Y-%m')",
    }
    values = {"symptoms": "registros", "comorbidities_in_deaths": "obitos"}
    none = "CAST(NULL AS BIGINT) AS segundo, CAST(NULL AS DOUBLE) AS taxa_pct"
    parts = [f"SELECT 'kpis' AS painel, '{k}' AS chave, CAST({k} AS BIGINT) AS valor, {none} FROM ({panels['kpis']}) k" for k in ("total", "suspeitos", "confirmados")]
    for name, column in columns.items():
        column = "faixa_etaria" if column == "FaixaEtaria" and "faixa_etaria" in panels[name] else column
        parts.append(f"SELECT '{name}', {column}, CAST({values.get(name, 'total')} AS BIGINT), {none} FROM ({panels[name]}) p")
    parts.append(
        f"SELECT 'lethality_by_municipio', {municipio}, casos_confirmados, obitos_covid, CAST(taxa_pct AS DOUBLE)"
        f" FROM ({panels['lethality_by_municipio']}) p"
    )
    return " UNION ALL ".join(parts)


def _refreshes() -> dict[str, str]:
    found = {}
    for suffix, raw_choice, clean_choice in (
        ("", ((), ()), ((), ())), ("_filtered", (r.RAW_MUNICIPIOS, r.CLASSES), (r.WAREHOUSE_MUNICIPIOS, r.CLASSES))
    ):
        found[f"refresh_all_direct{suffix}"] = with_tables(_refreshed(_direct_panels(*raw_choice)), "raw")
        panels = {name: sql for name, (sql, _) in _dw_panels(*clean_choice).items()}
        stars = with_tables(_refreshed(panels), *BASE, "dim_tempo", "dim_perfil_paciente", "dim_sintomas", "dim_comorbidade")
        found[f"refresh_all_dw{suffix}"] = found[f"refresh_stored{suffix}"] = stars
    return found


#: the stored table that each request of the navigation query must be answered from
ROUTES = {
    "faixa e sexo": "mart.agg_class_perfil", "classe em municipios": "mart.agg_local_class_como",
    "regiao em anos": "mart.agg_local_class_mes", "febre dos confirmados": "mart.agg_local_class_sint",
    "diabetes nos obitos": "mart.agg_local_class_como", "bairro por sexo": "mart.agg_local_class_perfil",
    "evolucao por mes": "mart.agg_local_class_mes", "febre por sexo": "dw.fato_notificacao_covid",
}


def _navigation() -> str:
    """Every request answered from the fact."""
    sums = {
        "notificacoes": "qtd_notificacao", "confirmados": "flag_confirmado", "obitos": "flag_obito_covid",
        "internacoes": "flag_internado", "obitos_confirmados": "flag_confirmado * flag_obito_covid",
    }
    joined = (
        "fato JOIN dim_localidade USING (sk_local) JOIN dim_classificacao USING (sk_class) JOIN dim_perfil_paciente USING (sk_perfil)"
        " JOIN dim_sintomas USING (sk_sint) JOIN dim_comorbidade USING (sk_como) JOIN dim_tempo ON sk_tempo = sk_data_notificacao"
    )
    parts = []
    for name, request in r.REQUESTS.items():
        key = f"concat_ws('|', {', '.join(f'CAST({a} AS VARCHAR)' for a in request.attributes)})" if request.attributes else "''"
        where = _where(*(f"{a} IN ({', '.join(repr(v) for v in values)})" for a, values in request.filters.items()))
        group = f" GROUP BY {', '.join(request.attributes)}" if request.attributes else ""
        parts += [
            f"SELECT '{name}' AS pedido, '{ROUTES.get(name, 'mart.mv_resumo_municipio_mes')}' AS rota, {key} AS chave, '{m}' AS medida,"
            f" CAST(coalesce(sum({sums[m]}), 0) AS BIGINT) AS valor FROM {joined}{where}{group}" for m in request.measures
        ]
    dims = ("dim_localidade", "dim_classificacao", "dim_perfil_paciente", "dim_sintomas", "dim_comorbidade", "dim_tempo")
    return with_tables(" UNION ALL ".join(parts), "fato", *dims)


def _quality() -> dict[str, str]:
    dims = {table: CTE_OF[table] for table in schemas.DIMENSION_KEYS}
    tables = tuple(dict.fromkeys([*dims.values(), "fato", "exame"]))
    unknown = " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, count(*) FILTER (WHERE {schemas.DIMENSION_KEYS[t]} = -1) AS membros FROM {cte}"
        for t, cte in dims.items()
    )
    primary = " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, '{key}' AS chave,"
        " CAST(coalesce(sum(n - 1) FILTER (WHERE k IS NOT NULL), 0) AS BIGINT) AS duplicadas,"
        " CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS nulas"
        f" FROM (SELECT {key} AS k, count(*) AS n FROM {CTE_OF[t]} GROUP BY 1) x"
        for t, key in schemas.PRIMARY_KEYS.items()
    )

    def orphan(fk: schemas.ForeignKey) -> str:
        key = schemas.DIMENSION_KEYS[fk.dimension]
        return (
            f"SELECT '{fk.fact}' AS fato, '{fk.column}' AS coluna, '{fk.dimension}' AS dimensao, count(*) AS orfaos"
            f" FROM {CTE_OF[fk.fact]} f LEFT JOIN {CTE_OF[fk.dimension]} x ON x.{key} = f.{fk.column} WHERE x.{key} IS NULL"
        )

    def missing(column: str, dim: str, key: str) -> str:
        return f"FROM fato f WHERE NOT EXISTS (SELECT 1 FROM {dim} x WHERE x.{key} = f.{column})"

    local, tempo = missing("sk_local", "dim_localidade", "sk_local"), missing("sk_data_notificacao", "dim_tempo", "sk_tempo")
    keys = " UNION ALL ".join(
        f"SELECT 'chave:{t}' AS verificacao, m AS m, dup AS dup, nul AS nul, {'m = 0' if t in dims else 'false'} AS lacks FROM ("
        f"SELECT CAST(coalesce(sum(n) FILTER (WHERE k = -1), 0) AS BIGINT) AS m,"
        " CAST(coalesce(sum(n - 1) FILTER (WHERE k IS NOT NULL), 0) AS BIGINT) AS dup,"
        " CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS nul"
        f" FROM (SELECT {key} AS k, count(*) AS n FROM {CTE_OF[t]} GROUP BY 1) g) h"
        for t, key in schemas.PRIMARY_KEYS.items()
    )
    orphans = " UNION ALL ".join(map(orphan, schemas.FOREIGN_KEYS))
    required = " UNION ALL ".join(
        f"SELECT 'obrigatoria:{t}.{c}' AS verificacao, count(*) FILTER (WHERE {c} IS NULL) AS n FROM {CTE_OF[t]}"
        for t, columns in schemas.REQUIRED.items() for c in columns
    )
    results = [c for c, a in d.TEST_DIM.staged().items() if a in d.RESULT_ATTRIBUTES]
    known = " OR ".join(f"{c} <> {UNKNOWN}" for c in results)
    three = (
        "SELECT 'linhas_staging' AS medida, count(*) AS n FROM stg UNION ALL"
        " SELECT 'linhas_fato', count(*) FROM fato UNION ALL"
        " SELECT 'soma_quantidade', CAST(coalesce(sum(qtd_notificacao), 0) AS BIGINT) FROM fato"
    )
    two = f"SELECT count(*) FILTER (WHERE {known}) AS n FROM stg UNION ALL SELECT count(*) FROM exame"

    def state(ok: str) -> str:
        return f"CASE WHEN {ok} THEN 'OK' ELSE 'ERRO' END AS situacao"

    report = (
        f"SELECT verificacao, {state('dup = 0 AND nul = 0 AND NOT lacks')}, concat_ws('/', m, dup, nul) AS detalhe FROM ({keys}) k"
        f" UNION ALL SELECT 'orfaos:' || fato || '.' || coluna, {state('orfaos = 0')}, CAST(orfaos AS VARCHAR) FROM ({orphans}) o"
        f" UNION ALL SELECT verificacao, {state('n = 0')}, CAST(n AS VARCHAR) FROM ({required}) q"
        f" UNION ALL SELECT 'reconciliacao:notificacoes', {state('min(n) = max(n)')}, concat_ws('..', min(n), max(n)) FROM ({three}) a"
        f" UNION ALL SELECT 'reconciliacao:exames', {state('min(n) = max(n)')}, concat_ws('..', min(n), max(n)) FROM ({two}) b"
    )
    return {
        "dq_unknown_members": with_tables(unknown, *dims.values()),
        "dq_orphans_local": with_tables(f"SELECT count(*) AS orfaos {local}", *tables),
        "dq_orphans_tempo": with_tables(f"SELECT count(*) AS orfaos {tempo}", *tables),
        "dq_orphans_not_exists": with_tables(
            f"SELECT 'sk_local' AS coluna, count(*) AS orfaos {local} UNION ALL"
            f" SELECT 'sk_data_notificacao', count(*) {tempo}", *tables,
        ),
        "dq_reconcile": with_tables(three, "stg", "fato"),
        "dq_pk_unique": with_tables(primary, *tables),
        "dq_fk_orphans_all": with_tables(orphans, *tables),
        "dq_report": with_tables(report, "stg", *tables),
    }


def _profiles() -> dict[str, str]:
    def counted(test: str) -> str:
        return _per_column(
            d.RAW_COLUMNS, f"SELECT '{{c}}' AS coluna, count(*) FILTER (WHERE {test}) AS nulos, count(*) AS linhas FROM raw"
        )

    def report(test: str, where: str = "") -> str:
        return f"SELECT coluna, nulos, {_share('nulos', 'linhas')} AS pct_nulo FROM ({counted(test)}) x{where}"

    def frequencies(column: str) -> str:
        return (
            f"SELECT {column}, frequencia, round(100.0 * frequencia / sum(frequencia) OVER (), 2) AS percentual FROM"
            f" (SELECT {column}, count(*) AS frequencia FROM raw WHERE {column} IS NOT NULL GROUP BY 1) x"
        )

    def first(column: str) -> str:
        return _value_counts(column, f" WHERE {column} IS NOT NULL") + f" ORDER BY total DESC, {column} LIMIT 1"

    names = ("obitos_covid", "obitos_outras_causas", "cura", "ignorado")
    outcomes = ", ".join(f"count(*) FILTER (WHERE Evolucao = '{v}') AS {n}" for n, v in zip(names, d.OUTCOMES))
    confirmed = f"SELECT count(*) AS total_confirmados, {outcomes} FROM raw WHERE {f_confirmed()}"
    exact = _per_column(
        d.COMORBIDITIES,
        f"SELECT '{{c}}' AS comorbidade, count(*) FILTER (WHERE {{c}} = {YES}) AS obitos FROM raw"
        f" WHERE Evolucao = '{d.COVID_DEATH}'",
    )
    busiest = (
        f"SELECT Municipio, count(*) AS casos, count(*) FILTER (WHERE Evolucao = '{d.COVID_DEATH}') AS obitos FROM raw"
        f" WHERE {f_confirmed()} AND Municipio IS NOT NULL GROUP BY 1 ORDER BY casos DESC, Municipio LIMIT 5"
    )
    crosstab = (
        f"SELECT Municipio, Evolucao, count(*) AS casos FROM raw WHERE {f_confirmed()} AND Evolucao IS NOT NULL"
        f" AND Municipio IN (SELECT Municipio FROM ({busiest}) b) GROUP BY 1, 2"
    )
    statements = {
        "null_report": report("{c} IS NULL", " WHERE nulos > 0"),
        "null_empty_report": report("{c} IS NULL OR {c} = ''"),
        "null_report_merged": report("{c} IS NULL", " WHERE nulos > 0"),
        "null_empty_report_merged": report("{c} IS NULL OR {c} = ''"),
        "table_profile": _per_column(
            d.RAW_COLUMNS,
            "SELECT '{c}' AS coluna, 'string' AS tipo, count(*) AS linhas, count({c}) AS nao_nulos FROM raw",
        ),
        "class_frequency_pct": frequencies("Classificacao"),
        "sex_distribution": frequencies("Sexo"),
        "leading_municipio": first("Municipio"),
        "leading_age_band": first("FaixaEtaria"),
        "outcomes_confirmed": confirmed,
        "lethality_overall": (
            f"SELECT total_confirmados, obitos_covid, {_share('obitos_covid', 'total_confirmados')} AS taxa_letalidade"
            f" FROM ({confirmed}) x"
        ),
        "comorbidities_in_deaths_exact": exact,
        "leading_comorbidity": f"SELECT * FROM ({exact}) x ORDER BY obitos DESC, comorbidade LIMIT 1",
        "monthly_series_strict": (
            "SELECT CAST(date_trunc('month', CAST(DataCadastro AS DATE)) AS DATE) AS mes, count(*) AS total FROM raw"
            " WHERE DataCadastro IS NOT NULL GROUP BY 1"
        ),
        "crosstab_top5": (
            f"SELECT t.Municipio, o.Evolucao, coalesce(c.casos, 0) AS casos FROM ({busiest}) t"
            f" CROSS JOIN (SELECT DISTINCT Evolucao FROM ({crosstab}) x) o"
            f" LEFT JOIN ({crosstab}) c ON c.Municipio = t.Municipio AND c.Evolucao = o.Evolucao"
        ),
        "highest_lethality": (
            f"SELECT Municipio, casos, obitos, {_share('obitos', 'casos')} AS taxa_letalidade FROM ({busiest}) b"
            " ORDER BY taxa_letalidade DESC, Municipio LIMIT 1"
        ),
        "filter_options_direct": " UNION ALL ".join(
            f"SELECT DISTINCT '{c.lower()}' AS filtro, {c} AS valor FROM raw WHERE {c} IS NOT NULL"
            for c in ("Municipio", "Classificacao")
        ),
        "scan_projected": f"SELECT {', '.join(d.DASHBOARD_COLUMNS)} FROM raw",
        "filter_in_lists": _count(
            "Municipio, Classificacao, Evolucao",
            "raw" + _where(_in("Municipio", r.RAW_MUNICIPIOS), _in("Classificacao", r.CLASSES)),
        ),
        "clean_text": " UNION ALL ".join(
            f"SELECT '{c}' AS coluna, {c} AS bruto, {_clean(c)} AS limpo, count(*) AS linhas FROM raw GROUP BY ALL"
            for j in d.JUNK_DIMENSIONS for c in j.attributes
        ),
        "clean_locality": _count(
            f"Municipio, Bairro, {_upper('Municipio')} AS municipio_limpo, {_upper('Bairro')} AS bairro_limpo", "raw"
        ),
        "try_date": _count(f"DataNotificacao AS bruto, {_date('DataNotificacao')} AS limpo", "raw"),
        "coalesce_collection_date": _count(f"{', '.join(d.COLLECTION_DATES)}, {COLLECTION} AS coleta", "raw"),
        "parse_age": _count(f"{d.AGE} AS bruto, {_age(d.AGE)} AS limpo", "raw"),
    }
    return {name: with_tables(sql, "raw") for name, sql in statements.items()}


def _modelling() -> dict[str, str]:
    daily = (
        "SELECT t.*, coalesce(n.linhas, 0) AS notificacoes FROM dim_tempo t LEFT JOIN"
        " (SELECT coalesce(c.sk_tempo, -1) AS sk_tempo, count(*) AS linhas FROM stg LEFT JOIN dim_tempo c"
        " ON DataNotificacao_date = c.data GROUP BY 1) n USING (sk_tempo)"
    )
    everything = "SELECT * FROM "
    municipios = "(SELECT DISTINCT Municipio_clean AS municipio FROM stg) m"
    flake = "municipio, regiao_es, macrorregiao, uf"
    upper = f"'{d.UNKNOWN_UPPER}'"
    municipio = (
        f"SELECT -1 AS sk_municipio, {upper} AS municipio, {upper} AS regiao_es, {upper} AS macrorregiao, {upper} AS uf UNION ALL"
        f" SELECT CAST(row_number() OVER (ORDER BY {flake}) AS INT), {flake}"
        f" FROM (SELECT DISTINCT {flake} FROM dim_localidade WHERE sk_local <> -1) x"
    )
    bairro = (
        f"SELECT -1 AS sk_bairro, {upper} AS bairro, -1 AS sk_municipio UNION ALL"
        f" SELECT x.sk_bairro, x.bairro, m.sk_municipio FROM (SELECT CAST(row_number() OVER (ORDER BY bairro, {flake}) AS INT)"
        f" AS sk_bairro, bairro, {flake} FROM (SELECT DISTINCT bairro, {flake} FROM dim_localidade WHERE sk_local <> -1) y) x"
        f" JOIN ({municipio}) m USING ({flake})"
    )
    day = f"DATE '{r.UPSERT_DAY}'"
    hit = "flag_atual AND municipio = 'VITORIA'"
    described = "municipio, uf, regiao_es, macrorregiao"
    upsert = (
        "SELECT sk_local, municipio, bairro, uf, regiao_es, macrorregiao, populacao_municipio, data_inicio,"
        f" CASE WHEN {hit} THEN {day} - 1 ELSE data_fim END AS data_fim, flag_atual AND NOT ({hit}) AS flag_atual,"
        " nk_municipio_bairro FROM dim_localidade UNION ALL"
        " SELECT CAST((SELECT max(sk_local) FROM dim_localidade) + row_number() OVER (ORDER BY nk) AS INT), municipio, bairro,"
        f" uf, regiao_es, macrorregiao, {r.UPSERT_POPULATION}, {day}, NULL, true, nk FROM ("
        f"SELECT bairro, {described}, nk_municipio_bairro AS nk FROM dim_localidade WHERE {hit} UNION ALL"
        f" SELECT DISTINCT '{r.UPSERT_BAIRRO}', {described}, municipio || '|{r.UPSERT_BAIRRO}' FROM dim_localidade WHERE {hit}) v"
    )
    roles = {role: f"coalesce({role}_d.sk_tempo, -1)" for role in d.DATE_ROLES}
    role_joins = "".join(f" LEFT JOIN dim_tempo {role}_d ON {date} = {role}_d.data" for role, date in d.DATE_ROLES.items())
    drilled = (
        "SELECT municipio, ano_mes, coalesce(a.notificacoes, 0) AS notificacoes, coalesce(a.confirmados, 0) AS confirmados,"
        " coalesce(b.exames, 0) AS exames, coalesce(b.positivos, 0) AS positivos FROM"
        " (SELECT municipio, ano_mes, notificacoes, confirmados FROM mart) a FULL OUTER JOIN"
        " (SELECT municipio, ano_mes, CAST(sum(qtd_exames) AS BIGINT) AS exames, CAST(sum(flag_positivo) AS BIGINT) AS positivos"
        " FROM exame JOIN dim_localidade USING (sk_local) JOIN dim_tempo ON sk_tempo = sk_data_coleta GROUP BY ALL) b"
        " USING (municipio, ano_mes)"
    )
    ranked = (
        "SELECT l.municipio, CAST(sum(qtd_notificacao) AS BIGINT) AS total, '{route}' AS rota FROM fato"
        f" JOIN dim_localidade l USING (sk_local){_where(_in('l.municipio', r.WAREHOUSE_MUNICIPIOS))} GROUP BY 1"
    )
    labels = " ".join(f"WHEN {a} = {YES} THEN '{label}'" for a, label in d.COMORBIDITY_LABELS)
    junk_names = ("dim_perfil", "dim_classificacao", "dim_sintomas", "dim_comorbidade", "dim_teste")
    return {
        "stg_notificacao": with_tables(everything + "stg", "stg"),
        "dim_tempo": with_tables(daily, "dim_tempo", "stg"),
        "dim_localidade_base": with_tables(everything + "loc_base", "loc_base"),
        "dim_localidade": with_tables(everything + "dim_localidade", "dim_localidade"),
        **{n: with_tables(everything + CTE_OF[j.table], CTE_OF[j.table]) for n, j in zip(junk_names, d.JUNK_DIMENSIONS)},
        "scd2_current": with_tables(everything + "dim_localidade WHERE flag_atual", "dim_localidade"),
        "scd2_upsert": with_tables(upsert, "dim_localidade"),
        "snowflake_municipio": with_tables(municipio, "dim_localidade"),
        "snowflake_bairro": with_tables(bairro, "dim_localidade"),
        "locality_region": with_tables(
            f"SELECT municipio, {_region_columns('municipio')} FROM {municipios}"
            " LEFT JOIN regions ON strip_accents(municipio) = plain", "stg", "regions",
        ),
        "remove_accents": with_tables(f"SELECT municipio, strip_accents(municipio) AS sem_acento FROM {municipios}", "stg"),
        "fact_flags": with_tables(
            f"SELECT Classificacao_clean, Evolucao_clean, {d.HOSPITALISED}, {_named(FLAGS)} FROM stg", "stg"
        ),
        "day_differences": with_tables(
            f"SELECT DataNotificacao_date, DataEncerramento_date, DataObito_date, {_named(GAPS)} FROM stg", "stg"
        ),
        "role_playing_dates": with_tables(f"SELECT {_named(roles)} FROM stg{role_joins}", "stg", "dim_tempo"),
        "scd2_asof_join": with_tables(
            "SELECT Municipio_clean, Bairro_clean, DataNotificacao_date, coalesce(l.sk_local, -1) AS sk_local"
            f" FROM stg s LEFT JOIN dim_localidade l ON {LOCALITY_MATCH}",
            "stg", "dim_localidade",
        ),
        "fato_notificacao": with_tables(everything + "fato", "fato"),
        "fato_exame": with_tables(everything + "exame", "exame"),
        "mart_municipio_mes": with_tables(everything + "mart", "mart"),
        "mart_equals_base": with_tables(
            f"SELECT (SELECT count(*) FROM (SELECT * FROM mart EXCEPT ALL {MART}) a) AS only_in_mart,"
            f" (SELECT count(*) FROM ({MART} EXCEPT ALL SELECT * FROM mart) b) AS only_in_base", "mart",
        ),
        "drill_across": with_tables(drilled, "mart", "exame"),
        "routed_top_municipios": with_tables(
            " UNION ALL ".join(ranked.format(route=route) for route in ("escolhida", "fato")), "fato", "dim_localidade"
        ),
        "filter_options": with_tables(
            f"SELECT DISTINCT 'municipio' AS filtro, municipio AS valor FROM dim_localidade WHERE municipio <> {upper} UNION ALL"
            f" SELECT DISTINCT 'classificacao', classificacao FROM dim_classificacao WHERE classificacao <> {UNKNOWN}",
            "dim_localidade", "dim_classificacao",
        ),
        "monthly_series_all": with_tables(
            "SELECT ano_mes, CAST(sum(qtd_notificacao) AS BIGINT) AS notificacoes FROM fato"
            " JOIN dim_tempo ON sk_tempo = sk_data_notificacao GROUP BY 1", "fato", "dim_tempo",
        ),
        "map_confirmed": with_tables(
            "SELECT municipio, CAST(sum(flag_confirmado) AS BIGINT) AS confirmados FROM fato"
            " JOIN dim_localidade USING (sk_local) GROUP BY 1", "fato", "dim_localidade",
        ),
        "age_pyramid": with_tables(
            "SELECT faixa_etaria, sexo, CAST(sum(flag_obito_covid) AS BIGINT) AS obitos FROM fato"
            " JOIN dim_perfil_paciente USING (sk_perfil) GROUP BY 1, 2", "fato", "dim_perfil_paciente",
        ),
        "top_comorbidities": with_tables(
            f"SELECT comorbidade, CAST(sum(flag_obito_covid) AS BIGINT) AS obitos FROM (SELECT CASE {labels} END AS comorbidade,"
            " flag_obito_covid FROM fato JOIN dim_comorbidade USING (sk_como)) x WHERE comorbidade IS NOT NULL GROUP BY 1"
            " ORDER BY obitos DESC, comorbidade LIMIT 5", "fato", "dim_comorbidade",
        ),
    }


def statements() -> dict[str, str]:
    return {**_profiles(), **_modelling(), **_quality(), **_panels(), **_refreshes(), **_increments(), **_histories(), "aggregate_navigation": _navigation()}
