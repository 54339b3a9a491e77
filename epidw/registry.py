"""Named queries over the test tables: every operator and panel as (spark, sf_dir) -> DataFrame.

The joined test tables, the staging table, the dimensions and the facts are written to
the application's shared folder the first time a query needs them, as they would be
in a warehouse; the query named after a table runs the operator that builds it. The
raw microdata, 45 columns of text, are written only for what reads their files; other
queries work out the raw columns they use from the joined tables, which are written once.
A query that reads staging in one pass does not write it for that either.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F

from epidw import domain as d
from epidw.functions import dates, measures, text
from epidw.operators import dimensions, facts, mart, profile, profile_state, quality, scd2
from epidw.operators.aggregates import Request
from epidw.operators.lookup import with_salt
from epidw.operators.staging import build_staging
from epidw.plans import direct, notebook, shared_refresh, star
from epidw.plans.incremental import IncrementalLoad
from epidw.plans.navigate import Navigator
from epidw.plans.pipeline import DIMENSIONS, STAGING, Load
from epidw.session import shared_folder, shuffles_dropped, tune
from epidw.sources.fixture import notified_lines, raw_columns
from epidw.sources.microdata import read_microdata

Query = Callable[[SparkSession, str], DataFrame]

# choices of the filtered panels; the raw file spells its municipios its own way
WAREHOUSE_MUNICIPIOS = ("VITORIA", "SERRA")
RAW_MUNICIPIOS = (" Vitoria ", "serra")
CLASSES = (d.CONFIRMED,)
#: requests of the navigation query: name -> what is asked
REQUESTS = {
    "total": Request((), ("notificacoes", "confirmados")),
    "municipio": Request(("municipio",), ("notificacoes", "obitos")),
    "mes": Request(("ano_mes",), ("internacoes",)),
    "ano e municipio": Request(("ano", "municipio"), ("confirmados", "obitos")),
    "municipios de um mes": Request(("municipio",), filters={"ano_mes": ("2020-07",)}),
    "faixa e sexo": Request(("faixa_etaria", "sexo"), ("obitos",)),
    "classe em municipios": Request(("classificacao",), filters={"municipio": WAREHOUSE_MUNICIPIOS}),
    "regiao em anos": Request(("regiao_es",), filters={"ano": (2020, 2021)}),
    "febre dos confirmados": Request(("febre",), filters={"classificacao": CLASSES}),
    "diabetes nos obitos": Request(("com_diabetes",), ("obitos_confirmados",)),
    "bairro por sexo": Request(("bairro",), filters={"sexo": ("F",)}),
    "evolucao por mes": Request(("ano_mes", "evolucao"), ("notificacoes",)),
    "febre por sexo": Request(("febre", "sexo"), ("notificacoes", "obitos")),
}
UPSERT_DAY = dt.date(2023, 6, 1)
LATE_CHANGES = ((dt.date(2010, 8, 1), 320_000), (dt.date(2022, 1, 1), 375_000), (dt.date(2024, 3, 1), 380_000))
UPSERT_POPULATION = 372_000
UPSERT_BAIRRO = "CENTRO NOVO"

#: the second snapshot: raw rows that are gone, that change, and that come in addition, in syntax Spark and DuckDB share
GONE = "DataCadastro LIKE '%-13'"
CHANGED = ("Evolucao", "CASE WHEN Municipio = 'serra' AND Evolucao = 'Ignorado' THEN 'Cura' ELSE Evolucao END")
ADDED = "Municipio = ' Vitoria ' AND Bairro = 'BUILDING'"
ADDED_VALUES = {"Bairro": "'Centro Novo'", "FaixaEtaria": "'5 a 9 anos'"}

_increments: dict[tuple[str, str], IncrementalLoad] = {}
_loads: dict[tuple[str, str], Load] = {}
_loading = Lock()


class TestTableLoad(Load):
    """A load over test tables. ``rows`` come from the written join; ``raw``, the same rows as files, is written when asked for."""

    lines: DataFrame
    _raw: DataFrame | None = None

    @classmethod
    def start(cls, spark: SparkSession, raw: DataFrame, root: str) -> TestTableLoad:
        load = super().start(spark, None, root)
        load.lines = raw
        load.locks["raw"] = Lock()
        return load

    @property
    def rows(self) -> DataFrame:
        return raw_columns(self.lines)

    @property
    def raw(self) -> DataFrame:
        with self.locks["raw"]:
            if self._raw is None:
                self.rows.write.mode("overwrite").parquet(f"{self.root}/raw")
                self._raw = read_microdata(self.spark, f"{self.root}/raw")
        return self._raw

    @raw.setter
    def raw(self, raw: None) -> None:
        self._raw = raw


def load_for(spark: SparkSession, sf_dir: str) -> Load:
    """The load over one set of test tables, shared by all queries of the application."""
    identity = (spark.sparkContext.applicationId, sf_dir)
    with _loading:
        if identity not in _loads:
            tune(spark)
            root = f"{shared_folder(spark)}/{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"
            with shuffles_dropped(spark):
                notified_lines(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/lines")
            _loads[identity] = TestTableLoad.start(spark, read_microdata(spark, f"{root}/lines"), root)
        return _loads[identity]


def _on_raw(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(load_for(spark, sf_dir).rows)


def staged_rows(load: Load) -> DataFrame:
    """The stored staging table; before there is one, the same rows for a single pass, which cleans the columns it reads."""
    return load[STAGING] if STAGING in load else build_staging(load.rows)


def _on_staging(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(staged_rows(load_for(spark, sf_dir)))


def _on_load(query: Callable[[Load], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(load_for(spark, sf_dir))


def _complete(load: Load) -> Load:
    load.build(STAGING)
    if not all(table in load for table in DIMENSIONS):
        load.build_together(*DIMENSIONS)
    load.build(facts.NOTIFICATION, facts.EXAM, mart.MART)
    return load


def _on_warehouse(query: Callable[[Load], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(_complete(load_for(spark, sf_dir)))


def _keep(raw: DataFrame, source: str, result) -> DataFrame:
    """Distinct raw values beside their cleaned form, with their frequency."""
    value = F.col(source)
    counted = raw.groupBy(value.alias("bruto")).agg(F.count("*").alias("linhas"))
    return counted.select("bruto", result(F.col("bruto")).alias("limpo"), "linhas")


def _clean_text(raw: DataFrame) -> DataFrame:
    columns = [c for j in d.JUNK_DIMENSIONS for c in j.attributes]
    long = raw.unpivot([], columns, "coluna", "bruto").groupBy("coluna", "bruto").agg(F.count("*").alias("linhas"))
    return long.select("coluna", "bruto", text.clean_text(F.col("bruto")).alias("limpo"), "linhas")


def _clean_locality(raw: DataFrame) -> DataFrame:
    pairs = raw.groupBy("Municipio", "Bairro").agg(F.count("*").alias("linhas"))
    return pairs.select(
        "Municipio", "Bairro", text.clean_upper(F.col("Municipio")).alias("municipio_limpo"),
        text.clean_upper(F.col("Bairro")).alias("bairro_limpo"), "linhas",
    )


def _collection_date(raw: DataFrame) -> DataFrame:
    chosen = dates.first_collection_date(*map(F.col, d.COLLECTION_DATES)).alias("coleta")
    return raw.select(*d.COLLECTION_DATES, chosen).groupBy(*d.COLLECTION_DATES, "coleta").agg(F.count("*").alias("linhas"))


def _fact_flags(staging: DataFrame) -> DataFrame:
    inputs = ("Classificacao_clean", "Evolucao_clean", d.HOSPITALISED)
    return staging.select(*inputs, *(flag.alias(name) for name, flag in facts.notification_flags().items()))


def _day_differences(staging: DataFrame) -> DataFrame:
    inputs = ("DataNotificacao_date", "DataEncerramento_date", "DataObito_date")
    return staging.select(*inputs, *(gap.cast("int").alias(name) for name, gap in facts.notification_gaps().items()))


def _calendar_use(staging: DataFrame) -> DataFrame:
    """Every day of the calendar with the notifications of that day."""
    calendar = dimensions.build_date_dimension(staging.sparkSession)
    key = dates.date_key(F.col("DataNotificacao_date")).alias("sk_tempo")
    daily = staging.groupBy(key).agg(F.count("*").alias("notificacoes"))
    return calendar.join(daily, "sk_tempo", "left").fillna(0, ["notificacoes"])


def _as_of(load: Load) -> DataFrame:
    rows = scd2.lookup_as_of(
        with_salt(load[STAGING].select("Municipio_clean", "Bairro_clean", "DataNotificacao_date")),
        load["dw.dim_localidade"],
        {"Municipio_clean": "municipio", "Bairro_clean": "bairro"},
        "DataNotificacao_date",
        "sk_local",
    )
    key = F.coalesce("sk_local", F.lit(d.UNKNOWN_KEY)).alias("sk_local")
    return rows.select("Municipio_clean", "Bairro_clean", "DataNotificacao_date", key)


def _order_history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Changes from the orders: what each nation's busiest order status and priority were, day by day."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "lineitem")}
    placed = tables["orders"].join(tables["customer"], F.col("o_custkey") == F.col("c_custkey"))
    changes = placed.select(
        F.col("c_nationkey").cast("long").alias("nacao"), F.col("o_orderdate").cast("date").alias("dia"),
        F.col("o_orderstatus").alias("estado"), F.col("o_orderpriority").alias("prioridade"))
    shipped = tables["lineitem"].join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("c_nationkey").cast("long").alias("nacao"),
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.date_sub(F.col("l_shipdate").cast("date"), 90)).alias("embarque"))
    return changes, shipped


def _timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.timeline(_order_history(spark, sf_dir)[0], "nacao", "dia")


def _deep_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments beside the version of their nation, some thousand versions deep, that held on the day."""
    changes, shipped = _order_history(spark, sf_dir)
    versions = scd2.timeline(changes, "nacao", "dia").withColumn("versao", F.concat_ws("|", "nacao", "data_inicio", "estado", "prioridade"))
    found = scd2.lookup_as_of_merged(with_salt(shipped), versions, {"nacao": "nacao"}, "embarque", "versao")
    return found.groupBy("nacao", "embarque", "versao").agg(F.count("*").alias("linhas"))


def _late_changes(load: Load) -> DataFrame:
    """Three changes of inhabitants for every bairro of VITORIA: before the stored history, within it, and after it."""
    locality = load["dw.dim_localidade"]
    hit = locality.filter("flag_atual AND municipio = 'VITORIA'").select("nk_municipio_bairro")
    changes = hit.select("nk_municipio_bairro", F.inline(F.array(*(
        F.struct(F.lit(day).alias("dia"), F.lit(n).alias("populacao_municipio")) for day, n in LATE_CHANGES))))
    return scd2.apply_timeline(locality, changes, "nk_municipio_bairro", "dia", "sk_local", ["populacao_municipio"])


def _locality_region(load: Load) -> DataFrame:
    names = load[STAGING].select(F.col("Municipio_clean").alias("municipio")).distinct()
    return dimensions.with_region(names)


def _remove_accents(load: Load) -> DataFrame:
    names = load[STAGING].select(F.col("Municipio_clean").alias("municipio")).distinct()
    return names.select("municipio", text.remove_accents(F.col("municipio")).alias("sem_acento"))


def _upsert(load: Load) -> DataFrame:
    """A new version for every bairro of VITORIA, and one bairro the dimension has not seen."""
    locality = load["dw.dim_localidade"]
    current = scd2.current_versions(locality).filter(F.col("municipio") == "VITORIA")
    described = ("municipio", "uf", "regiao_es", "macrorregiao")
    population = F.lit(UPSERT_POPULATION).alias("populacao_municipio")
    known = current.select("bairro", *described, population, "nk_municipio_bairro")
    unseen = current.select(F.lit(UPSERT_BAIRRO).alias("bairro"), *described, population).distinct().withColumn(
        "nk_municipio_bairro", F.concat_ws("|", "municipio", "bairro")
    )
    return scd2.upsert(locality, known.unionByName(unseen), "nk_municipio_bairro", UPSERT_DAY, "sk_local")


def _routed(load: Load) -> DataFrame:
    """The same request answered by the route the filters choose and by the fact."""
    routed = star.top_municipios(load, WAREHOUSE_MUNICIPIOS).withColumn("rota", F.lit("escolhida"))
    base = star.top_municipios(load, WAREHOUSE_MUNICIPIOS, use_mart=False).withColumn("rota", F.lit("fato"))
    return routed.unionByName(base)


def _navigated(load: Load) -> DataFrame:
    """Route and answer of every request."""
    navigator, frames = Navigator(load), []
    for name, request in REQUESTS.items():
        route = navigator.choose(request)
        key = F.concat_ws("|", *(F.col(a).cast("string") for a in request.attributes))
        answer = navigator.answer(request, route).select(key.alias("chave"), *request.measures)
        long = answer.unpivot(["chave"], list(request.measures), "medida", "valor")
        frames.append(long.select(F.lit(name).alias("pedido"), F.lit(route.table).alias("rota"), "chave", "medida", "valor"))
    return reduce(DataFrame.unionByName, frames)


def _merged_profile(load: Load) -> DataFrame:
    """The state of the raw files, added up from the stored states of each."""
    store = profile_state.ProfileStore(load.spark, f"{load.root}/profile")
    with _loading:
        load.raw  # the files that the states are of
        store.update(f"{load.root}/raw")
    return store.state(f"{load.root}/raw")


def _refresh_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for suffix, raw_choice, clean_choice in (("", ((), ()), ((), ())), ("_filtered", (RAW_MUNICIPIOS, CLASSES), (WAREHOUSE_MUNICIPIOS, CLASSES))):
        found[f"refresh_all_direct{suffix}"] = _on_raw(lambda raw, c=raw_choice: shared_refresh.refresh_all_direct(raw, *c))
        found[f"refresh_all_dw{suffix}"] = _on_warehouse(lambda w, c=clean_choice: shared_refresh.refresh_all_dw(w, *c))
        found[f"refresh_stored{suffix}"] = _on_warehouse(lambda w, c=clean_choice: shared_refresh.refresh_stored(w, *c))
    return found


def _filter_in_lists(raw: DataFrame) -> DataFrame:
    chosen = direct.selected(raw, RAW_MUNICIPIOS, CLASSES)
    return chosen.groupBy("Municipio", "Classificacao", "Evolucao").agg(F.count("*").alias("linhas"))


def _orphans(load: Load, column: str, table: str) -> DataFrame:
    return quality.orphan_rows(load[facts.NOTIFICATION], column, load[table], quality.schemas.DIMENSION_KEYS[table])


def _both_orphans(load: Load) -> DataFrame:
    pairs = (("sk_local", "dw.dim_localidade"), ("sk_data_notificacao", "dw.dim_tempo"))
    frames = [_orphans(load, c, t).select(F.lit(c).alias("coluna"), "orfaos") for c, t in pairs]
    return frames[0].unionByName(frames[1])


def second_snapshot(raw: DataFrame) -> DataFrame:
    kept = raw.filter(f"NOT coalesce({GONE}, false)").withColumn(CHANGED[0], F.expr(CHANGED[1]))
    return kept.unionByName(raw.filter(ADDED).withColumns({c: F.expr(e) for c, e in ADDED_VALUES.items()}))


def increment_for(spark: SparkSession, sf_dir: str) -> IncrementalLoad:
    load = _complete(load_for(spark, sf_dir))
    with _loading:
        identity = (spark.sparkContext.applicationId, sf_dir)
        if identity not in _increments:
            _increments[identity] = IncrementalLoad(load, second_snapshot(load.rows))
        return _increments[identity]


def _on_increment(query: Callable[[IncrementalLoad], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(increment_for(spark, sf_dir))


def _panel_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, panel in direct.PANELS.items():
        found[f"{name}_direct"] = _on_raw(panel)
        found[f"{name}_direct_filtered"] = _on_raw(lambda raw, p=panel: p(raw, RAW_MUNICIPIOS, CLASSES))
    for name, panel in star.PANELS.items():
        found[f"{name}_dw"] = _on_warehouse(panel)
        found[f"{name}_dw_filtered"] = _on_warehouse(lambda w, p=panel: p(w, WAREHOUSE_MUNICIPIOS, CLASSES))
        found[f"{name}_dw_municipios"] = _on_warehouse(lambda w, p=panel: p(w, WAREHOUSE_MUNICIPIOS))
    return found


def queries() -> dict[str, Query]:
    return {
        # sources
        "scan_projected": _on_raw(lambda raw: raw.select(*d.DASHBOARD_COLUMNS)),
        "stg_notificacao": _on_raw(build_staging),
        # cleaning and scalar functions
        "clean_text": _on_raw(_clean_text),
        "clean_locality": _on_raw(_clean_locality),
        "try_date": _on_raw(lambda raw: _keep(raw, "DataNotificacao", dates.try_date)),
        "coalesce_collection_date": _on_raw(_collection_date),
        "parse_age": _on_raw(lambda raw: _keep(raw, d.AGE, measures.parse_age_years)),
        "filter_in_lists": _on_raw(_filter_in_lists),
        "fact_flags": _on_staging(_fact_flags),
        "day_differences": _on_staging(_day_differences),
        "remove_accents": _on_load(_remove_accents),
        "locality_region": _on_load(_locality_region),
        # dimensions and history
        "dim_tempo": _on_staging(_calendar_use),
        "dim_localidade_base": _on_staging(dimensions.build_locality_base),
        "dim_localidade": _on_load(lambda load: load["dw.dim_localidade"]),
        **{
            name: _on_staging(lambda staging, j=junk: dimensions.build_junk_dimension(staging, j))
            for name, junk in zip(
                ("dim_perfil", "dim_classificacao", "dim_sintomas", "dim_comorbidade", "dim_teste"), d.JUNK_DIMENSIONS
            )
        },
        "scd2_current": _on_load(lambda load: scd2.current_versions(load["dw.dim_localidade"])),
        "scd2_upsert": _on_load(_upsert),
        "scd2_timeline": _timeline,
        "scd2_asof_deep": _deep_as_of,
        "scd2_late_changes": _on_load(_late_changes),
        "snowflake_municipio": _on_load(lambda load: dimensions.build_snowflake_municipio(load["dw.dim_localidade"])),
        "snowflake_bairro": _on_load(
            lambda load: dimensions.build_snowflake_bairro(load["dw.dim_localidade"], load["dw.dim_municipio"])
        ),
        # facts and mart
        "role_playing_dates": _on_staging(facts.dates_by_key),
        "scd2_asof_join": _on_load(_as_of),
        "fato_notificacao": _on_load(lambda load: facts.build_notification_fact(load[STAGING], load)),
        "fato_exame": _on_load(lambda load: facts.build_exam_fact(load[facts.NOTIFICATION], load[d.TEST_DIM.table])),
        "mart_municipio_mes": _on_load(
            lambda load: mart.refresh_mart(load[facts.NOTIFICATION], load["dw.dim_localidade"])
        ),
        "mart_equals_base": _on_warehouse(
            lambda w: mart.mart_differences(w[mart.MART], w[facts.NOTIFICATION], w["dw.dim_localidade"])
        ),
        "drill_across": _on_warehouse(
            lambda w: mart.drill_across(w[facts.NOTIFICATION], w[facts.EXAM], w["dw.dim_localidade"])
        ),
        "routed_top_municipios": _on_warehouse(_routed),
        # a second load from the changes of the raw rows
        "staging_delta": _on_increment(lambda i: i.delta),
        "dim_second_load": _on_increment(lambda i: i.dimension("dw.dim_localidade")),
        "dim_perfil_second_load": _on_increment(lambda i: i.dimension(d.PROFILE_DIM.table)),
        "fact_delta": _on_increment(lambda i: i.fact_delta),
        "mart_incremental": _on_increment(lambda i: i.mart),
        # quality
        "dq_unknown_members": _on_warehouse(quality.unknown_members),
        "dq_orphans_local": _on_warehouse(lambda w: _orphans(w, "sk_local", "dw.dim_localidade")),
        "dq_orphans_tempo": _on_warehouse(lambda w: _orphans(w, "sk_data_notificacao", "dw.dim_tempo")),
        "dq_orphans_not_exists": _on_warehouse(_both_orphans),
        "dq_reconcile": _on_warehouse(lambda w: quality.reconcile(w[STAGING], w[facts.NOTIFICATION])),
        "dq_pk_unique": _on_warehouse(quality.duplicate_keys),
        "dq_fk_orphans_all": _on_warehouse(quality.foreign_key_orphans),
        "dq_report": _on_warehouse(quality.quality_report),
        # profiling and exploratory analyses
        "null_report": _on_raw(profile.null_report),
        "null_empty_report": _on_raw(profile.null_or_empty_report),
        "null_report_merged": _on_load(lambda load: profile_state.null_report(_merged_profile(load))),
        "null_empty_report_merged": _on_load(lambda load: profile_state.null_or_empty_report(_merged_profile(load))),
        "table_profile": _on_raw(profile.table_profile),
        "class_frequency_pct": _on_raw(notebook.class_frequency),
        "sex_distribution": _on_raw(notebook.sex_distribution),
        "leading_municipio": _on_raw(notebook.leading_municipio),
        "leading_age_band": _on_raw(notebook.leading_age_band),
        "outcomes_confirmed": _on_raw(notebook.outcomes_confirmed),
        "lethality_overall": _on_raw(notebook.lethality_overall),
        "comorbidities_in_deaths_exact": _on_raw(notebook.comorbidities_in_deaths),
        "leading_comorbidity": _on_raw(notebook.leading_comorbidity),
        "monthly_series_strict": _on_raw(lambda raw: notebook.monthly_series_strict(raw, "DataCadastro")),
        "crosstab_top5": _on_raw(notebook.outcome_crosstab),
        "highest_lethality": _on_raw(notebook.highest_lethality),
        # dashboards
        **_panel_queries(),
        **_refresh_queries(),
        "aggregate_navigation": _on_warehouse(_navigated),
        "filter_options": _on_warehouse(star.filter_options),
        "filter_options_direct": _on_raw(direct.filter_options),
        "monthly_series_all": _on_warehouse(star.monthly_series_all),
        "map_confirmed": _on_warehouse(star.confirmed_map),
        "age_pyramid": _on_warehouse(star.age_pyramid),
        "top_comorbidities": _on_warehouse(star.top_comorbidities),
    }
