import datetime as dt

import pytest
from conftest import SMALL, rows
from pyspark.sql import Window, functions as F

from epidw import domain as d, schemas
from epidw.operators import facts, lookup, mart, quality
from epidw.plans import pipeline
from epidw.sources.warehouse import PublicationConflict, Warehouse

STAGING = pipeline.STAGING


def same(left, right):
    columns = left.columns
    return left.exceptAll(right.select(*columns)).isEmpty() and right.select(*columns).exceptAll(left).isEmpty()


def test_expected_sizes(expected):
    sizes = {
        STAGING: 60_000, "dw.dim_tempo": 11_324, "dw.dim_localidade": 168, "dw.dim_perfil_paciente": 501,
        "dw.dim_classificacao": 49, "dw.dim_sintomas": 33, "dw.dim_comorbidade": 21, "dw.dim_teste": 7,
        facts.NOTIFICATION: 60_000, facts.EXAM: 44_868, mart.MART: 2_079,
    }
    assert {table: expected[table].count() for table in sizes} == sizes


def test_expected_measures(expected):
    fact = expected[facts.NOTIFICATION]
    found = fact.agg(*(F.sum(c) for c in ("flag_obito_covid", "flag_internado", "flag_cura", "idade_anos", "qtd_notificacao"))).first()
    assert tuple(found) == (15_911, 11_918, 19_837, 760_973, 60_000)
    assert expected[facts.EXAM].filter("flag_positivo = 1").count() == 14_960
    month = expected[mart.MART]
    assert month.agg(F.sum("notificacoes"), F.countDistinct("ano_mes")).first()[:] == (60_000, 81)
    assert month.filter(F.col("ano_mes") == d.UNKNOWN).count() == 26


def test_declared_schemas(small):
    assert quality.schema_differences(small) == []


def test_calendar(small):
    day = small["dw.dim_tempo"].filter("sk_tempo = 20210101").first()
    assert (day.semana_epidemiologica, day.trimestre, day.nome_mes, day.dia_semana, day.ano_mes) == (
        53, 1, "Janeiro", "Sexta-feira", "2021-01",
    )
    unknown = small["dw.dim_tempo"].filter("sk_tempo = -1").first()
    assert unknown.data is None and unknown.ano_mes == d.UNKNOWN


def test_history_of_localities(small):
    locality = small["dw.dim_localidade"]
    versions = Window.partitionBy("nk_municipio_bairro").orderBy("data_inicio")
    following = locality.withColumn("_next", F.lead("data_inicio").over(versions))
    assert following.filter("_next is not null and date_add(data_fim, 1) <> _next").isEmpty()
    assert locality.groupBy("nk_municipio_bairro").agg(F.count_if("flag_atual").alias("n")).filter("n <> 1").isEmpty()
    accented = locality.filter("municipio = 'VITÓRIA'").select("populacao_municipio", "regiao_es", "flag_atual").distinct()
    assert rows(accented) == [(365_000, "Metropolitana", True)]
    plain = locality.filter("municipio = 'VITORIA'").select("populacao_municipio", "data_inicio", "data_fim").distinct()
    assert rows(plain, "data_inicio") == [
        (365_000, dt.date(2000, 1, 1), dt.date(2021, 12, 31)), (375_000, dt.date(2022, 1, 1), None),
    ]


def test_unknown_tuple_joins_by_value(small):
    unknown = F.lit(True)
    for column in d.CLASS_DIM.staged():
        unknown = unknown & (F.col(column) == d.UNKNOWN)
    staged = small[STAGING].filter(unknown).count()
    assert staged > 0
    assert small[facts.NOTIFICATION].filter("sk_class = -1").count() == staged


def test_computed_date_keys_equal_the_joins(small):
    staging = small[STAGING]
    assert same(facts.dates_by_key(staging), facts.dates_by_join(staging, small["dw.dim_tempo"]))


def test_fact_is_the_same_without_broadcast(small):
    salted = facts.build_notification_fact(small[STAGING], small, budget=0)
    assert same(small[facts.NOTIFICATION], salted)


def test_mart_is_the_same_without_broadcast(small):
    assert same(small[mart.MART], mart.refresh_mart(small[facts.NOTIFICATION], small["dw.dim_localidade"], budget=0))


def test_dimension_is_measured_once(small):
    sizes = lookup.measure(small["dw.dim_localidade"], small["dw.dim_teste"])
    assert sizes[0] > sizes[1] > 0
    assert lookup.measure(small["dw.dim_localidade"]) == sizes[:1]


def test_gate_passes(small):
    report = quality.quality_report(small)
    assert report.filter("situacao <> 'OK'").isEmpty()
    quality.enforce(report)


@pytest.mark.parametrize(
    "table, spoil, failing",
    [
        ("dw.dim_teste", lambda df: df.filter("sk_teste <> -1"), "chave:dw.dim_teste"),
        ("dw.dim_teste", lambda df: df.filter("false"), "chave:dw.dim_teste"),
        (facts.NOTIFICATION, lambda df: df.withColumn("sk_local", F.lit(999_999)), "sk_local"),
        (facts.NOTIFICATION, lambda df: df.withColumn("sk_como", F.lit(None).cast("int")), "sk_como"),
        (facts.NOTIFICATION, lambda df: df.union(df.limit(1)), "reconciliacao:notificacoes"),
        (facts.NOTIFICATION, lambda df: df.withColumn("qtd_notificacao", F.lit(2)), "reconciliacao:notificacoes"),
        (facts.NOTIFICATION, lambda df: df.withColumn("flag_cura", F.lit(None).cast("smallint")), "flag_cura"),
        (facts.EXAM, lambda df: df.union(df.limit(1)), "chave:dw.fato_exame"),
        (facts.EXAM, lambda df: df.withColumn("sk_fato_exame", F.lit(None).cast("long")), "chave:dw.fato_exame"),
        (facts.EXAM, lambda df: df.filter("sk_fato_exame > 5"), "reconciliacao:exames"),
    ],
)
def test_gate_rejects(small, table, spoil, failing):
    tables = {name: small[name] for name in (*schemas.DIMENSION_KEYS, STAGING, facts.NOTIFICATION, facts.EXAM)}
    tables[table] = spoil(tables[table])
    with pytest.raises(quality.QualityError, match=failing):
        quality.enforce(quality.quality_report(tables))


def test_publish_only_after_the_gate(spark, small, folder, monkeypatch):
    first = pipeline.run_pipeline(spark, small.raw, folder)
    assert Warehouse.open(spark, f"{folder}/nowhere", folder).version == first.version
    # a second run over the same data gives the same tables
    second = pipeline.run_pipeline(spark, small.raw, folder)
    current = Warehouse.open(spark, folder)
    assert current.version == second.version != first.version
    for table in (*schemas.DIMENSION_KEYS, facts.NOTIFICATION, facts.EXAM, mart.MART):
        assert same(first[table], current[table]), table
    # a load that fails its gate leaves readers on the old version
    broken = dict(pipeline.BUILDERS)
    broken[facts.NOTIFICATION] = lambda load: pipeline.BUILDERS_OK(load).limit(10)
    monkeypatch.setattr(pipeline, "BUILDERS_OK", pipeline.BUILDERS[facts.NOTIFICATION], raising=False)
    monkeypatch.setattr(pipeline, "BUILDERS", broken)
    with pytest.raises(quality.QualityError):
        pipeline.run_pipeline(spark, small.raw, folder)
    assert Warehouse.open(spark, folder).version == second.version


def _version(spark, root, value):
    version = Warehouse.new_version(spark, root)
    version.write("t.x", spark.range(value, value + 1))
    return version


def test_two_loads_from_one_base(spark, folder):
    first, second = _version(spark, folder, 1), _version(spark, folder, 2)
    second.publish()
    with pytest.raises(PublicationConflict):
        first.publish()
    assert Warehouse.open(spark, folder).version == second.version
    third = _version(spark, folder, 3)
    third.publish()
    assert rows(Warehouse.open(spark, folder)["t.x"]) == [(3,)]
    with pytest.raises(PublicationConflict):
        first.publish()


def test_expiry_keeps_what_is_used(spark, folder):
    made = []
    for value in range(4):
        made.append(_version(spark, folder, value))
        if value != 1:  # a load that was given up
            made[-1].publish()
    names = [v.version for v in made]
    assert Warehouse.expire(spark, folder, keep=1) == []  # all begun within the grace
    none = dt.timedelta(0)
    with made[0].lease():
        assert Warehouse.expire(spark, folder, keep=2, grace=none) == [names[1]]
        assert rows(made[0]["t.x"]) == [(0,)]
    assert Warehouse.expire(spark, folder, keep=2, grace=none) == [names[0]]
    with pytest.raises(FileNotFoundError, match="expired"), made[0].lease():
        pass
    assert Warehouse.expire(spark, folder, keep=0, grace=none) == [names[2]]
    assert rows(Warehouse.open(spark, folder)["t.x"]) == [(3,)]
    _version(spark, folder, 4).publish()
    assert rows(Warehouse.open(spark, folder)["t.x"]) == [(4,)]


def test_missing_warehouse_is_reported(spark, folder):
    with pytest.raises(FileNotFoundError, match="run the load first"):
        Warehouse.open(spark, f"{folder}/a", f"{folder}/b")


def test_views(spark, small):
    small.create_views()
    found = spark.sql("SELECT count(*) FROM dw_fato_exame JOIN dw_dim_teste USING (sk_teste)").first()[0]
    assert found == small[facts.EXAM].count()


def test_entry_point(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.columns == schemas.TABLES[mart.MART].names
    assert result.agg(F.sum("notificacoes")).first()[0] == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
