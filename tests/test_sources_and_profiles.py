import pytest
from conftest import rows

from pyspark.sql import functions as F

from epidw import domain as d, schemas
from epidw.operators import profile, profile_state
from epidw.plans import notebook
from epidw.sources import microdata

HEADER = ";".join(d.RAW_COLUMNS)


def write_csv(folder, lines, header=HEADER):
    path = f"{folder}/raw.csv"
    with open(path, "w", encoding="latin-1") as out:
        out.write("\n".join([header, *lines]) + "\n")
    return path


def line(**values):
    return ";".join(values.get(c, "") for c in d.RAW_COLUMNS)


def test_csv_round_trip(spark, folder):
    path = write_csv(folder, [line(Municipio="VITÓRIA", Sexo=" ", IdadeNaDataNotificacao="9 meses"), line(Evolucao="Óbito pelo COVID-19")])
    read = microdata.read_microdata_csv(spark, path, schema=schemas.RAW)
    first, second = read.collect()
    assert (first.Municipio, first.Sexo, first.Bairro, first.IdadeNaDataNotificacao) == ("VITÓRIA", " ", None, "9 meses")
    assert second.Evolucao == d.COVID_DEATH
    microdata.csv_to_parquet(spark, path, f"{folder}/raw.parquet")
    back = microdata.read_microdata(spark, f"{folder}/nowhere", f"{folder}/raw.parquet")
    assert back.schema == schemas.RAW
    assert back.exceptAll(read).isEmpty() and back.count() == 2
    assert microdata.has_declared_columns(back)
    only = microdata.read_microdata(spark, f"{folder}/raw.parquet", columns=["Municipio", "Classificacao"])
    assert only.columns == ["Municipio", "Classificacao"]


def test_csv_header_in_another_order_is_refused(spark, folder):
    path = write_csv(folder, [line()], header=";".join(reversed(d.RAW_COLUMNS)))
    with pytest.raises(Exception, match="does not conform to the schema"):
        microdata.read_microdata_csv(spark, path, schema=schemas.RAW).collect()


def test_csv_quoting_and_missing_spellings(spark, folder):
    path = write_csv(folder, ['"a;b";"say ""x"" \\ y";NA', '"";null;Nada'], header="p;q;r")
    found = microdata.read_microdata_csv(spark, path)
    assert [tuple(r) for r in found.collect()] == [("a;b", 'say "x" \\ y', None), (None, None, "Nada")]
    broken = write_csv(folder, ['"two\nlines";b;c'], header="p;q;r")
    assert microdata.read_microdata_csv(spark, broken, multi_line=True).first().p == "two\nlines"


def test_csv_line_breaks_are_found(spark, folder):
    path = write_csv(folder, ['1;"two', 'lines ""quoted""";c', '2;"a;b";d'], header="p;q;r")
    assert microdata.has_broken_lines(spark, path)
    assert rows(microdata.read_microdata_csv(spark, path)) == [("1", 'two\nlines "quoted"', "c"), ("2", "a;b", "d")]
    whole = write_csv(folder, ['1;"say ""x""";c', '2;"";d'], header="p;q;r")
    assert not microdata.has_broken_lines(spark, whole)
    assert rows(microdata.read_microdata_csv(spark, whole)) == [("1", 'say "x"', "c"), ("2", None, "d")]


def test_profile_states_merge_in_any_order(spark, folder):
    df = spark.createDataFrame([(None, "x", 1), ("", "y", None), ("a", None, 3), ("b", "z", 4), (None, "", 5)], "p string, q string, n int")
    parts = [profile_state.state_of(df.filter(f"coalesce(n, 2) = {i}")) for i in range(1, 6)]
    expected = {("n", 5, 1, 0), ("p", 5, 2, 1), ("q", 5, 1, 1)}
    assert set(rows(profile_state.state_of(df))) == expected
    for order in (parts, parts[::-1], [profile_state.merge(*parts[:2]), profile_state.merge(*parts[2:])]):
        assert set(rows(profile_state.merge(*order))) == expected
    assert rows(profile_state.null_report(profile_state.state_of(df)), "coluna") == rows(profile.null_report(df), "coluna")
    assert set(rows(profile_state.state_of(df.limit(0)))) == {(c, 0, 0, 0) for c in "npq"}


def test_a_new_file_costs_one_file(spark, folder):
    source, store = f"{folder}/a b+c", profile_state.ProfileStore(spark, f"{folder}/states")
    df = spark.createDataFrame([(None, "x"), ("", "y"), ("a", None), ("b", "z")], "p string, q string")
    df.repartition(2).write.parquet(source)
    assert store.update(source) == 2 and store.update(source) == 0
    df.coalesce(1).write.mode("append").parquet(source)
    assert store.update(source) == 1
    assert set(rows(store.state(source))) == {("p", 8, 2, 2), ("q", 8, 2, 0)}
    df.limit(1).coalesce(1).write.mode("overwrite").parquet(source)  # files that are gone no longer count
    assert store.update(source) == 1
    assert set(rows(store.state(source))) == {("p", 1, 1, 0), ("q", 1, 0, 0)}


def test_fixed_values():
    assert (d.YES, d.CONFIRMED, d.COVID_DEATH, d.UNKNOWN) == ("Sim", "Confirmados", "Óbito pelo COVID-19", "Desconhecido")
    assert sum(map(len, d.REGIONS.values())) == 77 and d.POPULATIONS["SERRA"] == 520_000 and d.POPULATION_CHANGES == {"VITORIA": 375_000, "SERRA": 540_000}
    assert {place: region for region, places in d.REGIONS.items() for place in places}["SAO MATEUS"] == ("Norte", "Central Norte")
    assert [label for _, label in d.COMORBIDITY_LABELS] == ["Cardiopatia", "Diabetes", "Obesidade", "Doença Pulmonar", "Doença Renal"]


def test_missing_microdata_is_reported(spark, folder):
    with pytest.raises(FileNotFoundError):
        microdata.read_microdata(spark, f"{folder}/a", f"{folder}/b")


def test_reports(spark):
    df = spark.createDataFrame([(None, "x"), ("", "y"), ("a", None), ("b", "z")], "p string, q string")
    full = spark.createDataFrame([("a",)], "c string")
    assert rows(profile.null_report(df), "coluna") == [("p", 1, 25.0), ("q", 1, 25.0)]
    assert profile.null_report(full).isEmpty()
    assert [tuple(r) for r in profile.null_or_empty_report(df).collect()] == [("p", 2, 50.0), ("q", 1, 25.0)]
    assert rows(profile.table_profile(df), "coluna") == [("p", "string", 4, 3), ("q", "string", 4, 3)]


def test_frequencies_leave_missing_values_out(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    assert [tuple(r) for r in profile.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in profile.value_frequencies(df, "c").collect()] == [("b", 1, 33.33), ("a", 2, 66.67)]


def test_crosstab_fills_absent_pairs(spark):
    cases = [("A", d.CURED)] * 3 + [("A", d.COVID_DEATH)] + [("B", d.CURED)] * 2 + [("B", None), (None, d.CURED)]
    df = spark.createDataFrame([(m, e, d.CONFIRMED) for m, e in cases], "Municipio string, Evolucao string, Classificacao string")
    df = df.unionByName(df.limit(1).select(F.lit("B").alias("Municipio"), F.lit("outra").alias("Evolucao"), "Classificacao"))
    expected = {("A", d.CURED, 3), ("A", d.COVID_DEATH, 1), ("A", "outra", 0), ("B", d.CURED, 2), ("B", d.COVID_DEATH, 0), ("B", "outra", 1)}
    assert set(rows(notebook.outcome_crosstab(df))) == expected
    assert rows(notebook.highest_lethality(df)) == [("A", 4, 1, 25.0)]
    assert set(rows(notebook.outcome_crosstab(df, n=1))) == {("A", d.CURED, 3), ("A", d.COVID_DEATH, 1)}


def test_lethality_without_cases(spark):
    empty = spark.createDataFrame([], "Municipio string, Evolucao string, Classificacao string")
    assert rows(notebook.lethality_overall(empty)) == [(0, 0, 0.0)]
