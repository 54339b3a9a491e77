"""Raw microdata derived from the TPC-H-like test tables.

One notification per ``lineitem`` row. The expressions use only syntax that Spark
SQL and DuckDB share, so a test oracle can start from the very same rows. Dates
move 22 years ahead, which makes them cross the calendar start and the date on
which the type 2 history of the locality dimension changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from epidw import domain as d

SHIFT = 8036  # days in 22 years


def _ordered(days: int) -> str:
    return f"CAST(CAST(o_orderdate AS DATE) + {SHIFT + days} AS STRING)"


_SHIPPED = f"CAST(CAST(l_shipdate AS DATE) + {SHIFT} AS STRING)"
_QUANTITY = "CAST(CAST(l_quantity AS INT) AS STRING)"


def _yes_every(column: str, step: int, missing_every: int) -> str:
    return (
        f"CASE WHEN {column} % {missing_every} = 0 THEN NULL WHEN {column} % {step} = 0 THEN 'Sim' ELSE 'Não' END"
    )


def _patient(values: str) -> str:
    return f"CASE WHEN l_suppkey % 19 = 0 THEN NULL {values} END"


def _classified(values: str, missing: str = "NULL") -> str:
    return f"CASE WHEN l_orderkey % 107 = 0 THEN {missing} {values} END"


EXPRESSIONS: dict[str, str] = {
    "DataNotificacao": (
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN '31/12/2020' "
        f"WHEN l_orderkey % 83 = 0 THEN CAST(CAST(o_orderdate AS DATE) - 3650 AS STRING) ELSE {_ordered(0)} END"
    ),
    "DataCadastro": _ordered(1),
    "DataDiagnostico": f"CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE {_SHIPPED} END",
    "DataColeta_RT_PCR": f"CASE WHEN l_partkey % 4 = 0 THEN {_ordered(2)} END",
    "DataColetaTesteRapido": f"CASE WHEN l_partkey % 4 = 1 THEN {_ordered(3)} END",
    "DataColetaSorologia": "CASE WHEN l_partkey % 16 = 2 THEN 'n/d' END",
    "DataColetaSorologiaIGG": f"CASE WHEN l_partkey % 4 = 2 THEN {_ordered(4)} END",
    "DataEncerramento": f"CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE {_SHIPPED} END",
    "DataObito": f"CASE WHEN l_returnflag = 'R' THEN {_SHIPPED} END",
    "Municipio": (
        "CASE WHEN l_orderkey % 101 = 0 THEN '   ' WHEN l_orderkey % 103 = 0 THEN NULL "
        "WHEN n_nationkey = 0 THEN ' Vitoria ' WHEN n_nationkey = 1 THEN 'Vitória' WHEN n_nationkey = 2 THEN 'serra' "
        "WHEN n_nationkey = 3 THEN 'São Mateus' WHEN n_nationkey = 4 THEN 'Cachoeiro de Itapemirim' "
        "WHEN n_nationkey = 5 THEN 'São José do Calçado' ELSE n_name END"
    ),
    "Bairro": "CASE WHEN l_orderkey % 101 = 0 THEN '' WHEN l_partkey % 29 = 0 THEN NULL ELSE c_mktsegment END",
    "Sexo": _patient("WHEN l_linestatus = 'O' THEN 'F' ELSE 'M'"),
    "FaixaEtaria": (
        "CASE WHEN l_suppkey % 19 = 0 THEN ' ' WHEN l_partkey % 4 = 0 THEN '0 a 4 anos' "
        "WHEN l_partkey % 4 = 1 THEN '20 a 29 anos' WHEN l_partkey % 4 = 2 THEN '60 a 69 anos' "
        "ELSE '90 anos ou mais' END"
    ),
    "RacaCor": _patient("ELSE o_orderpriority"),
    "Escolaridade": _patient("ELSE c_mktsegment"),
    "Gestante": _patient("WHEN l_linestatus = 'O' AND l_partkey % 10 = 0 THEN 'Sim' ELSE 'Não'"),
    "ProfissionalSaude": _patient("WHEN l_suppkey % 8 = 1 THEN 'Sim' ELSE 'Não'"),
    "Classificacao": _classified(
        "WHEN o_orderstatus = 'F' THEN 'Confirmados' WHEN o_orderstatus = 'O' THEN 'Suspeito' ELSE 'Descartados'"
    ),
    "Evolucao": _classified(
        "WHEN l_returnflag = 'R' AND l_partkey % 5 = 0 THEN 'Óbito por outras causas' "
        "WHEN l_returnflag = 'R' THEN 'Óbito pelo COVID-19' WHEN l_returnflag = 'A' THEN 'Cura' ELSE 'Ignorado'"
    ),
    "CriterioConfirmacao": _classified("WHEN l_linenumber % 3 = 0 THEN 'Laboratorial' ELSE 'Clínico'", missing="''"),
    "StatusNotificacao": _classified("WHEN l_suppkey % 5 = 0 THEN 'Em Aberto' ELSE 'Encerrado'"),
    **{name: _yes_every("l_partkey", step, 23) for step, name in enumerate(d.SYMPTOMS, start=2)},
    **{name: _yes_every("l_suppkey", step, 17) for step, name in enumerate(d.COMORBIDITIES, start=3)},
    "TipoTesteRapido": "CASE WHEN l_partkey % 4 = 1 THEN 'Anticorpo' END",
    "ResultadoRT_PCR": (
        "CASE WHEN l_partkey % 4 <> 0 THEN NULL WHEN l_suppkey % 3 = 0 THEN 'POSITIVO' ELSE 'Negativo' END"
    ),
    "ResultadoTesteRapido": (
        "CASE WHEN l_partkey % 4 <> 1 THEN NULL WHEN l_suppkey % 3 = 1 THEN 'POSITIVO' ELSE 'Positivo' END"
    ),
    "ResultadoSorologia": (
        "CASE WHEN l_partkey % 4 <> 2 THEN ' ' WHEN l_suppkey % 3 = 2 THEN 'POSITIVO' ELSE 'Inconclusivo' END"
    ),
    "IdadeNaDataNotificacao": (
        f"CASE WHEN l_partkey % 6 = 0 THEN NULL WHEN l_partkey % 6 = 1 THEN {_QUANTITY} "
        f"WHEN l_partkey % 6 = 2 THEN CONCAT({_QUANTITY}, ' anos, 8 meses, 6 dias') "
        "WHEN l_partkey % 6 = 3 THEN '9 meses' WHEN l_partkey % 6 = 4 THEN '15 dias' "
        f"ELSE CONCAT('idade ', {_QUANTITY}) END"
    ),
    "FicouInternado": "CASE WHEN l_quantity > 40 THEN 'Sim' WHEN l_quantity > 10 THEN 'Não' END",
}


def notified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test tables joined: a row per notification, with the few columns that the raw ones are worked out from.

    The small tables meet first, so ``lineitem`` takes part in a single join. For
    the small ones Catalyst chooses the strategy, by their measured size.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    nations = table("nation").select("n_nationkey", "n_name")
    customers = table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    lines = table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    located = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    placed = orders.join(located, F.col("o_custkey") == F.col("c_custkey"))
    # the two large sides are sort-merged, in parallel at any size; skewed partitions are split at run time
    notified = lines.hint("merge").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return notified.drop("l_orderkey", "o_custkey", "c_custkey", "c_nationkey").withColumnRenamed("o_orderkey", "l_orderkey")


def raw_columns(lines: DataFrame) -> DataFrame:
    """The raw microdata shape of notified lines; only the columns that a query reads are worked out."""
    return lines.select(*(F.expr(EXPRESSIONS[name]).alias(name) for name in d.RAW_COLUMNS))


def raw_from_test_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw microdata shape, projected from the test tables."""
    return raw_columns(notified_lines(spark, sf_dir))
