"""Declared schemas: the raw file is all text, the warehouse tables are typed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from epidw import domain as d

RAW = T.StructType([T.StructField(name, T.StringType()) for name in d.RAW_COLUMNS])


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def _junk(dimension: d.JunkDimension) -> T.StructType:
    return _table((dimension.key, T.IntegerType()), *((a, T.StringType()) for a in dimension.attributes.values()))


_INT, _SHORT, _LONG, _TEXT, _DATE = T.IntegerType(), T.ShortType(), T.LongType(), T.StringType(), T.DateType()

TABLES: dict[str, T.StructType] = {
    "dw.dim_tempo": _table(
        ("sk_tempo", _INT), ("data", _DATE), ("dia", _INT), ("mes", _INT), ("ano", _INT), ("trimestre", _INT),
        ("nome_mes", _TEXT), ("dia_semana", _TEXT), ("semana_epidemiologica", _INT), ("ano_mes", _TEXT),
    ),
    "dw.dim_localidade": _table(
        ("sk_local", _INT), ("municipio", _TEXT), ("bairro", _TEXT), ("uf", _TEXT), ("regiao_es", _TEXT),
        ("macrorregiao", _TEXT), ("populacao_municipio", _INT), ("data_inicio", _DATE), ("data_fim", _DATE),
        ("flag_atual", T.BooleanType()), ("nk_municipio_bairro", _TEXT),
    ),
    **{dimension.table: _junk(dimension) for dimension in d.JUNK_DIMENSIONS},
    "dw.fato_notificacao_covid": _table(
        ("sk_data_notificacao", _INT), ("sk_data_cadastro", _INT), ("sk_data_diagnostico", _INT),
        ("sk_data_coleta", _INT), ("sk_data_Campanhas", _INT), ("sk_data_encerramento", _INT),
        ("sk_data_obito", _INT), ("sk_local", _INT), ("sk_perfil", _INT), ("sk_class", _INT), ("sk_sint", _INT),
        ("sk_como", _INT), ("sk_teste", _INT), ("flag_confirmado", _SHORT), ("flag_obito_covid", _SHORT),
        ("flag_internado", _SHORT), ("flag_cura", _SHORT), ("idade_anos", _SHORT),
        ("dias_notif_encerramento", _INT), ("dias_notif_obito", _INT), ("qtd_notificacao", _INT),
    ),
    "dw.fato_exame": _table(
        ("sk_fato_exame", _LONG), ("sk_data_coleta", _INT), ("sk_data_resultado", _INT), ("sk_local", _INT),
        ("sk_perfil", _INT), ("sk_teste", _INT), ("qtd_exames", _SHORT), ("flag_positivo", _SHORT),
        ("dias_coleta_result", _INT),
    ),
    "mart.mv_resumo_municipio_mes": _table(
        ("municipio", _TEXT), ("ano_mes", _TEXT), ("confirmados", _LONG), ("obitos", _LONG),
        ("internacoes", _LONG), ("notificacoes", _LONG),
    ),
    "dw.dim_municipio": _table(
        ("sk_municipio", _INT), ("municipio", _TEXT), ("regiao_es", _TEXT), ("macrorregiao", _TEXT), ("uf", _TEXT),
    ),
    "dw.dim_bairro": _table(("sk_bairro", _INT), ("bairro", _TEXT), ("sk_municipio", _INT)),
}

PRIMARY_KEYS = {
    "dw.dim_tempo": "sk_tempo",
    "dw.dim_localidade": "sk_local",
    **{dimension.table: dimension.key for dimension in d.JUNK_DIMENSIONS},
    "dw.fato_exame": "sk_fato_exame",
}
DIMENSION_KEYS = {table: key for table, key in PRIMARY_KEYS.items() if table != "dw.fato_exame"}


@dataclass(frozen=True)
class ForeignKey:
    fact: str
    column: str
    dimension: str


FOREIGN_KEYS = (
    *(ForeignKey("dw.fato_notificacao_covid", role, "dw.dim_tempo") for role in d.DATE_ROLES),
    ForeignKey("dw.fato_notificacao_covid", "sk_local", "dw.dim_localidade"),
    *(ForeignKey("dw.fato_notificacao_covid", j.key, j.table) for j in d.JUNK_DIMENSIONS),
    ForeignKey("dw.fato_exame", "sk_data_coleta", "dw.dim_tempo"),
    ForeignKey("dw.fato_exame", "sk_data_resultado", "dw.dim_tempo"),
    ForeignKey("dw.fato_exame", "sk_local", "dw.dim_localidade"),
    ForeignKey("dw.fato_exame", "sk_perfil", "dw.dim_perfil_paciente"),
    ForeignKey("dw.fato_exame", "sk_teste", "dw.dim_teste"),
)
# measures declared as always filled; empty keys are found by the key checks
REQUIRED = {
    "dw.fato_notificacao_covid": ("flag_confirmado", "flag_obito_covid", "flag_internado", "flag_cura", "qtd_notificacao"),
    "dw.fato_exame": ("qtd_exames", "flag_positivo"),
}
