"""Vocabulary of the notification warehouse.

Everything the operators need to know about the subject matter lives here, so
that the operators themselves stay generic: they take columns, labels, lookup
rows and dates as parameters and default to the values below.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# --- fixed values: labels and markers -------------------------------------------------
UNKNOWN = "Desconhecido"
UNKNOWN_UPPER = "DESCONHECIDO"
UNKNOWN_KEY = -1
YES = "Sim"
POSITIVE = "POSITIVO"
CONFIRMED = "Confirmados"
SUSPECTED = "Suspeito"
CURED = "Cura"
IGNORED = "Ignorado"
COVID_DEATH = "Óbito pelo COVID-19"
OTHER_DEATH = "Óbito por outras causas"
COVID_DEATH_MARK = "Óbito pelo COVID"
COVID_DEATH_LOOSE_MARK = "bito pelo COVID"
OUTCOMES = (COVID_DEATH, OTHER_DEATH, CURED, IGNORED)

# --- fixed values: raw microdata columns ----------------------------------------------
SYMPTOMS = {
    "Febre": "febre",
    "DificuldadeRespiratoria": "dif_respiratoria",
    "Tosse": "tosse",
    "Coriza": "coriza",
    "DorGarganta": "dor_garganta",
    "Diarreia": "diarreia",
    "Cefaleia": "cefaleia",
}
COMORBIDITIES = {
    "ComorbidadePulmao": "com_pulmao",
    "ComorbidadeCardio": "com_cardio",
    "ComorbidadeRenal": "com_renal",
    "ComorbidadeDiabetes": "com_diabetes",
    "ComorbidadeTabagismo": "com_tabagismo",
    "ComorbidadeObesidade": "com_obesidade",
}
PATIENT = {
    "Sexo": "sexo",
    "FaixaEtaria": "faixa_etaria",
    "RacaCor": "raca_cor",
    "Escolaridade": "escolaridade",
    "Gestante": "gestante",
    "ProfissionalSaude": "profissional_saude",
}
CLASSIFICATION = {
    "Classificacao": "classificacao",
    "Evolucao": "evolucao",
    "CriterioConfirmacao": "criterio_confirmacao",
    "StatusNotificacao": "status_notificacao",
}
TESTS = {
    "TipoTesteRapido": "tipo_teste_rapido",
    "ResultadoRT_PCR": "resultado_rt_pcr",
    "ResultadoTesteRapido": "resultado_teste_rap",
    "ResultadoSorologia": "resultado_sorologia",
}
PLACE = {"Municipio": "municipio", "Bairro": "bairro"}
PLAIN_DATES = ("DataNotificacao", "DataCadastro", "DataDiagnostico", "DataEncerramento", "DataObito")
COLLECTION_DATES = ("DataColeta_RT_PCR", "DataColetaTesteRapido", "DataColetaSorologia", "DataColetaSorologiaIGG")
AGE = "IdadeNaDataNotificacao"
HOSPITALISED = "FicouInternado"
RAW_COLUMNS = (
    "DataNotificacao", "DataCadastro", "DataDiagnostico", *COLLECTION_DATES, "DataEncerramento", "DataObito",
    *PLACE, *PATIENT, *CLASSIFICATION, *SYMPTOMS, *COMORBIDITIES, *TESTS, AGE, HOSPITALISED,
)
DASHBOARD_COLUMNS = (
    "Municipio", "Classificacao", "FaixaEtaria", "Evolucao", "DataNotificacao", *SYMPTOMS, *COMORBIDITIES,
)
RESULT_ATTRIBUTES = ("resultado_rt_pcr", "resultado_teste_rap", "resultado_sorologia")


@dataclass(frozen=True)
class JunkDimension:
    """A dimension whose members are the distinct tuples of a few low-cardinality columns."""

    table: str
    key: str
    attributes: dict[str, str]  # raw column -> attribute name

    def staged(self) -> dict[str, str]:
        """Staging column -> attribute name."""
        return {clean_name(raw): attribute for raw, attribute in self.attributes.items()}


def clean_name(raw: str) -> str:
    return f"{raw}_clean"


def date_name(raw: str) -> str:
    return f"{raw}_date"


PROFILE_DIM = JunkDimension("dw.dim_perfil_paciente", "sk_perfil", PATIENT)
CLASS_DIM = JunkDimension("dw.dim_classificacao", "sk_class", CLASSIFICATION)
SYMPTOM_DIM = JunkDimension("dw.dim_sintomas", "sk_sint", SYMPTOMS)
COMORBIDITY_DIM = JunkDimension("dw.dim_comorbidade", "sk_como", COMORBIDITIES)
TEST_DIM = JunkDimension("dw.dim_teste", "sk_teste", TESTS)
JUNK_DIMENSIONS = (PROFILE_DIM, CLASS_DIM, SYMPTOM_DIM, COMORBIDITY_DIM, TEST_DIM)

# role of a date in the notification fact -> staging column it is taken from
DATE_ROLES = {
    "sk_data_notificacao": "DataNotificacao_date",
    "sk_data_cadastro": "DataCadastro_date",
    "sk_data_diagnostico": "DataDiagnostico_date",
    "sk_data_coleta": "DataColeta_date",
    "sk_data_encerramento": "DataEncerramento_date",
    "sk_data_obito": "DataObito_date",
}

# --- fixed values: calendar -----------------------------------------------------------
CALENDAR_START = dt.date(2000, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
MONTHS = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
WEEKDAYS = (
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado", "Domingo",
)

# --- fixed values: health regions of the state, (regiao_es, macrorregiao) -> municipios
HOME_STATE = "ES"
ELSEWHERE = "Outros"
REGIONS = {
    ("Metropolitana", "Grande Vitória"): (
        "SERRA", "VILA VELHA", "CARIACICA", "VITORIA", "VIANA", "GUARAPARI", "FUNDAO",
    ),
    ("Metropolitana", "Metropolitana"): (
        "AFONSO CLAUDIO", "ALFREDO CHAVES", "ANCHIETA", "BREJETUBA", "CONCEICAO DO CASTELO",
        "DOMINGOS MARTINS", "ITAGUACU", "ITARANA", "LARANJA DA TERRA", "MARECHAL FLORIANO", "PIUMA",
        "RIO NOVO DO SUL", "SANTA LEOPOLDINA", "SANTA MARIA DE JETIBA", "SANTA TERESA",
        "VENDA NOVA DO IMIGRANTE",
    ),
    ("Central", "Central Norte"): (
        "ARACRUZ", "IBIRACU", "JOAO NEIVA", "LINHARES", "SOORETAMA", "RIO BANANAL", "COLATINA",
        "BAIXO GUANDU", "PANCAS", "MARILANDIA", "SAO ROQUE DO CANAA", "GOVERNADOR LINDENBERG",
        "SAO DOMINGOS DO NORTE", "ALTO RIO NOVO", "MANTENOPOLIS", "SAO GABRIEL DA PALHA",
        "VILA VALERIO", "AGUIA BRANCA",
    ),
    ("Norte", "Central Norte"): (
        "SAO MATEUS", "CONCEICAO DA BARRA", "PINHEIROS", "PEDRO CANARIO", "MONTANHA", "MUCURICI",
        "PONTO BELO", "JAGUARE", "BOA ESPERANCA", "ECOPORANGA", "BARRA DE SAO FRANCISCO",
        "AGUA DOCE DO NORTE", "VILA PAVAO", "NOVA VENECIA",
    ),
    ("Sul", "Sul"): (
        "CACHOEIRO DE ITAPEMIRIM", "ALEGRE", "APIACA", "ATILIO VIVACQUA", "BOM JESUS DO NORTE",
        "DIVINO DE SAO LOURENCO", "DORES DO RIO PRETO", "GUACUI", "IBITIRAMA", "IUNA", "IRUPI",
        "ITAPEMIRIM", "JERONIMO MONTEIRO", "MARATAIZES", "MIMOSO DO SUL", "MUNIZ FREIRE", "MUQUI",
        "PRESIDENTE KENNEDY", "SAO JOSE DO CALCADO", "VARGEM ALTA", "CASTELO", "ICONHA",
    ),
}

# --- fixed values: inhabitants --------------------------------------------------------
DEFAULT_POPULATION = 50_000
POPULATIONS = {
    "SERRA": 520_000,
    "VILA VELHA": 500_000,
    "CARIACICA": 380_000,
    "VITORIA": 365_000,
    "CACHOEIRO DE ITAPEMIRIM": 210_000,
    "LINHARES": 170_000,
    "SAO MATEUS": 130_000,
    "GUARAPARI": 125_000,
    "COLATINA": 120_000,
}
POPULATION_CHANGE_DATE = dt.date(2022, 1, 1)
POPULATION_CHANGES = {"VITORIA": 375_000, "SERRA": 540_000}

# --- fixed values: first matching comorbidity wins (smoking has no label) -------------
COMORBIDITY_LABELS = (
    ("com_cardio", "Cardiopatia"),
    ("com_diabetes", "Diabetes"),
    ("com_obesidade", "Obesidade"),
    ("com_pulmao", "Doença Pulmonar"),
    ("com_renal", "Doença Renal"),
)
