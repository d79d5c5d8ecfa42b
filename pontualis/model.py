"""Names and texts that belong to the data.

Everything here is a fixed value: published file headers, column names of the tables,
operation codes, rule names and label texts.  Results and files must carry them exactly.
"""

from __future__ import annotations

# -- fixed values: header text in the published file -> column name ------------------

FLIGHT_HEADERS = {
    "ICAO Empresa Aérea": "icao_empresa",
    "Número Voo": "numero_voo",
    "Código Autorização (DI)": "codigo_di",
    "Código Tipo Linha": "codigo_tipo_linha",
    "ICAO Aeródromo Origem": "icao_origem",
    "ICAO Aeródromo Destino": "icao_destino",
    "Partida Prevista": "partida_prevista",
    "Partida Real": "partida_real",
    "Chegada Prevista": "chegada_prevista",
    "Chegada Real": "chegada_real",
    "Situação Voo": "situacao_voo",
    "Código Justificativa": "codigo_justificativa",
}

AIRPORT_HEADERS = {
    "Código OACI": "icao",
    "CIAD": "ciad",
    "Nome": "nome",
    "Município": "municipio",
    "UF": "uf",
    "Município Servido": "municipio_servido",
    "UF Servido": "uf_servido",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Altitude": "altitude",
    "Situação": "situacao",
}

AIRLINE_HEADERS = {
    "ICAO": "icao",
    "Estrangeira": "sigla_iata",
    "Razao": "razao_social",
    "Servico": "servico",
    "Cidade": "cidade",
    "UF": "uf",
    "Ativa": "situacao",
}

# -- fixed values: operation codes (domain, code, description) -----------------------

OPERATION_CODE_COLUMNS = ("dominio", "codigo", "descricao")
OPERATION_CODES = [
    ("codigo_di", "0", "Etapa Regular"),
    ("codigo_di", "2", "Etapa Extra"),
    ("codigo_di", "3", "Etapa de Retorno"),
    ("codigo_di", "4", "Inclusão de Etapa"),
    ("codigo_di", "6", "Etapa Não Remunerada Sem Transporte de Objetos"),
    ("codigo_di", "7", "Etapa de Voo de Fretamento"),
    ("codigo_di", "9", "Etapa de Voo Charter"),
    ("codigo_di", "D", "Etapa de Voo Duplicada"),
    ("codigo_di", "E", "Etapa Não Remunerada Com Transporte de Objetos"),
    ("codigo_tipo_linha", "N", "Doméstica Mista"),
    ("codigo_tipo_linha", "C", "Doméstica Cargueira"),
    ("codigo_tipo_linha", "I", "Internacional Mista"),
    ("codigo_tipo_linha", "G", "Internacional Cargueira"),
]

# -- fixed values: how the source files write "absent" -------------------------------

NO_INSTANT = "null"
NO_REASON = "N/A"

# -- fixed values: status, audit columns, label texts --------------------------------

FLOWN = "REALIZADO"
CANCELLED = "CANCELADO"

SOURCE_FILE = "_arquivo_origem"
INGESTED_AT = "_ingerido_em"
TRANSFORMED_AT = "_transformado_em"
QUARANTINED_AT = "_quarentenado_em"
PROCESSED_AT = "_processado_em"

NATIONAL = "nacional"
FOREIGN = "estrangeira"

DOMESTIC_LINES = ("N", "C")
INTERNATIONAL_LINES = ("I", "G")
DOMESTIC = "Domestico"
INTERNATIONAL = "Internacional"
BRAZIL = "Brasil"
ABROAD = "Exterior"
UNKNOWN_CARRIER = "COMPANHIA NAO CADASTRADA"
UNKNOWN_AIRPORT = "AEROPORTO FORA DO CADASTRO ANAC"

# Sunday first, as Spark's dayofweek counts.
WEEKDAYS = (
    "domingo", "segunda-feira", "terca-feira", "quarta-feira",
    "quinta-feira", "sexta-feira", "sabado",
)

# Location-indicator prefixes that ICAO assigns to Brazil.
BRAZIL_PREFIXES = ("SB", "SD", "SI", "SJ", "SN", "SS", "SW")

# -- fixed values: columns of the tables ---------------------------------------------

FLIGHT_COLUMNS = tuple(FLIGHT_HEADERS.values())
INSTANTS = ("partida_prevista", "partida_real", "chegada_prevista", "chegada_real")
DELAYS = ("atraso_partida_min", "atraso_chegada_min", "minutos_recuperados")

#: What a preview of the flights shows.
PREVIEW_COLUMNS = (
    "icao_empresa", "numero_voo", "icao_origem", "icao_destino",
    "partida_prevista", "partida_prevista_data", "partida_prevista_hora",
    "atraso_partida_min", "atraso_chegada_min", "minutos_recuperados", "situacao_voo",
)

#: Bronze tables, as the counts of a layer call them.
BRONZE_TABLES = ("aerodromos", "empresas_nacionais", "empresas_estrangeiras", "codigos_operacao", "vra")

PAIR_KEYS = (SOURCE_FILE, "icao_empresa", "numero_voo", "icao_origem", "icao_destino")

OBT_COLUMNS = (
    "icao_empresa", "nome_companhia", "numero_voo",
    "codigo_di", "descricao_di", "codigo_tipo_linha", "descricao_tipo_linha", "escopo_voo",
    "icao_origem", "nome_aeroporto_origem", "municipio_origem", "uf_origem", "pais_origem",
    "icao_destino", "nome_aeroporto_destino", "municipio_destino", "uf_destino", "pais_destino",
    "rota_icao", "rota_municipios",
    "partida_prevista", "partida_prevista_data", "partida_prevista_hora",
    "hora_partida_prevista", "dia_semana", "mes_referencia",
    "partida_real", "chegada_prevista", "chegada_real",
    "atraso_partida_min", "atraso_chegada_min", "minutos_recuperados",
    "atraso_fora_de_faixa", "partida_pontual", "chegada_pontual",
    "situacao_voo", "voo_realizado", "voo_cancelado",
    PROCESSED_AT,
)

FACT_COLUMNS = (
    "icao_empresa", "nome_companhia", "cadastro_companhia", "numero_voo",
    "codigo_di", "descricao_di", "codigo_tipo_linha", "descricao_tipo_linha", "escopo_voo",
    "icao_origem", "icao_destino", "rota",
    "partida_prevista", "partida_prevista_data", "partida_prevista_hora",
    "hora_partida_prevista", "dia_semana", "mes_referencia",
    "partida_real", "chegada_prevista", "chegada_real",
    "atraso_partida_min", "atraso_chegada_min", "minutos_recuperados",
    "atraso_fora_de_faixa", "partida_pontual", "chegada_pontual",
    "situacao_voo", "voo_realizado", "voo_cancelado",
    PROCESSED_AT,
)

DIM_COLUMNS = (
    "icao_aeroporto", "nome_aeroporto", "municipio_aeroporto", "uf_aeroporto",
    "pais_aeroporto", "no_cadastro_anac", PROCESSED_AT,
)

# -- texts of this library's own -----------------------------------------------------

UNKNOWN_CODE = "CODIGO NAO CATALOGADO"
