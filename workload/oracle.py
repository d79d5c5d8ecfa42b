"""SQL side of the registered queries, for DuckDB over the same tables.

Written from the definitions, not from the Spark code: the reconciliation here is the
literal many-to-many join, the quarantine a negated conjunction, the fact one SELECT.
"""

from __future__ import annotations

# Written out here, not taken from the code under test: a wrong value must show.
DI_CODES = ("0", "2", "3", "4", "6", "7", "9", "D", "E", "1")
LINE_TYPES = ("N", "C", "I", "G")
INSTANTS = ("partida_prevista", "partida_real", "chegada_prevista", "chegada_real")
DELAYS = ("atraso_partida_min", "atraso_chegada_min", "minutos_recuperados")
FLIGHT_COLUMNS = ("icao_empresa", "numero_voo", "codigo_di", "codigo_tipo_linha", "icao_origem",
                  "icao_destino", "partida_prevista", "partida_real", "chegada_prevista",
                  "chegada_real", "situacao_voo", "codigo_justificativa")
PAIR_KEYS = ("_arquivo_origem", "icao_empresa", "numero_voo", "icao_origem", "icao_destino")
WEEKDAYS = ("domingo", "segunda-feira", "terca-feira", "quarta-feira", "quinta-feira",
            "sexta-feira", "sabado")
UNKNOWN_AIRPORT = "AEROPORTO FORA DO CADASTRO ANAC"
UNKNOWN_CARRIER = "COMPANHIA NAO CADASTRADA"
UNKNOWN_CODE = "CODIGO NAO CATALOGADO"
# Operation codes.
OPERATION_CODES = (
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
)

_NINE = "strftime({}, '%Y-%m-%d %H:%M:%S.%f') || '000'"
_ZERO = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _strings(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


_RAW = f"""
raw AS (
  SELECT event_id,
    CASE WHEN user_id % 10 = 9 THEN NULL
         ELSE 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS icao_empresa,
    CAST(user_id AS VARCHAR) AS numero_voo,
    ([{_strings(DI_CODES)}])[1 + event_id % 10] AS codigo_di,
    ([{_strings(LINE_TYPES)}])[1 + user_id % 4] AS codigo_tipo_linha,
    'N' || CAST(user_id % 30 AS VARCHAR) AS icao_origem,
    'N' || CAST(event_id % 28 AS VARCHAR) AS icao_destino,
    CASE WHEN event_id % 101 = 0 THEN 'null'
         ELSE {_ZERO.format("date_trunc('hour', ts)")} END AS partida_prevista,
    CASE WHEN event_type = 'error' THEN 'null'
         WHEN event_id % 211 = 0 THEN {_NINE.format("ts - to_minutes(1440)")}
         WHEN event_id % 223 = 0 THEN {_NINE.format("ts + to_minutes(2880)")}
         WHEN event_id % 3 = 0 THEN {_ZERO.format("ts")}
         ELSE {_NINE.format("ts")} END AS partida_real,
    CASE WHEN event_id % 101 = 0 THEN 'null'
         WHEN event_id % 307 = 0 THEN {_ZERO.format("date_trunc('hour', ts) - to_minutes(30)")}
         ELSE {_ZERO.format("date_trunc('hour', ts) + to_minutes(120)")} END AS chegada_prevista,
    CASE WHEN event_type = 'error' THEN 'null'
         ELSE {_NINE.format("ts + to_minutes(CAST(floor(value * 5) AS BIGINT))")}
         END AS chegada_real,
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'OUTRO'
         WHEN event_type = 'error' THEN 'CANCELADO'
         ELSE 'REALIZADO' END AS situacao_voo,
    'N/A' AS codigo_justificativa,
    'month_' || CAST(event_id % 12 AS VARCHAR) || '.csv' AS _arquivo_origem
  FROM events)"""

_SILVER = """
typed AS (
  SELECT event_id, icao_empresa, numero_voo, codigo_di, codigo_tipo_linha,
    icao_origem, icao_destino,
    TRY_CAST(nullif(partida_prevista, 'null') AS TIMESTAMP) AS partida_prevista,
    TRY_CAST(nullif(partida_real, 'null') AS TIMESTAMP) AS partida_real,
    TRY_CAST(nullif(chegada_prevista, 'null') AS TIMESTAMP) AS chegada_prevista,
    TRY_CAST(nullif(chegada_real, 'null') AS TIMESTAMP) AS chegada_real,
    situacao_voo, nullif(codigo_justificativa, 'N/A') AS codigo_justificativa,
    _arquivo_origem
  FROM raw),
silver AS (
  SELECT *,
    """ + ",\n    ".join(
    f"CAST({c} AS DATE) AS {c}_data, strftime({c}, '%H:%M') AS {c}_hora" for c in INSTANTS
) + """,
    date_sub('minute', partida_prevista, partida_real) AS atraso_partida_min,
    date_sub('minute', chegada_prevista, chegada_real) AS atraso_chegada_min,
    date_sub('minute', partida_prevista, partida_real)
      - date_sub('minute', chegada_prevista, chegada_real) AS minutos_recuperados
  FROM typed)"""

_AIRPORTS = """
aerodromos AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS icao, n_name AS nome,
         'Municipio ' || CAST(n_nationkey AS VARCHAR) AS municipio,
         'Estado ' || CAST(n_regionkey AS VARCHAR) AS uf_nome
  FROM nation)"""

_CARRIERS = """
nacionais AS (
  SELECT CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END AS icao,
    'L' || right(CAST(c_custkey AS VARCHAR), 1) AS sigla_iata,
    'Linhas "' || CAST(c_custkey AS VARCHAR) || '" S.A.' AS razao_social,
    c_mktsegment AS servico, 'São Paulo' AS cidade,
    CAST(c_nationkey AS VARCHAR) AS uf, 'ATIVA' AS situacao
  FROM customer),
estrangeiras AS (
  SELECT s_name AS icao, 'A' || right(CAST(s_suppkey AS VARCHAR), 1) AS sigla_iata,
    'Air ' || CAST(s_suppkey AS VARCHAR) AS razao_social,
    'INTERNACIONAL' AS servico, 'Brasília' AS cidade,
    CAST(s_nationkey AS VARCHAR) AS uf, 'ATIVA' AS situacao
  FROM supplier),
empresas AS (
  SELECT *, 'nacional' AS origem_cadastro FROM nacionais
  UNION ALL SELECT *, 'estrangeira' FROM estrangeiras)"""

_CODES = """
codigos(dominio, codigo, descricao) AS (
  VALUES """ + ", ".join(f"({_strings(row)})" for row in OPERATION_CODES) + ")"

_MARKED = """
marcado AS (
  SELECT s.*,
    icao_origem IN (SELECT icao FROM aerodromos) AS origem_no_cadastro,
    icao_destino IN (SELECT icao FROM aerodromos) AS destino_no_cadastro,
    coalesce(icao_empresa IN (SELECT icao FROM empresas WHERE icao <> ''), FALSE)
      AS empresa_no_cadastro
  FROM silver s)"""

# (rule, condition under which a row fails it)
_FAILS = [
    ("horarios_previstos_presentes", "partida_prevista IS NULL OR chegada_prevista IS NULL"),
    ("situacao_voo_conhecida",
     "situacao_voo IS NULL OR situacao_voo NOT IN ('REALIZADO', 'CANCELADO')"),
    ("chegada_prevista_depois_da_partida_prevista",
     "coalesce(chegada_prevista <= partida_prevista, FALSE)"),
    ("chegada_real_depois_da_partida_real", "coalesce(chegada_real <= partida_real, FALSE)"),
    ("atraso_partida_plausivel",
     "coalesce(atraso_partida_min < -120 OR atraso_partida_min > 1440, FALSE)"),
    ("atraso_chegada_plausivel",
     "coalesce(atraso_chegada_min < -120 OR atraso_chegada_min > 1440, FALSE)"),
    ("empresa_no_cadastro_anac", "NOT empresa_no_cadastro"),
    ("aeroporto_origem_no_cadastro_anac", "NOT origem_no_cadastro"),
    ("aeroporto_destino_no_cadastro_anac", "NOT destino_no_cadastro"),
]
_ANY_FAILS = " OR ".join(f"({condition})" for _, condition in _FAILS)
_N_FAILS = " + ".join(f"CAST(({condition}) AS INTEGER)" for _, condition in _FAILS)
_REASONS = "concat_ws(' | ', " + ", ".join(
    f"CASE WHEN {condition} THEN '{rule}' END" for rule, condition in _FAILS
) + ")"

_RANGE = """
faixa AS (
  SELECT *, coalesce(atraso_partida_min NOT BETWEEN -120 AND 1440, FALSE)
         OR coalesce(atraso_chegada_min NOT BETWEEN -120 AND 1440, FALSE) AS fora
  FROM {})"""

_VALID = ", ".join(f"CASE WHEN NOT fora THEN {d} END AS {d}" for d in DELAYS)

_FACT = """
unicos AS (
  SELECT DISTINCT """ + ", ".join(FLIGHT_COLUMNS) + """, partida_prevista_data,
    partida_prevista_hora, atraso_partida_min, atraso_chegada_min, minutos_recuperados
  FROM silver),""" + _RANGE.format("unicos") + """,
validos AS (
  SELECT * EXCLUDE (atraso_partida_min, atraso_chegada_min, minutos_recuperados),
    """ + _VALID + """
  FROM faixa),
fato AS (
  SELECT f.icao_empresa,
    coalesce(e.razao_social, concat_ws(' ', '""" + UNKNOWN_CARRIER + """', f.icao_empresa))
      AS nome_companhia,
    e.origem_cadastro AS cadastro_companhia, f.numero_voo, f.codigo_di,
    coalesce(di.descricao, concat_ws(' ', '""" + UNKNOWN_CODE + """', f.codigo_di))
      AS descricao_di,
    f.codigo_tipo_linha,
    coalesce(tl.descricao, concat_ws(' ', '""" + UNKNOWN_CODE + """', f.codigo_tipo_linha))
      AS descricao_tipo_linha,
    CASE WHEN f.codigo_tipo_linha IN ('N', 'C') THEN 'Domestico'
         WHEN f.codigo_tipo_linha IN ('I', 'G') THEN 'Internacional' END AS escopo_voo,
    f.icao_origem, f.icao_destino, f.icao_origem || ' - ' || f.icao_destino AS rota,
    f.partida_prevista, f.partida_prevista_data, f.partida_prevista_hora,
    CAST(hour(f.partida_prevista) AS INTEGER) AS hora_partida_prevista,
    ([""" + _strings(WEEKDAYS) + """])[1 + dayofweek(f.partida_prevista)] AS dia_semana,
    CAST(date_trunc('month', f.partida_prevista) AS DATE) AS mes_referencia,
    f.partida_real, f.chegada_prevista, f.chegada_real,
    f.atraso_partida_min, f.atraso_chegada_min, f.minutos_recuperados,
    f.fora AS atraso_fora_de_faixa,
    f.atraso_partida_min <= 15 AS partida_pontual,
    f.atraso_chegada_min <= 15 AS chegada_pontual,
    f.situacao_voo,
    f.situacao_voo IS NOT DISTINCT FROM 'REALIZADO' AS voo_realizado,
    f.situacao_voo IS NOT DISTINCT FROM 'CANCELADO' AS voo_cancelado
  FROM validos f
  LEFT JOIN empresas e ON f.icao_empresa = e.icao AND e.icao <> ''
  LEFT JOIN codigos di ON di.dominio = 'codigo_di' AND f.codigo_di = di.codigo
  LEFT JOIN codigos tl ON tl.dominio = 'codigo_tipo_linha' AND f.codigo_tipo_linha = tl.codigo)"""

_COUNTRY = "CASE WHEN {} LIKE 'N1%' THEN 'Brasil' ELSE 'Exterior' END"

_DIM = """
dim AS (
  SELECT c.code AS icao_aeroporto,
    coalesce(a.nome, '""" + UNKNOWN_AIRPORT + """ ' || c.code) AS nome_aeroporto,
    a.municipio AS municipio_aeroporto, a.uf_nome AS uf_aeroporto,
    """ + _COUNTRY.format("c.code") + """ AS pais_aeroporto,
    a.icao IS NOT NULL AS no_cadastro_anac
  FROM (SELECT icao_origem AS code FROM silver UNION SELECT icao_destino FROM silver) c
  LEFT JOIN aerodromos a ON a.icao = c.code)"""


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _flights(select: str) -> str:
    return _with(select, _RAW, _SILVER)


def _contract(select: str) -> str:
    return _with(select, _RAW, _SILVER, _AIRPORTS, _CARRIERS, _MARKED)


def _gold(select: str) -> str:
    return _with(select, _RAW, _SILVER, _CARRIERS, _CODES, _FACT)


def _range(select: str) -> str:
    return _with(select, _RAW, _SILVER, _RANGE.format("silver"))


_KPIS = """count(*) AS voos,
  count(*) FILTER (WHERE voo_realizado) AS voos_realizados,
  count(*) FILTER (WHERE voo_cancelado) AS voos_cancelados,
  avg(CAST(voo_cancelado AS INTEGER)) AS taxa_cancelamento,
  avg(atraso_partida_min) AS atraso_partida_medio,
  avg(atraso_chegada_min) AS atraso_chegada_medio,
  count(partida_pontual) AS partidas_avaliadas,
  avg(CAST(partida_pontual AS INTEGER)) AS pontualidade_partida,
  avg(CAST(chegada_pontual AS INTEGER)) AS pontualidade_chegada"""


def _kpis(axis: str) -> str:
    return _gold(f"SELECT {axis}, {_KPIS} FROM fato GROUP BY {axis}")


def _count_if(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


_DERIVED = [
    ("linhas_com_partida_prevista_data", "partida_prevista_data"),
    ("linhas_com_partida_prevista_hora", "partida_prevista_hora"),
    ("linhas_com_atraso_partida", "atraso_partida_min"),
    ("linhas_com_atraso_chegada", "atraso_chegada_min"),
    ("linhas_com_minutos_recuperados", "minutos_recuperados"),
]


def _pair_measures() -> str:
    items = [_count_if(f"b.{c} = 'null'", f"bronze_{c}_str_null") for c in INSTANTS]
    items += [_count_if(f"s.{c} IS NULL", f"silver_{c}_null_real") for c in INSTANTS]
    items += [_count_if(f"b.{c} <> 'null' AND s.{c} IS NOT NULL", f"{c}_cast_ok") for c in INSTANTS]
    items += [_count_if("b.codigo_justificativa = 'N/A'", '"bronze_justificativa_NA"'),
              _count_if("s.codigo_justificativa IS NULL", "silver_justificativa_null")]
    items += [_count_if(f"s.{c} IS NOT NULL", name) for name, c in _DERIVED]
    return ",\n  ".join([*items, "count(*) AS total_linhas"])


_PAIR_JOIN = f"FROM raw b JOIN silver s USING ({', '.join(PAIR_KEYS)})"

_RAW_TEXT = ", ".join(f"{c}" for c in FLIGHT_COLUMNS)

_OBT = """
SELECT f.* EXCLUDE (rota, cadastro_companhia), f.rota AS rota_icao,
  o.nome_aeroporto AS nome_aeroporto_origem, o.municipio_aeroporto AS municipio_origem,
  o.uf_aeroporto AS uf_origem, o.pais_aeroporto AS pais_origem,
  d.nome_aeroporto AS nome_aeroporto_destino, d.municipio_aeroporto AS municipio_destino,
  d.uf_aeroporto AS uf_destino, d.pais_aeroporto AS pais_destino,
  coalesce(o.municipio_aeroporto, f.icao_origem) || ' - '
    || coalesce(d.municipio_aeroporto, f.icao_destino) AS rota_municipios
FROM fato f LEFT JOIN dim o ON f.icao_origem = o.icao_aeroporto
LEFT JOIN dim d ON f.icao_destino = d.icao_aeroporto"""


def _absurd(column: str, **places: str) -> str:
    cases = " ".join(f"WHEN event_id % 7 = {p[1:]} THEN '{v}'" for p, v in places.items())
    return f"CASE {cases} ELSE {column} END AS {column}"


_FIRST, _LATE, _LAST = "0001-01-01 00:00:00", "5500-06-01 12:00:00", "9999-12-31 23:59:59"
_ABSURD = _with("""
SELECT event_id, atraso_partida_min AS lido_atraso_partida_min,
  atraso_chegada_min AS lido_atraso_chegada_min,
  minutos_recuperados AS lido_minutos_recuperados, """ + _VALID + """,
  fora AS atraso_fora_de_faixa, concat_ws(' | ',
    CASE WHEN coalesce(atraso_partida_min NOT BETWEEN -120 AND 1440, FALSE)
      THEN 'atraso_partida_plausivel' END,
    CASE WHEN coalesce(atraso_chegada_min NOT BETWEEN -120 AND 1440, FALSE)
      THEN 'atraso_chegada_plausivel' END) AS regras
FROM faixa""", _RAW.replace("raw AS", "cru AS"), """
raw AS (SELECT * REPLACE (""" + ", ".join([
    _absurd("partida_prevista", p0=_FIRST, p1=_LAST),
    _absurd("partida_real", p0=_LAST, p1=_FIRST, p2=_LATE),
    _absurd("chegada_prevista", p0=_LAST, p1=_FIRST, p3=_LATE),
    _absurd("chegada_real", p0=_FIRST, p1=_LAST),
]) + ") FROM cru)", _SILVER, _RANGE.format("silver"))

# A named entry before one without a name, the national registry before the foreign one,
# and of what is left the smallest name.
_REPEATED = _with(f"""
, entradas AS (
  SELECT icao, razao_social, origem_cadastro FROM empresas
  WHERE icao NOT IN (SELECT icao FROM nacionais WHERE CAST(uf AS INTEGER) % 5 = 0)
  UNION ALL
  SELECT icao, CASE WHEN CAST(uf AS INTEGER) % 2 = 0 THEN '' END, origem_cadastro FROM empresas
  UNION ALL
  SELECT icao, 'Outra ' || razao_social, 'estrangeira' FROM empresas
  WHERE CAST(uf AS INTEGER) % 3 = 0
), escolhidas AS (
  SELECT * FROM entradas WHERE icao <> ''
  QUALIFY row_number() OVER (PARTITION BY icao ORDER BY coalesce(razao_social, '') = '',
    origem_cadastro <> 'nacional', razao_social NULLS FIRST) = 1
)
SELECT event_id, icao_empresa,
  coalesce(razao_social, concat_ws(' ', '{UNKNOWN_CARRIER}', icao_empresa)) AS nome_companhia,
  origem_cadastro AS cadastro_companhia
FROM raw LEFT JOIN escolhidas ON icao = icao_empresa""", _RAW, _CARRIERS)



def _changes(*columns: str) -> str:
    """What differs between rows a and b, as one text."""
    return "concat_ws('; ', " + ", ".join(
        f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}: ' || "
        f"coalesce(CAST(a.{c} AS VARCHAR), '(vazio)') || ' -> ' || "
        f"coalesce(CAST(b.{c} AS VARCHAR), '(vazio)') END" for c in columns) + ")"


ORACLE: dict[str, str] = {
    "scan_delimited": _with(
        f"SELECT CAST(event_id AS VARCHAR) AS event_id, {_RAW_TEXT}, "
        "CAST(NULL AS VARCHAR) AS _linha_malformada FROM raw", _RAW),
    "mixed_headers": _with(
        "SELECT CAST(event_id AS VARCHAR) AS event_id, * EXCLUDE (event_id, _arquivo_origem) "
        "REPLACE (CASE WHEN event_id % 4 <> 3 THEN codigo_tipo_linha END AS codigo_tipo_linha), "
        "CAST(NULL AS VARCHAR) AS _linha_malformada FROM raw", _RAW),
    "load_changes": _with("""
SELECT coalesce(a.event_id, b.event_id) AS event_id, coalesce(b.numero_voo, a.numero_voo) AS numero_voo,
  """ + _changes("partida_real", "situacao_voo", "codigo_justificativa") + """ AS alteracoes,
  CASE WHEN a.event_id IS NULL THEN 'ADICIONADA' WHEN b.event_id IS NULL THEN 'REMOVIDA'
       ELSE 'ALTERADA' END AS status
FROM raw a FULL OUTER JOIN depois b ON a.event_id = b.event_id
WHERE alteracoes <> ''""", _RAW, """
depois AS (
  SELECT * REPLACE (
    CASE WHEN mudou THEN 'CANCELADO' ELSE situacao_voo END AS situacao_voo,
    CASE WHEN NOT mudou OR event_id % 2 = 1 THEN codigo_justificativa END AS codigo_justificativa,
    CASE WHEN mudou THEN 'null' ELSE partida_real END AS partida_real)
  FROM (SELECT *, event_id < 60 AND event_id % 3 = 1 AS mudou FROM raw)
  WHERE event_id >= 60 OR event_id % 3 <> 0
  UNION ALL
  SELECT * REPLACE (event_id + 1000000000 AS event_id), FALSE FROM raw WHERE event_id < 20)"""),
    "scan_unquoted": """
SELECT c_name AS icao, CAST(c_custkey AS VARCHAR) AS ciad,
  'Aeródromo São ' || CAST(c_custkey AS VARCHAR) AS nome,
  '"' || c_mktsegment AS municipio, 'Goiás' AS uf_nome,
  'Vila\\' || CAST(c_custkey AS VARCHAR) AS municipio_servido, 'Pará' AS uf_servido_nome,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '°52''06"S' AS latitude_dms,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '°10''59"W' AS longitude_dms,
  CAST(c_custkey + 0.5 AS DOUBLE) AS altitude_m, 'ABERTO' AS situacao
FROM customer""",
    "bronze_registries": _with("""
SELECT nullif(icao, '') AS icao, sigla_iata, razao_social, servico, cidade, uf, situacao,
  CASE origem_cadastro WHEN 'nacional' THEN 'nacionais.csv' ELSE 'estrangeiras.csv' END
    AS _arquivo_origem
FROM empresas""", _CARRIERS),
    "seed_codes": _with("""
SELECT dominio, codigo, descricao, voos FROM codigos LEFT JOIN (
  SELECT 'codigo_di' AS dominio, codigo_di AS codigo, count(*) AS voos FROM raw GROUP BY 2
  UNION ALL
  SELECT 'codigo_tipo_linha', codigo_tipo_linha, count(*) FROM raw GROUP BY 2
) USING (dominio, codigo)""", _RAW, _CODES),
    "rows_per_file": """
SELECT 'month_' || (event_id % 12) || '.csv' AS arquivo, count(*) AS linhas, TRUE AS identificado
FROM events GROUP BY event_id % 12""",
    "malformed_rows": _with("""
SELECT CAST(event_id AS VARCHAR) AS event_id, numero_voo, situacao_voo,
  CASE WHEN event_id % 50 = 0 THEN '"SOBRA"' END AS sobra FROM raw""", _RAW),
    "idempotent_load": """
SELECT count(*) AS carga_1, count(*) AS carga_2, 0 AS linhas_diferentes FROM events""",
    "load_compare": """
SELECT 'carga_1' AS versao, count(*) AS linhas, FALSE AS posterior_a_primeira FROM events
UNION ALL SELECT 'carga_2', count(*), TRUE FROM events""",
    "sample_rows": """
SELECT least(10, count(*)) AS mostradas, least(10, count(*)) AS existentes FROM events""",
    "absurd_delays": _ABSURD,
    "repeated_codes": _REPEATED,
    "refresh_obt": _with(_OBT, _RAW, _SILVER, _AIRPORTS, _CARRIERS, _CODES, _FACT,
                         _DIM.replace(_COUNTRY.format("c.code"), "'Exterior'")),
    "refresh_quarantine": _contract(f"""
SELECT * EXCLUDE (event_id, _arquivo_origem), {_REASONS} AS motivos_quarentena
FROM marcado WHERE {_ANY_FAILS}"""),
    "refresh_reports": _contract("""
SELECT 'vra' AS nome, count(*) AS a, count(*) AS b FROM events
UNION ALL SELECT 'aerodromos', count(*), count(*) FROM nation
UNION ALL SELECT 'codigos_operacao', 13, 13
UNION ALL """ + "\nUNION ALL\n".join(
        f"SELECT '{rule}', count(*) FILTER (WHERE NOT ({c})), "
        f"count(*) FILTER (WHERE {c}) FROM marcado" for rule, c in _FAILS)),
    "project_map": """
SELECT CAST(event_id AS VARCHAR) AS id_evento, CAST(user_id AS VARCHAR) AS numero_voo,
  event_type AS situacao_voo, props AS observacao FROM events""",
    "silver_typed": _flights("SELECT * FROM silver"),
    "silver_delays": _flights("SELECT event_id, " + ", ".join(DELAYS) + " FROM silver"),
    "filter_in": _with("""
SELECT razao_social, icao, servico FROM nacionais
WHERE servico IN ('BUILDING', 'MACHINERY')""", _CARRIERS),
    "top_k": _flights("""
SELECT event_id, icao_empresa, numero_voo, icao_origem, icao_destino, partida_prevista,
  partida_prevista_data, partida_prevista_hora, atraso_partida_min, atraso_chegada_min,
  minutos_recuperados, situacao_voo
FROM silver ORDER BY partida_prevista NULLS FIRST, event_id LIMIT 5"""),
    "registry_union": _with("SELECT * FROM empresas", _CARRIERS),
    "clean_keys": _with(
        "SELECT icao FROM empresas WHERE length(icao) > 0 GROUP BY icao", _CARRIERS),
    "ref_flags": _contract("""
SELECT event_id, origem_no_cadastro, destino_no_cadastro, empresa_no_cadastro FROM marcado"""),
    "rule_metrics": _contract("\nUNION ALL\n".join(
        f"SELECT '{rule}' AS regra, count(*) FILTER (WHERE NOT ({c})) AS aprovados, "
        f"count(*) FILTER (WHERE {c}) AS reprovados FROM marcado" for rule, c in _FAILS)),
    "audited_rows": _contract(f"""
SELECT event_id, situacao_voo, atraso_partida_min, {_N_FAILS} AS reprovadas FROM marcado"""),
    "quarantine": _contract(
        f"SELECT *, {_REASONS} AS motivos_quarentena FROM marcado WHERE {_ANY_FAILS}"),
    "quarantine_reasons": _contract(f"""
SELECT {_REASONS} AS motivos_quarentena, count(*) AS voos
FROM marcado WHERE {_ANY_FAILS} GROUP BY 1"""),
    "count_conservation": _flights("""
SELECT r AS bronze_vra, s AS silver_vra, r - s AS diferenca
FROM (SELECT count(*) AS r FROM raw), (SELECT count(*) AS s FROM silver)"""),
    "union_conservation": _with("""
SELECT n AS bronze_nacionais, e AS bronze_estrangeiras, n + e AS soma_esperada,
  t AS silver_empresas, n + e - t AS diferenca
FROM (SELECT count(*) AS n FROM nacionais), (SELECT count(*) AS e FROM estrangeiras),
  (SELECT count(*) AS t FROM empresas)""", _CARRIERS),
    "layer_counts": _with("""
SELECT 'aerodromos' AS tabela, count(*) AS total_registros FROM nation
UNION ALL SELECT 'empresas_nacionais', count(*) FROM customer
UNION ALL SELECT 'empresas_estrangeiras', count(*) FROM supplier
UNION ALL SELECT 'codigos_operacao', count(*) FROM codigos
UNION ALL SELECT 'vra', count(*) FROM events""", _CODES),
    "registry_summary": _with("""
SELECT origem_cadastro, count(*) AS linhas, count(nullif(icao, '')) AS com_icao
FROM empresas GROUP BY 1""", _CARRIERS),
    "sentinel_profile": _with("SELECT count(*) AS linhas, " + ", ".join([
        _count_if("partida_real IS NULL", "partida_real_null_de_verdade"),
        _count_if("partida_real = 'null'", "partida_real_string_null"),
        _count_if("partida_prevista = 'null'", "partida_prevista_string_null"),
        _count_if("partida_prevista LIKE '%.%'", "com_fracao_de_segundo"),
        _count_if("partida_real LIKE '%.%'", "partida_real_com_fracao"),
    ]) + " FROM raw", _RAW),
    "typing_success": _flights("SELECT " + ", ".join(
        f"count({c}) AS {c}_ok" for c in INSTANTS
    ) + """, count(atraso_partida_min) AS atraso_partida_ok,
  count(minutos_recuperados) AS minutos_recuperados_ok FROM silver"""),
    "transform_profile": _flights(
        f"SELECT {_pair_measures()}\nFROM raw b JOIN silver s USING (event_id)"),
    "reconcile_pairs": _flights(
        f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (SELECT {_pair_measures()}\n{_PAIR_JOIN})"),
    "side_by_side": _flights("SELECT " + ", ".join([
        *[f"s.{c}" for c in ("icao_empresa", "numero_voo", "icao_origem", "icao_destino",
                             "_arquivo_origem", "situacao_voo")],
        *[f"b.{c} AS bronze_{c}" for c in (*INSTANTS, "codigo_justificativa")],
        *[f"CAST(s.{c} AS VARCHAR) AS silver_{c}" for c in (*INSTANTS, "codigo_justificativa")],
        *[f"s.{c}_{p} AS silver_{c}_{p}" for c in INSTANTS[:2] for p in ("data", "hora")],
        *[f"s.{d} AS silver_{d}" for d in DELAYS],
    ]) + f"\n{_PAIR_JOIN}\n"
        "ORDER BY s.partida_prevista NULLS FIRST, s.event_id, b.event_id LIMIT 5"),
    "keyed_diff": _flights("""
, programados AS (SELECT numero_voo, icao_destino, count(*) AS voos FROM silver
                  WHERE partida_prevista IS NOT NULL GROUP BY 1, 2),
realizados AS (SELECT numero_voo, icao_destino, count(*) AS voos FROM silver
               WHERE partida_real IS NOT NULL GROUP BY 1, 2)
SELECT coalesce(p.numero_voo, r.numero_voo) AS numero_voo,
  coalesce(p.icao_destino, r.icao_destino) AS icao_destino,
  p.voos AS programados, r.voos AS realizados,
  CASE WHEN p.voos IS NULL THEN 'ADICIONADA' WHEN r.voos IS NULL THEN 'REMOVIDA'
       WHEN p.voos <> r.voos THEN 'ALTERADA' ELSE 'INALTERADA' END AS status
FROM programados p FULL OUTER JOIN realizados r
  ON p.numero_voo = r.numero_voo AND p.icao_destino = r.icao_destino"""),
    "service_changes": _flights("""
, a AS (SELECT numero_voo, icao_destino, count(*) AS voos, min(partida_prevista_hora) AS primeira_hora,
               max(situacao_voo) AS situacao, max(icao_empresa) AS icao_empresa FROM silver
        WHERE partida_prevista IS NOT NULL GROUP BY 1, 2),
b AS (SELECT numero_voo, icao_destino, count(*) AS voos, min(partida_real_hora) AS primeira_hora,
             max(situacao_voo) AS situacao, max(icao_empresa) AS icao_empresa FROM silver
      WHERE partida_real IS NOT NULL GROUP BY 1, 2)
SELECT coalesce(b.numero_voo, a.numero_voo) AS numero_voo,
  coalesce(b.icao_destino, a.icao_destino) AS icao_destino,
  CASE WHEN b.voos IS NULL THEN a.icao_empresa ELSE b.icao_empresa END AS icao_empresa,
  """ + _changes("voos", "primeira_hora", "situacao") + """ AS alteracoes,
  CASE WHEN a.voos IS NULL THEN 'ADICIONADA' WHEN b.voos IS NULL THEN 'REMOVIDA'
       WHEN alteracoes <> '' THEN 'ALTERADA' ELSE 'INALTERADA' END AS status
FROM a FULL OUTER JOIN b ON a.numero_voo = b.numero_voo AND a.icao_destino = b.icao_destino"""),
    "completeness": """
SELECT lang, count(*) AS linhas,
  count(*) - count(quality) AS sem_valor,
  CAST(round(100.0 * count(quality) / count(*), 1) AS DOUBLE) AS pct_preenchido
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    "attr_listing": """
SELECT s_name AS entidade, 'razao_social' AS atributo,
  'Air ' || CAST(s_suppkey AS VARCHAR) AS valor FROM supplier
UNION ALL SELECT s_name, 'uf', CAST(s_nationkey AS VARCHAR) FROM supplier""",
    "edges": _flights("""
SELECT coalesce(nullif(icao_empresa, ''), '(sem empresa)') AS origem, icao_origem AS destino
FROM silver
WHERE icao_origem LIKE 'N1%' AND partida_prevista_data >= DATE '2024-01-30' - 7
GROUP BY 1, 2"""),
    "gold_dedup": _flights("SELECT DISTINCT " + ", ".join(FLIGHT_COLUMNS) + " FROM silver"),
    "gold_out_of_range": _range(
        f"SELECT event_id, fora AS atraso_fora_de_faixa, {_VALID} FROM faixa"),
    "gold_punctual": _range("""
SELECT event_id, CASE WHEN NOT fora THEN atraso_partida_min <= 15 END AS partida_pontual,
  CASE WHEN NOT fora THEN atraso_chegada_min <= 15 END AS chegada_pontual FROM faixa"""),
    "gold_calendar": _flights(f"""
SELECT event_id, CAST(hour(partida_prevista) AS INTEGER) AS hora_partida_prevista,
  ([{_strings(WEEKDAYS)}])[1 + dayofweek(partida_prevista)] AS dia_semana,
  CAST(date_trunc('month', partida_prevista) AS DATE) AS mes_referencia FROM silver"""),
    "gold_country": _flights(f"""
SELECT event_id, {_COUNTRY.format('icao_origem')} AS pais_origem,
  {_COUNTRY.format('icao_destino')} AS pais_destino FROM silver"""),
    "country_prefixes": _flights("""
, prefixos(prefixo, valor) AS (
  VALUES ('N1', 'Brasil'), ('N12', 'Exterior'), ('N2', 'Exterior'), ('N27', 'Brasil'),
         ('N270', 'Exterior'), ('X', 'Exterior')),
paises AS (
  SELECT codigo, arg_max(valor, length(prefixo)) AS pais
  FROM (SELECT icao_origem AS codigo FROM silver UNION SELECT icao_destino FROM silver)
  JOIN prefixos ON starts_with(codigo, prefixo) GROUP BY codigo)
SELECT event_id, icao_origem, o.pais AS pais_origem, icao_destino, d.pais AS pais_destino
FROM silver LEFT JOIN paises o ON o.codigo = icao_origem
LEFT JOIN paises d ON d.codigo = icao_destino"""),
    "code_lookup": _with("""
SELECT event_id, codigo_di, di.descricao AS descricao_di, codigo_tipo_linha,
  tl.descricao AS descricao_tipo_linha
FROM raw LEFT JOIN codigos di ON di.dominio = 'codigo_di' AND di.codigo = codigo_di
LEFT JOIN codigos tl ON tl.dominio = 'codigo_tipo_linha' AND tl.codigo = codigo_tipo_linha""",
                         _RAW, _CODES),
    "gold_fallback": _with(f"""
SELECT event_id,
  coalesce(e.razao_social, concat_ws(' ', '{UNKNOWN_CARRIER}', icao_empresa)) AS nome_companhia,
  e.origem_cadastro AS cadastro_companhia,
  coalesce(di.descricao, '{UNKNOWN_CODE} ' || codigo_di) AS descricao_di,
  coalesce(tl.descricao, '{UNKNOWN_CODE} ' || codigo_tipo_linha) AS descricao_tipo_linha
FROM raw LEFT JOIN empresas e ON e.icao = icao_empresa AND e.icao <> ''
LEFT JOIN codigos di ON di.dominio = 'codigo_di' AND di.codigo = codigo_di
LEFT JOIN codigos tl ON tl.dominio = 'codigo_tipo_linha' AND tl.codigo = codigo_tipo_linha""",
                           _RAW, _CARRIERS, _CODES),
    "gold_fact": _gold("SELECT * FROM fato"),
    "gold_dim": _with("SELECT * FROM dim", _RAW, _SILVER, _AIRPORTS, _DIM),
    "gold_obt": _with(_OBT, _RAW, _SILVER, _AIRPORTS, _CARRIERS, _CODES, _FACT, _DIM),
    "gold_kpis": _gold(f"SELECT {_KPIS} FROM fato"),
    "gold_by_hour": _kpis("hora_partida_prevista"),
    "gold_by_day": _kpis("partida_prevista_data"),
    "gold_by_month": _kpis("mes_referencia"),
    "gold_by_route": _kpis("rota"),
    "gold_by_scope": _kpis("escopo_voo"),
    "gold_by_carrier": _kpis("nome_companhia"),
    "recovered_but_late": _gold(
        "SELECT count(*) AS recuperou_algum_minuto, " + ", ".join([
            _count_if("atraso_chegada_min <= 0", "chegou_adiantado_ou_no_horario"),
            _count_if("atraso_chegada_min > 0", "chegou_atrasado_mesmo_assim"),
            _count_if("atraso_chegada_min > 15", "chegou_atrasado_mais_de_15"),
        ]) + " FROM fato WHERE minutos_recuperados > 0"),
    "punctual_null_by_status": _gold(
        "SELECT situacao_voo, count(*) AS voos, "
        + _count_if("partida_pontual IS NULL", "partida_pontual_null")
        + " FROM fato GROUP BY situacao_voo"),
}

ORACLE["written_counts"] = ORACLE["rule_metrics"]
ORACLE["clustered_edges"] = ORACLE["edges"]
ORACLE["clustered_top_k"] = _flights("""
SELECT event_id, numero_voo, partida_prevista, situacao_voo FROM silver
ORDER BY partida_prevista NULLS FIRST, event_id LIMIT 50""")

_AXES = ("hora_partida_prevista", "partida_prevista_data", "mes_referencia", "rota", "escopo_voo",
         "nome_companhia")
ORACLE["gold_kpis_by_axis"] = _gold("\nUNION ALL\n".join([
    f"SELECT 'total' AS eixo, CAST(NULL AS VARCHAR) AS valor, {_KPIS} FROM fato",
    *[f"SELECT '{a}', CAST({a} AS VARCHAR), {_KPIS} FROM fato GROUP BY {a}" for a in _AXES]]))

_ORDERED = ("layer_counts", "registry_summary", "filter_in", "completeness", "attr_listing", "edges",
            "top_k")
ORACLE["report_order"] = "\nUNION ALL\n".join([
    *[f"SELECT '{name}' AS relatorio, count(*) AS linhas, 0 AS inversoes FROM ({ORACLE[name]})"
      for name in _ORDERED],
    # Twelve files; the flights' columns after typing.
    "SELECT 'rows_per_file', count(DISTINCT event_id % 12), 0 FROM events",
    "SELECT 'schema_diff', 25, 0",
    "SELECT 'flights', count(*), 0 FROM events",
])
