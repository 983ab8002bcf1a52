"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives the flight-shaped view from the TPC-H-like tables and
re-states each operator in plain SQL, label lists included; only the ASCII
column names come from the library.
"""

from __future__ import annotations

# --- FIXED VALUES: labels written out a second time, so that a wrong one shows ---
AIRPORT_SIZES = {
    'large_airport': 'Grande Porte',
    'medium_airport': 'Médio Porte',
    'small_airport': 'Pequeno Porte',
}
LINE_TYPES = {
    'C': 'Transporte Aéreo Público Regular',
    'N': 'Transporte Aéreo Público Não Regular (Charter/Fretamento)',
    'G': 'Aviação Geral',
    'S': 'Serviços Aéreos Especializados',
    'E': 'Experimental',
    'M': 'Militar',
    'T': 'Táxi Aéreo',
    'P': 'Aviação Privada',
}
JUSTIFICATIONS = {
    'AA': 'ATRASO AEROPORTO DE ALTERNATIVA – ORDEM TÉCNICA',
    'AF': 'FACILIDADES DO AEROPORTO - RESTRIÇÕES DE APOIO',
    'AG': 'MIGRAÇÃO/ALFÂNDEGA/SAÚDE',
    'AI': 'AEROPORTO DE ORIGEM INTERDITADO',
    'AJ': 'AEROPORTO DE DESTINO INTERDITADO',
    'AM': 'ATRASO AEROPORTO DE ALTERNATIVA – CONDIÇÕES METEOROLÓGICAS',
    'AS': 'SEGURANÇA/PAX/CARGA/ALARME',
    'AR': 'AEROPORTO COM RESTRIÇÕES OPERACIONAIS',
    'AT': 'LIBERAÇÃO SERV. TRÁFEGO AÉREO/ANTECIPAÇÃO',
    'DF': 'AVARIA DURANTE OPERAÇÕES EM VÔO',
    'DG': 'AVARIA DURANTE OPERAÇÕES EM SOLO',
    'FP': 'PLANO DE VÔO - APROVAÇÃO',
    'GF': 'ABASTECIMENTO/DESTANQUEIO',
    'MA': 'FALHA EQUIPO AUTOMOTIVO E DE ATENDIMENTO DE PAX',
    'MX': 'ATRASOS NÃO ESPECÍFICOS – OUTROS',
    'OA': 'AUTORIZADO',
    'RA': 'CONEXÃO DE AERONAVE',
    'RI': 'CONEXÃO AERONAVE/VOLTA – VÔO DE IDA NÃO PENALIZADO AEROPORTO INTERDITADO',
    'RM': 'CONEXÃO AERONAVE/VOLTA – VÔO DE IDA NÃO PENALIZADO CONDIÇÕES METEOROLÓGICAS',
    'TC': 'TROCA DE AERONAVE',
    'TD': 'DEFEITOS DA AERONAVE',
    'WA': 'ALTERNATIVA ABAIXO DOS LIMITES',
    'WI': 'DEGELO E REMOÇÃO DE NEVE E/OU LAMA EM AERONAVE',
    'WR': 'ATRASO DEVIDO RETORNO – CONDIÇÕES METEOROLÓGICAS',
    'WO': 'AEROPORTO ORIGEM ABAIXO DOS LIMITES',
    'WP': 'ATRASO DEVIDO RETORNO – ORDEM TÉCNICA',
    'WT': 'AEROPORTO DESTINO ABAIXO DOS LIMITES',
    'WS': 'REMOÇÃO GELO/ÁGUA/LAMA/AREIA-EM AEROPORTO',
    'XA': 'PROGRAMADO – FERIADO NACIONAL',
    'XB': 'AUTORIZADO',
    'XI': 'DEVIDO AEROPORTO DE ORIGEM INTERDITADO',
    'XJ': 'DEVIDO AEROPORTO DE DESTINO INTERDITADO',
    'XL': 'FALTA PAX COM PASSAGEM MARCADA – (APENAS PARA AS LINHAS AÉREAS DOMÉSTICAS REGIONAIS)',
    'XM': 'CANCELAMENTO – CONEXÃO AERONAVE/VOLTA – VÔO DE IDA CANCELADO – AEROPORTO INTERDITADO',
    'XN': 'CANCELAMENTO POR MOTIVOS TÉCNICOS – OPERACIONAIS',
    'XO': 'CANCELAMENTO – AEROPORTO ORIGEM ABAIXO LIMITES',
    'XT': 'CANCELAMENTO – AEROPORTO DESTINO ABAIXO LIMITES',
    'XR': 'CANCELAMENTO DE VÔOS OPERADOS EM “CODE SHARING”',
    'XS': 'CANCELAMENTO – CONEXÃO AERONAVE/VOLTA – VÔO DE IDA CANCELADO – CONDIÇÕES METEOROLÓGICAS',
    'ST': 'INCLUSÃO DE ETAPA DEVIDO CANCELAMENTO DE ESCALAS PREVISTAS – (EXCLUSIVO PARA LINHAS SUPLEMENTADAS)',
    'IR': 'INCLUSÃO DE ETAPA (AEROPORTO DE ALTERNATIVA) DEVIDO A UM VÔO ESPECIAL RETORNO',
    'VR': 'VÔO ESPECIAL DE RETORNO (EXCLUSIVO PARA RETORNO AO AEROPORTO DE ORIGEM)',
    'VE': 'ESPECÍFICO PARA VÔO ESPECIAL DE EXPERIÊNCIA',
    'VI': 'ESPECÍFICO PARA VÔO ESPECIAL DE INSTRUÇÃO',
    'HA': 'AUTORIZADA',
    'HB': 'OPERAÇÃO DE VÔO COM MAIS DE 04 HORAS DE ATRASO PANE AERONAVE',
    'HC': 'OPERAÇÃO DE VÔO COM MAIS DE 04 HORAS DE ATRASO AEROPORTO INTERDITADO',
    'HD': 'ANTECIPAÇÃO DE HORÁRIO AUTORIZADA',
    'HI': 'ANTECIPAÇÃO DE HORÁRIO AUTORIZADA – ESPECÍFICO VÔOS INTERNACIONAIS',
}
CODE_NOT_FOUND = 'Código não encontrado'
WEEKDAY_LABELS = ('Seg', 'Ter', 'Qua', 'Qui', 'Sex', 'Sáb', 'Dom')

ZONE = "America/Sao_Paulo"
FMT = "%Y-%m-%d %H:%M:%S"


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def decode_sql(expr: str, mapping: dict[str, str], default: str | None) -> str:
    whens = " ".join(f"WHEN {s(k)} THEN {s(v)}" for k, v in mapping.items())
    hit = f"CASE {expr} {whens} END"
    val = hit if default is None else f"COALESCE({hit}, {s(default)})"
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE {val} END"


def instant(expr: str) -> str:
    # Wall clock in ZONE → instant; an ambiguous (DST overlap) time takes the earlier instant.
    return (f"least(timezone('{ZONE}', {expr}), "
            f"timezone('{ZONE}', {expr} - INTERVAL 1 HOUR) + INTERVAL 1 HOUR)")


def parse_ts(expr: str) -> str:
    return (f"CASE WHEN regexp_full_match({expr}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') "
            f"THEN TRY_CAST({expr} AS TIMESTAMP) END")


RAW = f"""
fl0 AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         l.l_returnflag, l.l_linestatus, o.o_orderstatus, c.c_nationkey, c.c_mktsegment,
         s.s_nationkey, p.p_type,
         o.o_orderdate + to_hours(CAST(l.l_partkey % 24 AS BIGINT)) AS dep
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
fl1 AS (
  SELECT *, dep + to_minutes(CAST(floor(l_quantity * 3 - 30) AS BIGINT)) AS rdep FROM fl0
),
raw_flights AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS "ICAO Empresa Aérea",
         lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-' || CAST(l_orderkey AS VARCHAR) AS "Número Voo",
         l_linestatus AS "Código Autorização (DI)",
         substr(p_type, 1, 1) AS "Código Tipo Linha",
         CAST(s_nationkey AS VARCHAR) AS "ICAO Aeródromo Origem",
         CAST(c_nationkey AS VARCHAR) AS "ICAO Aeródromo Destino",
         strftime(dep, '{FMT}') AS "Partida Prevista",
         CASE WHEN l_linenumber <> 7 THEN strftime(rdep, '{FMT}') END AS "Partida Real",
         strftime(dep + INTERVAL 2 HOUR, '{FMT}') AS "Chegada Prevista",
         strftime(rdep + INTERVAL 2 HOUR, '{FMT}') AS "Chegada Real",
         CASE WHEN l_returnflag = 'R' THEN 'CANCELADO' ELSE 'REALIZADO' END AS "Situação Voo",
         CASE WHEN o_orderstatus <> 'O' THEN upper(substr(c_mktsegment, 1, 2)) END AS "Código Justificativa"
  FROM fl1
),
airports AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS icao_code, n_name AS name,
         CASE WHEN n_nationkey < 15 THEN 'SA' ELSE 'NA' END AS continent,
         CASE WHEN n_nationkey < 15 THEN 'BR' ELSE 'US' END AS iso_country,
         r_name AS municipality,
         'SB' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS gps_code,
         CASE WHEN n_nationkey % 7 = 6 THEN NULL
              WHEN n_nationkey % 2 = 0 THEN CAST(-36 - n_nationkey AS VARCHAR) || ', ' || CAST(2 - n_nationkey AS VARCHAR)
              ELSE CAST(2 - n_nationkey AS VARCHAR) || ',' || CAST(-36 - n_nationkey AS VARCHAR) END AS coordinates,
         CASE n_nationkey % 5 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport'
              WHEN 2 THEN 'small_airport' WHEN 3 THEN 'seaplane_base' ELSE 'heliport' END AS type
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
airlines AS (
  SELECT s_name AS nome, CAST(s_suppkey AS VARCHAR) AS sigla FROM supplier WHERE s_acctbal > 500
),
enriched AS (
  SELECT f.*,
         ao.name AS "Aeródromo Origem", ao.continent AS "Origem Continente",
         ao.iso_country AS "Origem País ISO", ao.municipality AS "Origem Município",
         ao.gps_code AS "Origem GPS", ao.coordinates AS "Origem Coordenadas",
         {decode_sql('ao.type', AIRPORT_SIZES, '')} AS "Tamanho Origem",
         ad.name AS "Aeródromo Destino", ad.continent AS "Destino Continente",
         ad.iso_country AS "Destino País ISO", ad.municipality AS "Destino Município",
         ad.gps_code AS "Destino GPS", ad.coordinates AS "Destino Coordenadas",
         {decode_sql('ad.type', AIRPORT_SIZES, '')} AS "Tamanho Destino"
  FROM raw_flights f
  LEFT JOIN airports ao ON f."ICAO Aeródromo Origem" = ao.icao_code
  LEFT JOIN airports ad ON f."ICAO Aeródromo Destino" = ad.icao_code
  WHERE ao.type IS NOT NULL AND ao.type <> 'heliport'
    AND ad.type IS NOT NULL AND ad.type <> 'heliport'
),
mapped AS (
  SELECT e.*,
         {decode_sql('e."Código Justificativa"', JUSTIFICATIONS, CODE_NOT_FOUND)} AS "Justificativa",
         {decode_sql('e."Código Tipo Linha"', LINE_TYPES, CODE_NOT_FOUND)} AS "Tipo Linha",
         al.nome AS "Empresa Aérea"
  FROM enriched e LEFT JOIN airlines al ON e."ICAO Empresa Aérea" = al.sigla
),
clean_text AS (
  SELECT "ICAO Empresa Aérea", "Número Voo", "ICAO Aeródromo Origem", "ICAO Aeródromo Destino",
         "Partida Prevista", "Partida Real", "Chegada Prevista", "Chegada Real",
         "Situação Voo", "Código Justificativa",
         "Aeródromo Origem", "Origem Município", "Origem GPS", "Origem Coordenadas", "Tamanho Origem",
         "Aeródromo Destino", "Destino Município", "Destino GPS", "Destino Coordenadas", "Tamanho Destino",
         "Justificativa", "Tipo Linha", "Empresa Aérea",
         CASE WHEN "Partida Real" > "Partida Prevista" OR "Chegada Real" > "Chegada Prevista"
              THEN 'Atrasado' ELSE 'Ok' END AS "Status do Voo"
  FROM mapped
  WHERE "Situação Voo" = 'REALIZADO'
    AND "Partida Prevista" IS NOT NULL AND "Partida Real" IS NOT NULL
    AND "Chegada Prevista" IS NOT NULL AND "Chegada Real" IS NOT NULL
    AND "Origem País ISO" = 'BR' AND "Destino País ISO" = 'BR'
),
clean AS (
  SELECT * REPLACE ({parse_ts('"Partida Prevista"')} AS "Partida Prevista",
                    {parse_ts('"Partida Real"')} AS "Partida Real",
                    {parse_ts('"Chegada Prevista"')} AS "Chegada Prevista",
                    {parse_ts('"Chegada Real"')} AS "Chegada Real")
  FROM clean_text
)"""


def base_cte(src: str = "clean", name: str = "base", limit: int = 15) -> str:
    return f"""
{name}0 AS (
  SELECT *,
    CAST(trunc((epoch({instant('"Partida Real"')}) - epoch({instant('"Partida Prevista"')})) / 60) AS BIGINT) AS atraso_min,
    CAST(year("Partida Prevista") AS INTEGER) AS ano,
    CAST(isodow("Partida Prevista") AS INTEGER) AS dia_sem,
    CAST(hour("Partida Prevista") AS INTEGER) AS hora
  FROM {src}
),
{name} AS (SELECT * FROM {name}0 WHERE atraso_min IS NOT NULL AND atraso_min > {limit})"""


from aerolake.columns import ASCII_NAMES  # noqa: E402


def ascii_select(cols: list[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{q(c)} AS {ASCII_NAMES.get(c, c)}" for c in cols)


RAW_COLS = ["ICAO Empresa Aérea", "Número Voo", "Código Autorização (DI)", "Código Tipo Linha",
            "ICAO Aeródromo Origem", "ICAO Aeródromo Destino", "Partida Prevista", "Partida Real",
            "Chegada Prevista", "Chegada Real", "Situação Voo", "Código Justificativa"]
ENDPOINT_COLS = ["Aeródromo Origem", "Origem Continente", "Origem País ISO", "Origem Município",
                 "Origem GPS", "Origem Coordenadas", "Tamanho Origem",
                 "Aeródromo Destino", "Destino Continente", "Destino País ISO", "Destino Município",
                 "Destino GPS", "Destino Coordenadas", "Tamanho Destino"]
CLEAN_COLS = ["ICAO Empresa Aérea", "Número Voo", "ICAO Aeródromo Origem", "ICAO Aeródromo Destino",
              "Partida Prevista", "Partida Real", "Chegada Prevista", "Chegada Real",
              "Situação Voo", "Código Justificativa",
              "Aeródromo Origem", "Origem Município", "Origem GPS", "Origem Coordenadas", "Tamanho Origem",
              "Aeródromo Destino", "Destino Município", "Destino GPS", "Destino Coordenadas", "Tamanho Destino",
              "Justificativa", "Tipo Linha", "Empresa Aérea", "Status do Voo"]


def w(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


# Filter used by the filter_* queries (same values as __spark_entry__.FILTER_SPEC).
FILTER_WHERE = (
    "\"Status do Voo\" IN ('Atrasado') "
    f"AND \"Tipo Linha\" IN ({s(LINE_TYPES['P'])}, {s(LINE_TYPES['E'])}) "
    "AND \"ICAO Aeródromo Origem\" IN ('0', '1', '2', '3', '5', '6') "
)


def _weekday_case(expr: str) -> str:
    whens = " ".join(f"WHEN {i + 1} THEN {s(lbl)}" for i, lbl in enumerate(WEEKDAY_LABELS))
    return f"CASE {expr} {whens} END"


def _period_case(h: str) -> str:
    return (f"CASE WHEN {h} >= 0 AND {h} < 6 THEN 'Madrugada' WHEN {h} >= 6 AND {h} < 12 THEN 'Manhã' "
            f"WHEN {h} >= 12 AND {h} < 18 THEN 'Tarde' ELSE 'Noite' END")


def _dist_null(expr: str) -> str:
    return (f"CAST(count(DISTINCT {expr}) + coalesce(max(CASE WHEN {expr} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)")


def _num(expr: str) -> str:
    return f"CASE WHEN regexp_full_match({expr}, '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST({expr} AS DOUBLE) END"


def _coords(text: str) -> tuple[str, str]:
    clean_txt = f"regexp_replace({text}, '\\s+', '', 'g')"
    a = _num(f"split_part({clean_txt}, ',', 1)")
    b = _num(f"CASE WHEN strpos({clean_txt}, ',') > 0 THEN split_part({clean_txt}, ',', 2) END")
    return a, b


def _box(lon: str, lat: str) -> str:
    return (f"({lon} IS NOT NULL AND {lat} IS NOT NULL AND {lon} BETWEEN -75.0 AND -28.0 "
            f"AND {lat} BETWEEN -34.0 AND 6.0)")


def _orient(a: str, b: str, fmt: str) -> tuple[str, str]:
    if fmt == "lon,lat":
        return a, b
    if fmt == "lat,lon":
        return b, a
    keep = f"({a} BETWEEN -75.0 AND -28.0 AND {b} BETWEEN -34.0 AND 6.0)"
    return (f"CASE WHEN {keep} THEN {a} ELSE {b} END", f"CASE WHEN {keep} THEN {b} ELSE {a} END")


def _routes_cte(src: str = "base", top: int | None = 1000) -> str:
    oa, ob = _coords('"Origem Coordenadas"')
    da, db = _coords('"Destino Coordenadas"')
    olon, olat = _orient("oa", "ob", "auto")
    dlon, dlat = _orient("da", "db", "auto")
    return f"""
rt0 AS (
  SELECT {oa} AS oa, {ob} AS ob, {da} AS da, {db} AS db, atraso_min FROM {src}
),
rt1 AS (
  SELECT {olon} AS origem_lon, {olat} AS origem_lat, {dlon} AS destino_lon, {dlat} AS destino_lat, atraso_min
  FROM rt0
),
routes AS (
  SELECT origem_lon, origem_lat, destino_lon, destino_lat,
         CAST(count(*) AS BIGINT) AS quantidade,
         CAST(sum(atraso_min) AS DOUBLE) / count(atraso_min) AS atraso_medio
  FROM rt1
  WHERE {_box('origem_lon', 'origem_lat')} AND {_box('destino_lon', 'destino_lat')}
  GROUP BY 1, 2, 3, 4
  {"" if top is None else f"ORDER BY quantidade DESC, origem_lon, origem_lat, destino_lon, destino_lat LIMIT {top}"}
)"""


def _routes_count_cte(src: str = "clean", top: int = 1000) -> str:
    oa, ob = _coords('"Origem Coordenadas"')
    da, db = _coords('"Destino Coordenadas"')
    olon, olat = _orient("oa", "ob", "auto")
    dlon, dlat = _orient("da", "db", "auto")
    return f"""
rc0 AS (SELECT {oa} AS oa, {ob} AS ob, {da} AS da, {db} AS db FROM {src}),
rc1 AS (SELECT {olon} AS origem_lon, {olat} AS origem_lat, {dlon} AS destino_lon, {dlat} AS destino_lat FROM rc0),
routes_count AS (
  SELECT origem_lon, origem_lat, destino_lon, destino_lat, CAST(count(*) AS BIGINT) AS quantidade
  FROM rc1
  WHERE {_box('origem_lon', 'origem_lat')} AND {_box('destino_lon', 'destino_lat')}
  GROUP BY 1, 2, 3, 4
  ORDER BY quantidade DESC, origem_lon, origem_lat, destino_lon, destino_lat
  LIMIT {top}
)"""


def _invalid_local(expr: str) -> str:
    """Wall clock that does not exist (round trip moves it) or is ambiguous
    (an hour earlier maps to an earlier instant) in ZONE."""
    inst = f"timezone('{ZONE}', {expr})"
    return (f"({expr} IS NOT NULL AND (timezone('{ZONE}', {inst}) <> {expr} "
            f"OR timezone('{ZONE}', {expr} - INTERVAL 1 HOUR) + INTERVAL 1 HOUR < {inst}))")


def _yoy_cte(src: str = "base", name: str = "variation") -> str:
    return f"""
{name}_py AS (
  SELECT ano, "Aeródromo Origem" AS aeroporto, count(*) AS qtd FROM {src} GROUP BY 1, 2
),
{name}_years AS (
  SELECT ano, CASE WHEN ano = max(ano) OVER () THEN 'curr' ELSE 'prev' END AS slot,
         count(*) OVER () AS n, min(ano) OVER () AS yp, max(ano) OVER () AS yc
  FROM (SELECT DISTINCT ano FROM {name}_py WHERE ano IS NOT NULL ORDER BY ano DESC LIMIT 2)
),
{name} AS (
  SELECT aeroporto,
         CAST(sum(CASE WHEN slot = 'prev' THEN qtd ELSE 0 END) AS BIGINT) AS y_prev,
         CAST(sum(CASE WHEN slot = 'curr' THEN qtd ELSE 0 END) AS BIGINT) AS y_curr,
         max(yp) AS ano_prev,
         max(yc) AS ano_curr,
         CAST(sum(CASE WHEN slot = 'curr' THEN qtd ELSE 0 END) AS BIGINT)
           - CAST(sum(CASE WHEN slot = 'prev' THEN qtd ELSE 0 END) AS BIGINT) AS delta
  FROM {name}_py JOIN {name}_years USING (ano)
  WHERE n = 2
  GROUP BY aeroporto
)"""


def _bad_text(col: str) -> str:
    """Same text mutations as __spark_entry__._with_bad_times."""
    c = q(col)
    return (f"CASE WHEN \"Código Tipo Linha\" = 'L' THEN substr({c}, 9, 2) || '/' || substr({c}, 6, 2) || '/' "
            f"|| substr({c}, 1, 4) || ' ' || substr({c}, 12, 5) "
            f"WHEN \"Código Tipo Linha\" = 'E' AND \"Código Autorização (DI)\" = 'F' THEN {c} || '.5' "
            f"WHEN \"Código Tipo Linha\" = 'S' AND \"Código Autorização (DI)\" = 'O' THEN substr({c}, 1, 10) "
            f"ELSE {c} END")


def oracle_sql() -> dict[str, str]:
    base = base_cte()
    d: dict[str, str] = {}

    d["airport_enrich"] = w(RAW) + f"SELECT {ascii_select(RAW_COLS + ENDPOINT_COLS)} FROM enriched"
    d["airline_enrich"] = w(RAW) + (
        f"SELECT {ascii_select(RAW_COLS, 'f.')}, al.nome AS empresa "
        "FROM raw_flights f LEFT JOIN airlines al ON f.\"ICAO Empresa Aérea\" = al.sigla")
    d["first_by_key"] = (
        "SELECT c_mktsegment, c_custkey, c_name, c_nationkey, c_acctbal FROM ("
        "SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rn FROM customer"
        ") WHERE rn = 1")
    d["decode_codes"] = w(RAW) + (
        "SELECT \"Número Voo\" AS numero_voo, \"Código Justificativa\" AS codigo_justificativa, "
        f"{decode_sql(q('Código Justificativa'), JUSTIFICATIONS, CODE_NOT_FOUND)} AS justificativa, "
        "\"Código Tipo Linha\" AS codigo_tipo_linha, "
        f"{decode_sql(q('Código Tipo Linha'), LINE_TYPES, CODE_NOT_FOUND)} AS tipo_linha "
        "FROM raw_flights")
    d["completed_flights"] = w(RAW) + (
        f"SELECT {ascii_select(RAW_COLS)} FROM raw_flights WHERE \"Situação Voo\" = 'REALIZADO' "
        "AND \"Partida Prevista\" IS NOT NULL AND \"Partida Real\" IS NOT NULL "
        "AND \"Chegada Prevista\" IS NOT NULL AND \"Chegada Real\" IS NOT NULL")
    d["domestic_only"] = w(RAW) + (
        "SELECT \"Número Voo\" AS numero_voo, \"ICAO Aeródromo Origem\" AS icao_origem, "
        "\"ICAO Aeródromo Destino\" AS icao_destino, \"Origem País ISO\" AS pais_origem, "
        "\"Destino País ISO\" AS pais_destino FROM enriched "
        "WHERE \"Origem País ISO\" = 'BR' AND \"Destino País ISO\" = 'BR'")
    d["late_flag"] = w(RAW) + (
        "SELECT \"Número Voo\" AS numero_voo, \"Partida Prevista\" AS partida_prevista, "
        "\"Partida Real\" AS partida_real, \"Chegada Prevista\" AS chegada_prevista, "
        "\"Chegada Real\" AS chegada_real, "
        "CASE WHEN \"Partida Real\" > \"Partida Prevista\" OR \"Chegada Real\" > \"Chegada Prevista\" "
        "THEN 'Atrasado' ELSE 'Ok' END AS status_voo FROM raw_flights")
    times = ["Partida Prevista", "Partida Real", "Chegada Prevista", "Chegada Real"]
    bad = ", ".join(f"{_bad_text(c)} AS {q(c)}" for c in times)
    d["localise_times"] = w(RAW, f"bad AS (SELECT \"Número Voo\", {bad} FROM raw_flights)") + (
        "SELECT \"Número Voo\" AS numero_voo, "
        + ", ".join(f"{parse_ts(q(c))} AS {ASCII_NAMES[c]}" for c in times) + " FROM bad")
    d["clean_flights"] = w(RAW) + f"SELECT {ascii_select(CLEAN_COLS)} FROM clean"
    d["union_relaxed"] = (
        "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, "
        "c_mktsegment AS segment, c_mktsegment AS code FROM customer "
        "UNION ALL "
        "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance, "
        "NULL AS segment, CAST(s_nationkey AS VARCHAR) AS code FROM supplier")
    d["filter_flights"] = w(RAW) + (
        f"SELECT {ascii_select(CLEAN_COLS)} FROM clean WHERE {FILTER_WHERE} "
        "AND CAST(\"Partida Prevista\" AS DATE) >= DATE '1996-03-01' "
        "AND CAST(\"Partida Prevista\" AS DATE) <= DATE '1997-06-30'")
    d["filter_flights_text"] = w(RAW) + (
        f"SELECT {ascii_select(CLEAN_COLS)} FROM clean_text WHERE {FILTER_WHERE} "
        "AND substr(\"Partida Prevista\", 1, 10) >= '1996-03-01' "
        "AND substr(\"Partida Prevista\", 1, 10) <= '1997-06-30'")
    d["flights_per_day"] = w(RAW) + (
        "SELECT CAST(\"Partida Prevista\" AS DATE) AS dia, count(*) AS voos FROM clean GROUP BY 1")
    d["flights_per_day_text"] = w(RAW) + (
        "SELECT substr(\"Partida Prevista\", 1, 10) AS dia_str, count(*) AS voos FROM clean_text GROUP BY 1")
    d["events_per_day"] = "SELECT CAST(ts AS DATE) AS dia, count(*) AS voos FROM events GROUP BY 1"
    d["status_distribution"] = w(RAW) + (
        "SELECT \"Status do Voo\" AS status, count(*) AS quantidade FROM clean GROUP BY 1")
    d["top_routes"] = w(RAW) + (
        "SELECT origem, destino, quantidade, origem || ' ➔ ' || destino AS rota FROM ("
        "SELECT \"ICAO Aeródromo Origem\" AS origem, \"ICAO Aeródromo Destino\" AS destino, "
        "count(*) AS quantidade FROM clean GROUP BY 1, 2 "
        "ORDER BY quantidade DESC, origem, destino LIMIT 20)")
    d["kpis"] = w(RAW) + (
        "SELECT count(*) AS voos, "
        f"{_dist_null(q('Empresa Aérea'))} AS empresas, "
        f"{_dist_null(chr(40) + q('ICAO Aeródromo Origem') + ' || ' + s('-') + ' || ' + q('ICAO Aeródromo Destino') + chr(41))} AS rotas "
        "FROM clean")
    d["unique_values"] = w(RAW) + (
        "SELECT DISTINCT \"Empresa Aérea\" AS valor FROM clean WHERE \"Empresa Aérea\" IS NOT NULL "
        "ORDER BY valor LIMIT 20000")
    opts = " UNION ALL ".join(
        f"SELECT DISTINCT {s(c)} AS coluna, CAST({q(c)} AS VARCHAR) AS valor FROM clean WHERE {q(c)} IS NOT NULL"
        for c in ("Empresa Aérea", "Situação Voo", "Status do Voo", "Tipo Linha",
                  "Aeródromo Origem", "Aeródromo Destino"))
    d["filter_options"] = w(RAW) + (
        "SELECT coluna, valor FROM (SELECT coluna, valor, row_number() OVER "
        f"(PARTITION BY coluna ORDER BY valor) AS rn FROM ({opts})) WHERE rn <= 20000")
    d["date_bounds"] = w(RAW) + (
        "SELECT min(\"Partida Prevista\") AS inicio, max(\"Partida Prevista\") AS fim FROM clean")
    d["sample_rows"] = w(RAW) + (
        f"SELECT {ascii_select(CLEAN_COLS)} FROM clean "
        "ORDER BY \"Partida Prevista\", \"Número Voo\" LIMIT 1000")
    d["delay_base"] = w(RAW, base) + (
        f"SELECT {ascii_select(CLEAN_COLS)}, atraso_min, ano, dia_sem, hora FROM base")
    d["delay_by_airport"] = w(RAW, base) + (
        "SELECT \"Aeródromo Origem\" AS aeroporto, count(*) AS quantidade_atrasos FROM base "
        "GROUP BY 1 ORDER BY quantidade_atrasos DESC, aeroporto LIMIT 25")
    d["delay_by_year"] = w(RAW, base) + (
        "SELECT ano, count(*) AS quantidade_atrasos FROM base GROUP BY 1")
    d["delay_by_weekday"] = w(RAW, base) + (
        f"SELECT ano, dia_sem, {_weekday_case('dia_sem')} AS dia, count(*) AS quantidade_atrasos "
        "FROM base GROUP BY 1, 2")
    d["delay_by_period"] = w(RAW, base) + (
        f"SELECT ano, {_period_case('hora')} AS periodo, count(*) AS quantidade_atrasos "
        "FROM base GROUP BY 1, 2")
    d["events_by_period"] = (
        f"SELECT CAST(year(ts) AS INTEGER) AS ano, {_period_case('hour(ts)')} AS periodo, "
        "count(*) AS quantidade_atrasos FROM events GROUP BY 1, 2")
    d["delay_by_airline"] = w(RAW, base) + (
        "SELECT ano, \"Empresa Aérea\" AS empresa, count(*) AS quantidade_atrasos FROM base GROUP BY 1, 2")
    d["top_airlines_per_year"] = w(RAW, base) + (
        "SELECT ano, empresa, quantidade_atrasos FROM ("
        "SELECT ano, \"Empresa Aérea\" AS empresa, count(*) AS quantidade_atrasos, "
        "dense_rank() OVER (PARTITION BY ano ORDER BY count(*) DESC) AS rk "
        "FROM base GROUP BY 1, 2) WHERE rk <= 15")
    d["yoy_variation"] = w(RAW, base, _yoy_cte()) + "SELECT * FROM variation"
    d["yoy_increases"] = w(RAW, base, _yoy_cte()) + (
        "SELECT * FROM variation ORDER BY delta DESC, aeroporto LIMIT 10")
    d["yoy_decreases"] = w(RAW, base, _yoy_cte()) + (
        "SELECT * FROM variation ORDER BY delta ASC, aeroporto LIMIT 10")
    dated = ("dated AS (SELECT * FROM clean WHERE CAST(\"Partida Prevista\" AS DATE) >= DATE '2000-01-01' "
             "AND CAST(\"Partida Prevista\" AS DATE) <= DATE '2000-12-31')")
    d["yoy_fallback"] = w(RAW, base, dated, base_cte("dated", "base_dated"),
                          _yoy_cte("base_dated", "var_dated"), _yoy_cte("base", "var_all"),
                          "ny AS (SELECT count(DISTINCT ano) AS n FROM base_dated)") + (
        "SELECT v.*, false AS usou_fallback FROM var_dated v, ny WHERE ny.n >= 2 "
        "UNION ALL SELECT v.*, true AS usou_fallback FROM var_all v, ny WHERE ny.n < 2")
    oa, ob = _coords('"Origem Coordenadas"')
    cols_sql = []
    for fmt, tag in (("auto", "auto"), ("lat,lon", "latlon"), ("lon,lat", "lonlat")):
        lon, lat = _orient("oa", "ob", fmt)
        cols_sql.append(f"{lon} AS lon_{tag}, {lat} AS lat_{tag}")
    lon_a, lat_a = _orient("oa", "ob", "auto")
    d["coord_orient"] = w(RAW, f"co AS (SELECT \"Número Voo\" AS numero_voo, \"Origem Coordenadas\" AS coordenadas_origem, {oa} AS oa, {ob} AS ob FROM clean)") + (
        f"SELECT numero_voo, coordenadas_origem, {', '.join(cols_sql)}, "
        f"{_box(lon_a, lat_a)} AS valido FROM co")
    parsed = ", ".join(f"{parse_ts(q(c))} AS {ASCII_NAMES[c]}" for c in times)
    d["invalid_local_times"] = w(RAW, f"lt AS (SELECT \"Número Voo\" AS numero_voo, {parsed} FROM raw_flights)") + (
        "SELECT * FROM lt WHERE " + " OR ".join(_invalid_local(ASCII_NAMES[c]) for c in times))
    d["route_map_input"] = w(RAW, base_cte(limit=180, name="base180"), _routes_count_cte()) + (
        "SELECT * FROM routes_count WHERE (SELECT count(*) FROM base180) = 0")
    d["route_map"] = w(RAW, base, _routes_cte()) + "SELECT * FROM routes"
    d["route_nodes"] = w(RAW, base, _routes_cte()) + (
        "SELECT lon, lat, CAST(sum(quantidade) AS BIGINT) AS quantidade FROM ("
        "SELECT origem_lon AS lon, origem_lat AS lat, quantidade FROM routes "
        "UNION ALL SELECT destino_lon, destino_lat, quantidade FROM routes) GROUP BY 1, 2")
    d["route_intensity"] = w(RAW, base, _routes_cte(),
                             "qs AS (SELECT quantile_cont(atraso_medio, 0.05) AS lo, "
                             "quantile_cont(atraso_medio, 0.95) AS hi FROM routes)") + (
        "SELECT origem_lon, origem_lat, destino_lon, destino_lat, quantidade, atraso_medio, "
        "round(least(greatest((atraso_medio - lo) / greatest(hi - lo, 1e-6), 0.0), 1.0), 6) AS intensidade "
        "FROM routes, qs")
    d["unique_values_all"] = w(RAW) + (
        "SELECT DISTINCT \"Empresa Aérea\" AS valor FROM clean WHERE \"Empresa Aérea\" IS NOT NULL")
    three = ("dated AS (SELECT * FROM clean WHERE CAST(\"Partida Prevista\" AS DATE) "
             "BETWEEN DATE '1994-07-01' AND DATE '1996-03-31')")
    d["yoy_no_fallback"] = w(RAW, three, base_cte("dated", "base_dated"), _yoy_cte("base_dated", "var_dated")) + (
        "SELECT *, false AS usou_fallback FROM var_dated")
    unread = " UNION ALL ".join(
        f"SELECT {s(c)} AS coluna, count({q(c)}) AS presentes, "
        f"count(*) FILTER (WHERE {q(c)} IS NOT NULL AND {parse_ts(q(c))} IS NULL) AS ilegiveis FROM bad" for c in times)
    d["unparsable_times"] = w(RAW, f"bad AS (SELECT {bad} FROM raw_flights)") + unread
    lacking = [c for c in CLEAN_COLS if c not in RAW_COLS or c == "Partida Real"]
    d["missing_columns"] = w(RAW, "n AS (SELECT count(*) AS voos FROM raw_flights)") + " UNION ALL ".join(
        f"SELECT {s(c)} AS coluna, voos, CAST(0 AS BIGINT) AS atrasos FROM n" for c in lacking)
    d["status_by_situation"] = w(RAW) + (
        "SELECT \"Situação Voo\" AS status, count(*) AS quantidade FROM raw_flights GROUP BY 1")
    d["route_map_base"] = d["route_map"]
    d["route_map_all"] = w(RAW, base, _routes_cte(top=None)) + "SELECT * FROM routes"
    awkward = ("awkward AS (SELECT * REPLACE (CASE \"Código Tipo Linha\" "
               "WHEN 'L' THEN 'x \"y\"; ' || \"ICAO Empresa Aérea\" "
               "WHEN 'E' THEN \"ICAO Empresa Aérea\" || chr(10) || 'linha 2 é, ç' "
               "WHEN 'S' THEN '\"' || \"ICAO Empresa Aérea\" ELSE \"ICAO Empresa Aérea\" END AS \"ICAO Empresa Aérea\") FROM {src})")
    reason = "CASE WHEN \"Situação Voo\" = 'REALIZADO' THEN \"Código Justificativa\" END"
    d["csv_roundtrip"] = w(RAW, awkward.format(src="raw_flights")) + (
        f"SELECT {ascii_select([c for c in RAW_COLS if c != 'Código Justificativa'])}, {reason} AS codigo_justificativa FROM awkward")
    lines = "lined AS (SELECT *, substr(\"Tipo Linha\", 1, 1) AS \"Código Tipo Linha\" FROM clean_text)"
    # Spark's writers give empty text for the empty size label, read back as null.
    blank = {c: f"nullif({q(c)}, '') AS {ASCII_NAMES[c]}" for c in ("Tamanho Origem", "Tamanho Destino")}
    d["csv_export"] = w(RAW, lines, awkward.format(src="lined")) + "SELECT " + ", ".join(
        blank.get(c, f"{q(c)} AS {ASCII_NAMES[c]}") for c in CLEAN_COLS) + " FROM awkward"
    d["ndjson_roundtrip"] = w(RAW, awkward.format(src="raw_flights")) + f"SELECT {ascii_select(RAW_COLS)} FROM awkward"
    d["lookup_records"] = w(RAW) + (
        "SELECT CAST(s_suppkey AS VARCHAR) AS icao_code, name, continent, iso_country, municipality, gps_code, coordinates, type "
        "FROM supplier JOIN airports ON CAST(s_nationkey AS VARCHAR) = icao_code")
    d["code_map"] = (
        "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS codigo, "
        f"CASE WHEN c_nationkey IS NULL THEN NULL ELSE coalesce(n_name, {s(CODE_NOT_FOUND)}) END AS rotulo "
        "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 3 <> 0")
    d["first_by_key_source_order"] = (
        "SELECT c_mktsegment, arg_min(c_custkey, (CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END, c_custkey)) AS c_custkey "
        "FROM customer GROUP BY 1")
    d["batch_publish"] = w(RAW) + f"SELECT {ascii_select(CLEAN_COLS)}, CAST(year(\"Partida Prevista\") AS INTEGER) AS ano_partida FROM clean"
    d["union_relaxed_numeric"] = (
        "SELECT c_custkey AS a, CAST(c_custkey AS DOUBLE) AS b, CAST(c_acctbal AS DECIMAL(12, 2)) AS c, "
        "CAST(c_nationkey AS DOUBLE) AS e FROM customer UNION ALL "
        "SELECT s_suppkey, CAST(CAST(s_acctbal AS FLOAT) AS DOUBLE), s_nationkey, s_acctbal FROM supplier")
    d["report"] = _report_sql()
    d["report_reuse"] = _report_sql(more=", true AS reutilizado")
    d["report_incremental"] = _report_sql(leave_out=("sample",))
    d["airline_enrich_hot"] = w(RAW, "hot AS (SELECT * REPLACE (CASE WHEN CAST(substr(\"Número Voo\", 4) AS BIGINT) % 3 = 0 THEN '1' "
                                     "ELSE \"ICAO Empresa Aérea\" END AS \"ICAO Empresa Aérea\") FROM raw_flights)") + (
        f"SELECT {ascii_select(RAW_COLS, 'f.')}, al.nome AS empresa "
        "FROM hot f LEFT JOIN airlines al ON f.\"ICAO Empresa Aérea\" = al.sigla")
    d["route_intensity_all"] = w(RAW, base, _routes_cte(top=None), _SCALE) + _INTENSITY
    d["delay_quantiles"] = w(RAW, base, "m AS (SELECT 'atraso_min' AS medida, CAST(atraso_min AS DOUBLE) AS x FROM base "
                                        "UNION ALL SELECT 'por_hora', CAST(atraso_min AS DOUBLE) / (hora + 1) FROM base)") + " UNION ALL ".join(
        f"SELECT medida, CAST({p} AS DOUBLE) AS parte, round(quantile_cont(x, {p}), 6) AS valor FROM m GROUP BY medida"
        for p in (0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0))
    d["sample_source_order"] = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 40"
    d["clean_clustered"] = w(RAW) + (
        f"SELECT {ascii_select(CLEAN_COLS)} FROM clean WHERE \"ICAO Aeródromo Origem\" IN ('3', '7') "
        f"AND \"Tipo Linha\" IN ({s(LINE_TYPES['P'])}, {s(LINE_TYPES['E'])}) AND CAST(\"Partida Prevista\" AS DATE) >= DATE '1996-03-01'")
    d["parquet_export"] = d["filter_flights"]
    d["parquet_drift"] = (
        "SELECT o_orderkey AS chave, CASE WHEN year(o_orderdate) < 1994 THEN CAST(trunc(o_totalprice) AS DOUBLE) ELSE o_totalprice END AS total, "
        "CASE WHEN year(o_orderdate) >= 1997 THEN o_orderstatus WHEN year(o_orderdate) >= 1994 THEN CAST(o_orderkey % 3 AS VARCHAR) END AS situacao, "
        "CASE WHEN year(o_orderdate) >= 1997 THEN o_orderpriority END AS prioridade FROM orders")
    d["parquet_bytes"] = "SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2"
    return d


_SCALE = ("qs AS (SELECT quantile_cont(atraso_medio, 0.05) AS lo, quantile_cont(atraso_medio, 0.95) AS hi FROM routes)")
_INTENSITY = ("SELECT origem_lon, origem_lat, destino_lon, destino_lat, quantidade, atraso_medio, "
              "round(least(greatest((atraso_medio - lo) / greatest(hi - lo, 1e-6), 0.0), 1.0), 6) AS intensidade FROM routes, qs")


def _report_sql(leave_out: tuple = (), more: str = "") -> str:
    """The report's outputs for completed flights of 1995-06-01 to 1995-12-31; the
    year-over-year change falls back to all days, as there is one year only."""
    base = base_cte("filtered", "base")
    undated = base_cte("clean", "base_all")
    kept = ("filtered AS (SELECT * FROM clean WHERE \"Situação Voo\" = 'REALIZADO' AND "
            "CAST(\"Partida Prevista\" AS DATE) BETWEEN DATE '1995-06-01' AND DATE '1995-12-31')")

    def part(name: str, keys: list[str], values: list[str], source: str) -> tuple[str, str]:
        text = lambda cols: "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols) + ")"
        return name, f"SELECT {s(name)} AS nome, {text(keys)} AS chave, {text(values)} AS valor{more} FROM ({source})"

    n = "count(*) AS quantidade_atrasos"
    pair = "\"ICAO Aeródromo Origem\" AS origem, \"ICAO Aeródromo Destino\" AS destino"
    rank = "dense_rank() OVER (PARTITION BY ano ORDER BY count(*) DESC) AS rk"
    parts = [
        part("kpis", ["voos"], ["empresas", "rotas"],
             f"SELECT count(*) AS voos, {_dist_null(q('Empresa Aérea'))} AS empresas, "
             "count(DISTINCT (\"ICAO Aeródromo Origem\", \"ICAO Aeródromo Destino\")) AS rotas FROM filtered"),
        part("per_day", ["dia"], ["voos"], "SELECT CAST(\"Partida Prevista\" AS DATE) AS dia, count(*) AS voos FROM filtered GROUP BY 1"),
        part("status", ["status"], ["quantidade"], "SELECT \"Status do Voo\" AS status, count(*) AS quantidade FROM filtered GROUP BY 1"),
        part("top_routes", ["origem", "destino"], ["quantidade"],
             f"SELECT {pair}, count(*) AS quantidade FROM filtered GROUP BY 1, 2 ORDER BY quantidade DESC, origem, destino LIMIT 20"),
        part("sample", ["numero_voo"], ["partida"],
             "SELECT \"Número Voo\" AS numero_voo, \"Partida Prevista\" AS partida FROM filtered ORDER BY 2, 1 LIMIT 1000"),
        part("aeroportos", ["aeroporto"], ["quantidade_atrasos"],
             f"SELECT \"Aeródromo Origem\" AS aeroporto, {n} FROM base GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25"),
        part("variacao", ["aeroporto"], ["y_prev", "y_curr", "delta", "true"], "SELECT * FROM variation"),
        part("aumentos", ["aeroporto"], ["delta"], "SELECT * FROM variation ORDER BY delta DESC, aeroporto LIMIT 10"),
        part("quedas", ["aeroporto"], ["delta"], "SELECT * FROM variation ORDER BY delta, aeroporto LIMIT 10"),
        part("por_ano", ["ano"], ["quantidade_atrasos"], f"SELECT ano, {n} FROM base GROUP BY 1"),
        part("dias_semana", ["ano", "dia"], ["quantidade_atrasos"],
             f"SELECT ano, {_weekday_case('dia_sem')} AS dia, {n} FROM base GROUP BY 1, 2"),
        part("periodos", ["ano", "periodo"], ["quantidade_atrasos"],
             f"SELECT ano, {_period_case('hora')} AS periodo, {n} FROM base GROUP BY 1, 2"),
        part("companhias", ["ano", "empresa"], ["quantidade_atrasos"],
             f"SELECT ano, empresa, quantidade_atrasos FROM (SELECT ano, \"Empresa Aérea\" AS empresa, {n}, {rank} "
             "FROM base GROUP BY 1, 2) WHERE rk <= 15"),
        part("companhias_por_ano", ["ano", "empresa"], ["quantidade_atrasos"],
             f"SELECT ano, \"Empresa Aérea\" AS empresa, {n} FROM base GROUP BY 1, 2"),
        part("rotas", ["origem_lon", "origem_lat", "destino_lon", "destino_lat"], ["quantidade", "CAST(atraso_medio AS DECIMAL(18, 6))"],
             "SELECT * FROM routes"),
        part("intensidade", ["origem_lon", "origem_lat", "destino_lon", "destino_lat"], ["CAST(intensidade AS DECIMAL(18, 6))"],
             _INTENSITY),
        part("nos", ["lon", "lat"], ["quantidade"],
             "SELECT lon, lat, CAST(sum(quantidade) AS BIGINT) AS quantidade FROM (SELECT origem_lon AS lon, origem_lat AS lat, quantidade "
             "FROM routes UNION ALL SELECT destino_lon, destino_lat, quantidade FROM routes) GROUP BY 1, 2"),
    ]
    return w(RAW, kept, base, undated, _yoy_cte("base_all", "variation"), _routes_cte(), _SCALE) + " UNION ALL ".join(
        sql for name, sql in parts if name not in leave_out)
