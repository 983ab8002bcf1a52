"""Fixed values of the flight-operations data model.

Everything in this module is a FIXED VALUE: labels, code lists and limits
that must be equal to the original data contract for results to match.
They are listed plainly and in their natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: line-type codes (8 entries) ------------------------------
LINE_TYPES: dict[str, str] = {
    "C": "Transporte Aéreo Público Regular",
    "N": "Transporte Aéreo Público Não Regular (Charter/Fretamento)",
    "G": "Aviação Geral",
    "S": "Serviços Aéreos Especializados",
    "E": "Experimental",
    "M": "Militar",
    "T": "Táxi Aéreo",
    "P": "Aviação Privada",
}

# --- FIXED VALUES: delay / cancellation justification codes (49 entries) ---
JUSTIFICATIONS: dict[str, str] = {
    "AA": "ATRASO AEROPORTO DE ALTERNATIVA – ORDEM TÉCNICA",
    "AF": "FACILIDADES DO AEROPORTO - RESTRIÇÕES DE APOIO",
    "AG": "MIGRAÇÃO/ALFÂNDEGA/SAÚDE",
    "AI": "AEROPORTO DE ORIGEM INTERDITADO",
    "AJ": "AEROPORTO DE DESTINO INTERDITADO",
    "AM": "ATRASO AEROPORTO DE ALTERNATIVA – CONDIÇÕES METEOROLÓGICAS",
    "AS": "SEGURANÇA/PAX/CARGA/ALARME",
    "AR": "AEROPORTO COM RESTRIÇÕES OPERACIONAIS",
    "AT": "LIBERAÇÃO SERV. TRÁFEGO AÉREO/ANTECIPAÇÃO",
    "DF": "AVARIA DURANTE OPERAÇÕES EM VÔO",
    "DG": "AVARIA DURANTE OPERAÇÕES EM SOLO",
    "FP": "PLANO DE VÔO - APROVAÇÃO",
    "GF": "ABASTECIMENTO/DESTANQUEIO",
    "MA": "FALHA EQUIPO AUTOMOTIVO E DE ATENDIMENTO DE PAX",
    "MX": "ATRASOS NÃO ESPECÍFICOS – OUTROS",
    "OA": "AUTORIZADO",
    "RA": "CONEXÃO DE AERONAVE",
    "RI": "CONEXÃO AERONAVE/VOLTA – VÔO DE IDA NÃO PENALIZADO AEROPORTO INTERDITADO",
    "RM": "CONEXÃO AERONAVE/VOLTA – VÔO DE IDA NÃO PENALIZADO CONDIÇÕES METEOROLÓGICAS",
    "TC": "TROCA DE AERONAVE",
    "TD": "DEFEITOS DA AERONAVE",
    "WA": "ALTERNATIVA ABAIXO DOS LIMITES",
    "WI": "DEGELO E REMOÇÃO DE NEVE E/OU LAMA EM AERONAVE",
    "WR": "ATRASO DEVIDO RETORNO – CONDIÇÕES METEOROLÓGICAS",
    "WO": "AEROPORTO ORIGEM ABAIXO DOS LIMITES",
    "WP": "ATRASO DEVIDO RETORNO – ORDEM TÉCNICA",
    "WT": "AEROPORTO DESTINO ABAIXO DOS LIMITES",
    "WS": "REMOÇÃO GELO/ÁGUA/LAMA/AREIA-EM AEROPORTO",
    "XA": "PROGRAMADO – FERIADO NACIONAL",
    "XB": "AUTORIZADO",
    "XI": "DEVIDO AEROPORTO DE ORIGEM INTERDITADO",
    "XJ": "DEVIDO AEROPORTO DE DESTINO INTERDITADO",
    "XL": "FALTA PAX COM PASSAGEM MARCADA – (APENAS PARA AS LINHAS AÉREAS DOMÉSTICAS REGIONAIS)",
    "XM": "CANCELAMENTO – CONEXÃO AERONAVE/VOLTA – VÔO DE IDA CANCELADO – AEROPORTO INTERDITADO",
    "XN": "CANCELAMENTO POR MOTIVOS TÉCNICOS – OPERACIONAIS",
    "XO": "CANCELAMENTO – AEROPORTO ORIGEM ABAIXO LIMITES",
    "XT": "CANCELAMENTO – AEROPORTO DESTINO ABAIXO LIMITES",
    "XR": "CANCELAMENTO DE VÔOS OPERADOS EM “CODE SHARING”",
    "XS": "CANCELAMENTO – CONEXÃO AERONAVE/VOLTA – VÔO DE IDA CANCELADO – CONDIÇÕES METEOROLÓGICAS",
    "ST": "INCLUSÃO DE ETAPA DEVIDO CANCELAMENTO DE ESCALAS PREVISTAS – (EXCLUSIVO PARA LINHAS SUPLEMENTADAS)",
    "IR": "INCLUSÃO DE ETAPA (AEROPORTO DE ALTERNATIVA) DEVIDO A UM VÔO ESPECIAL RETORNO",
    "VR": "VÔO ESPECIAL DE RETORNO (EXCLUSIVO PARA RETORNO AO AEROPORTO DE ORIGEM)",
    "VE": "ESPECÍFICO PARA VÔO ESPECIAL DE EXPERIÊNCIA",
    "VI": "ESPECÍFICO PARA VÔO ESPECIAL DE INSTRUÇÃO",
    "HA": "AUTORIZADA",
    "HB": "OPERAÇÃO DE VÔO COM MAIS DE 04 HORAS DE ATRASO PANE AERONAVE",
    "HC": "OPERAÇÃO DE VÔO COM MAIS DE 04 HORAS DE ATRASO AEROPORTO INTERDITADO",
    "HD": "ANTECIPAÇÃO DE HORÁRIO AUTORIZADA",
    "HI": "ANTECIPAÇÃO DE HORÁRIO AUTORIZADA – ESPECÍFICO VÔOS INTERNACIONAIS",
}

# --- FIXED VALUES: airport size labels; any other type decodes to "" -------
AIRPORT_SIZES: dict[str, str] = {
    "large_airport": "Grande Porte",
    "medium_airport": "Médio Porte",
    "small_airport": "Pequeno Porte",
}
AIRPORT_SIZE_DEFAULT = ""
HELIPORT = "heliport"

# --- FIXED VALUES: labels and literals --------------------------------------
CODE_NOT_FOUND = "Código não encontrado"
STATUS_LATE = "Atrasado"
STATUS_OK = "Ok"
SITUATION_DONE = "REALIZADO"
DOMESTIC_COUNTRY = "BR"
LOCAL_ZONE = "America/Sao_Paulo"
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# Period of day by local hour: [0,6) [6,12) [12,18) and everything else.
DAY_PERIODS = ("Madrugada", "Manhã", "Tarde", "Noite")
# ISO weekday 1=Monday … 7=Sunday.
WEEKDAY_LABELS = ("Seg", "Ter", "Qua", "Qui", "Sex", "Sáb", "Dom")

# Geographic box used to validate coordinates (Brazil).
LON_MIN, LON_MAX = -75.0, -28.0
LAT_MIN, LAT_MAX = -34.0, 6.0
COORD_FORMATS = ("auto", "lon,lat", "lat,lon")

# --- FIXED VALUES: limits of the analytic views -----------------------------
UNIQUE_VALUES_LIMIT = 20_000
SAMPLE_ROWS = 1_000
TOP_ROUTES = 20
TOP_DELAY_AIRPORTS = 25
YOY_TOP = 10
TOP_AIRLINES_PER_YEAR = 15
ROUTE_MAP_TOP_DEFAULT = 1_000
ROUTE_MAP_TOP_MIN, ROUTE_MAP_TOP_MAX = 100, 5_000
DELAY_LIMIT_DEFAULT = 15
DELAY_LIMIT_MIN, DELAY_LIMIT_MAX = 0, 180
QUANTILE_LOW, QUANTILE_HIGH = 0.05, 0.95
SCALE_RANGE_FLOOR = 1e-6
