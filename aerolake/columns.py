"""Column-name registry of the flight tables, and schema checks.

Operators take column names as arguments; the defaults are the names of the
original flight extracts (they are FIXED VALUES of the data contract).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class FlightColumns:
    # --- FIXED VALUES: raw / clean flight column names ---
    airline_icao: str = "ICAO Empresa Aérea"
    flight_number: str = "Número Voo"
    authorization: str = "Código Autorização (DI)"
    line_type_code: str = "Código Tipo Linha"
    origin_icao: str = "ICAO Aeródromo Origem"
    dest_icao: str = "ICAO Aeródromo Destino"
    dep_planned: str = "Partida Prevista"
    dep_real: str = "Partida Real"
    arr_planned: str = "Chegada Prevista"
    arr_real: str = "Chegada Real"
    situation: str = "Situação Voo"
    reason_code: str = "Código Justificativa"
    # enrichment outputs
    origin_name: str = "Aeródromo Origem"
    origin_continent: str = "Origem Continente"
    origin_country: str = "Origem País ISO"
    origin_city: str = "Origem Município"
    origin_gps: str = "Origem GPS"
    origin_coords: str = "Origem Coordenadas"
    origin_size: str = "Tamanho Origem"
    dest_name: str = "Aeródromo Destino"
    dest_continent: str = "Destino Continente"
    dest_country: str = "Destino País ISO"
    dest_city: str = "Destino Município"
    dest_gps: str = "Destino GPS"
    dest_coords: str = "Destino Coordenadas"
    dest_size: str = "Tamanho Destino"
    reason: str = "Justificativa"
    line_type: str = "Tipo Linha"
    airline: str = "Empresa Aérea"
    status: str = "Status do Voo"

    @property
    def times(self) -> tuple[str, str, str, str]:
        return (self.dep_planned, self.dep_real, self.arr_planned, self.arr_real)


COLS = FlightColumns()

# Airport lookup records (JSON array of objects) and airline records.
AIRPORT_FIELDS = ("icao_code", "name", "continent", "iso_country",
                  "municipality", "gps_code", "coordinates", "type")
AIRLINE_FIELDS = ("Nome", "Sigla")

RAW_COLUMNS = (
    COLS.airline_icao, COLS.flight_number, COLS.authorization, COLS.line_type_code,
    COLS.origin_icao, COLS.dest_icao, COLS.dep_planned, COLS.dep_real,
    COLS.arr_planned, COLS.arr_real, COLS.situation, COLS.reason_code,
)

# The 24 columns the analytic layer expects on the clean table.
CLEAN_COLUMNS = (
    COLS.airline_icao, COLS.flight_number, COLS.origin_icao, COLS.dest_icao,
    COLS.dep_planned, COLS.dep_real, COLS.arr_planned, COLS.arr_real,
    COLS.situation, COLS.reason_code,
    COLS.origin_name, COLS.origin_city, COLS.origin_gps, COLS.origin_coords, COLS.origin_size,
    COLS.dest_name, COLS.dest_city, COLS.dest_gps, COLS.dest_coords, COLS.dest_size,
    COLS.reason, COLS.line_type, COLS.airline, COLS.status,
)

# Columns dropped once the enrichment is done.
DROPPED_AFTER_CLEAN = (
    COLS.origin_continent, COLS.origin_country, COLS.dest_continent,
    COLS.dest_country, COLS.authorization, COLS.line_type_code,
)

# ASCII snake_case names of exported and compared rows.
ASCII_NAMES: dict[str, str] = {
    "ICAO Empresa Aérea": "icao_empresa",
    "Número Voo": "numero_voo",
    "Código Autorização (DI)": "codigo_autorizacao",
    "Código Tipo Linha": "codigo_tipo_linha",
    "ICAO Aeródromo Origem": "icao_origem",
    "ICAO Aeródromo Destino": "icao_destino",
    "Partida Prevista": "partida_prevista",
    "Partida Real": "partida_real",
    "Chegada Prevista": "chegada_prevista",
    "Chegada Real": "chegada_real",
    "Situação Voo": "situacao_voo",
    "Código Justificativa": "codigo_justificativa",
    "Aeródromo Origem": "aeroporto_origem",
    "Origem Continente": "continente_origem",
    "Origem País ISO": "pais_origem",
    "Origem Município": "municipio_origem",
    "Origem GPS": "gps_origem",
    "Origem Coordenadas": "coordenadas_origem",
    "Tamanho Origem": "tamanho_origem",
    "Aeródromo Destino": "aeroporto_destino",
    "Destino Continente": "continente_destino",
    "Destino País ISO": "pais_destino",
    "Destino Município": "municipio_destino",
    "Destino GPS": "gps_destino",
    "Destino Coordenadas": "coordenadas_destino",
    "Tamanho Destino": "tamanho_destino",
    "Justificativa": "justificativa",
    "Tipo Linha": "tipo_linha",
    "Empresa Aérea": "empresa",
    "Status do Voo": "status_voo",
}


def to_ascii_names(df: DataFrame) -> DataFrame:
    """Rename the flight columns present in ``df`` to their ASCII names."""
    present = {k: v for k, v in ASCII_NAMES.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def missing_columns(df: DataFrame, expected=CLEAN_COLUMNS) -> list[str]:
    """Expected columns that are absent from ``df`` (plan-time check, no job)."""
    have = set(df.columns)
    return [c for c in expected if c not in have]


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    return None


def is_temporal(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def string_schema(names) -> T.StructType:
    """All-string schema: CSV and JSON edges are read as text, cast later."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])
