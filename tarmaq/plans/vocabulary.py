"""Fixed values of the flight model: source headers, codes, names and texts in the results."""

# Source header -> column, in file order.
FLIGHT_COLUMNS = {
    "ICAO Empresa Aérea": "icao_airline",
    "Número Voo": "flight_number",
    "Código Autorização (DI)": "di_code",
    "Código Tipo Linha": "line_type_code",
    "ICAO Aeródromo Origem": "icao_origin",
    "ICAO Aeródromo Destino": "icao_destination",
    "Partida Prevista": "scheduled_departure",
    "Partida Real": "actual_departure",
    "Chegada Prevista": "scheduled_arrival",
    "Chegada Real": "actual_arrival",
    "Situação Voo": "flight_status",
    "Código Justificativa": "justification_code",
}

AERODROME_COLUMNS = {
    "Código OACI": "icao",
    "CIAD": "ciad",
    "Nome": "name",
    "Município": "municipality",
    "UF": "state",
    "Município Servido": "served_municipality",
    "UF Servido": "served_state",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Altitude": "altitude",
    "Situação": "status",
}

COMPANY_COLUMNS = {
    "ICAO": "icao",
    "Estrangeira": "iata_code",
    "Razao": "legal_name",
    "Servico": "service",
    "Cidade": "city",
    "UF": "state",
    "Ativa": "status",
}

# domain, code, description
OPERATION_CODES = [
    ("di_code", "0", "Etapa Regular"),
    ("di_code", "2", "Etapa Extra"),
    ("di_code", "3", "Etapa de Retorno"),
    ("di_code", "4", "Inclusão de Etapa"),
    ("di_code", "6", "Etapa Não Remunerada Sem Transporte de Objetos"),
    ("di_code", "7", "Etapa de Voo de Fretamento"),
    ("di_code", "9", "Etapa de Voo Charter"),
    ("di_code", "D", "Etapa de Voo Duplicada"),
    ("di_code", "E", "Etapa Não Remunerada Com Transporte de Objetos"),
    ("line_type_code", "N", "Doméstica Mista"),
    ("line_type_code", "C", "Doméstica Cargueira"),
    ("line_type_code", "I", "Internacional Mista"),
    ("line_type_code", "G", "Internacional Cargueira"),
]

MISSING_MOMENT = "null"
MISSING_JUSTIFICATION = "N/A"

COMPLETED = "REALIZADO"
CANCELLED = "CANCELADO"
ACTIVE = "ATIVA"

EARLIEST_DELAY_MIN = -120
LATEST_DELAY_MIN = 1440
PUNCTUAL_WITHIN_MIN = 15

DOMESTIC_LINES = ["N", "C"]
INTERNATIONAL_LINES = ["I", "G"]
DOMESTIC = "Domestico"
INTERNATIONAL = "Internacional"
UNCLASSIFIED = "Nao classificado"

WEEKDAYS = ["domingo", "segunda", "terca", "quarta", "quinta", "sexta", "sabado"]

HOME_PREFIX = "^S[BDIJNSW]"
HOME_COUNTRY = "Brasil"
ABROAD = "Exterior"

UNKNOWN_AIRLINE = "COMPANHIA NAO CADASTRADA"
UNKNOWN_CODE = "Codigo nao catalogado"
UNKNOWN_AIRPORT = "AEROPORTO FORA DO CADASTRO ANAC"

REASONS = "motivos_quarentena"
QUARANTINED_AT = "_quarentenado_em"

RULE_NAMES = [
    "horarios_previstos_presentes",
    "situacao_voo_conhecida",
    "chegada_prevista_depois_da_partida_prevista",
    "chegada_real_depois_da_partida_real",
    "atraso_partida_plausivel",
    "atraso_chegada_plausivel",
    "empresa_no_cadastro_anac",
    "aeroporto_origem_no_cadastro_anac",
    "aeroporto_destino_no_cadastro_anac",
]
