"""Fixed values of the audit.

Everything in the block marked FIXED VALUES must stay equal to the audited
specification for results to match: labels, word lists, patterns and field
lists are part of the output contract.  Values marked [ours] are choices of
this library where the specification is silent; they live here so they can be
changed in one place.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the specification)
# ---------------------------------------------------------------------------

# Observation type labels, in declaration order.
TIPO_NULL = "NULL"
TIPO_VACIO = "VACIO"
TIPO_OBLIGADO = "CAMP_OBLIGADO"
TIPO_CONDICIONAL = "CAMP_CONDICIONAL"
TIPO_OPC_CONDICIONAL = "CAMP_OPC_CONDICIONAL"
TIPO_OPCIONAL = "CAMP_OPCIONAL"

# Severities.
SEV_ALTA = "ALTA"
SEV_MEDIA = "MEDIA"
SEV_BAJA = "BAJA"

# Placeholder words and phrases (validator V1), in their natural order.
PLACEHOLDER_WORDS = (
    "no tiene", "no especifica", "no existe", "no contiene", "sin informacion",
    "sin información", "desconocido", "n/a", "na", "null", "ninguno", "sin dato",
    "dato no disponible", "no aplica", "no corresponde", "no registrado",
    "no declarado", "no proveído", "no proporcionado", "información no disponible",
    "información desconocida", "s/d", "s/n", "sn",
)

# Keyboard runs flagged in free text (validator V6), final list.
KEYBOARD_RUNS = ("QWERTY", "ASDFGH", "ZXCVBN", "123456", "ABCDEF")
# Keyboard runs of the earlier draft, kept as an alternative parameter.
KEYBOARD_RUNS_DRAFT = ("ASDF", "QWERTY", "ZXCV", "QAZ", "WSX", "EDC", "RFV", "TGB", "YHN", "UJM")

# Four-digit ascending / descending runs (validator V7).
ASCENDING_RUNS = ("0123", "1234", "2345", "3456", "4567", "5678", "6789", "7890", "8901", "9012")
DESCENDING_RUNS = ("9876", "8765", "7654", "6543", "5432", "4321", "3210", "2109", "1098", "0987")

# E-mail shape (validator V2).
EMAIL_SHAPE = r"^[A-Za-z0-9._%+\-]{3,}@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$"
# Same character 4 times in a row in an e-mail; user part of digits (V2).
EMAIL_REPEAT = r"(?i)(.)\1{3,}"
EMAIL_DIGIT_USER = r"^[0-9]+@"
# A phone number of one digit only (V3).
ONE_DIGIT_PHONE = r"^([0-9])\1+$"
# Same character 4 times in a row; a unit of 1 to 3 repeated as the whole value (V6).
TEXT_REPEAT = r"(.)\1{3,}"
UNIT_REPEAT = r"^([A-Z0-9]{1,3})\1{2,}$"
# Either of them in one search.
REPEAT = r"(.)\1\1\1|^([A-Z0-9]{1,3})\2{2,}$"
# Tax-id ending: one of 01..04 followed by a digit 1..9 (validator V4).
NIT_ENDING = r"(01|02|03|04)[1-9]$"
# Letters used by the free-text checks (upper case, Spanish accents).
LETTERS_CLASS = "A-ZÁÉÍÓÚÜÑ"
VOWELS_CLASS = "AEIOUÁÉÍÓÚÜ"
# Marital status that requires a spouse name.
MARRIED_PATTERN = r"(?i)(casad|concubin)"

# Generic placeholder dates (draft date check).
GENERIC_DATES = ("00/00/0000", "31/12/9999", "01/01/1800")
DATE_FORMAT = "dd/MM/yyyy"

# The 54 audited fields, in code order 0..53.
FIELDS = (
    "CODIGO", "FECHA_ULTIMA_TRANSACCION", "TIPO_CUENTA_ULTIMA_TRANSACCION",
    "CANAL_ATENCION_ULT_TRANS", "RAZON_SOCIAL", "TIPO_SOCIEDAD_COMERCIAL",
    "CODIGO_ACTIVIDAD_ECONOMICA", "DESCRIPCION_ACTIVIDAD_ECONOMICA",
    "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CARGO_ALTA_GERENCIA",
    "NOMBRES_APELLIDOS_CARGO_GERENCIA", "TIPO_DOC_ID", "NRO_DOC_ID", "EXT_DOC_ID", "NIT",
    "NUMERO_REGISTRO", "DOMICILIO", "TELEFONO", "REFERENCIAS_COMERCIALES",
    "CLASIFICACION_TIPO_RIESGO", "CODIGO_REP_LEGAL", "NOMBRE_REP_LEGAL",
    "NACIONALIDAD_REP_LEGAL", "PAIS_RESIDENCIA_REP_LEGAL", "TIPO_DOCUMENTO_IDENT_REP_LEGAL",
    "DOCUMENTO_IDENTIDAD_REP_LEGAL", "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "NIT_REP_LEGAL",
    "FECHA_NACIMIENTO_REP_LEGAL", "ESTADO_CIVIL_REP_LEGAL", "NOMBRE_CONYUGE_REP_LEGAL",
    "DOMICILIO_PARTICULAR_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL", "TELEFONO_REP_LEGAL",
    "CORREO_ELECTRONICO_REP_LEGAL", "PROFESION_REP_LEGAL", "CODIGO_ACTIVIDAD_ECO_REP_LEGAL",
    "DESC_ACTIVIDAD_ECO_REP_LEGAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL",
    "FECHA_INGRESO_TRABAJO_REP_LEGAL", "MONEDA_NIVEL_INGRESOS_REP_LEGAL",
    "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "FECHA_INGRESO_TRAB_REP_LEGAL",
    "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    "TIPO_RIESGO_REP_LEGAL", "PAF_ALTA", "FECHA_ALTA", "OPERACION_ASOCIADA_ALTA",
    "FECHA_ULTIMA_ACTUALIZACION", "CANTIDAD_ACTUALIZACIONES",
)

# Field categories.
MANDATORY = (
    "CODIGO", "TIPO_SOCIEDAD_COMERCIAL", "CODIGO_ACTIVIDAD_ECONOMICA",
    "DESCRIPCION_ACTIVIDAD_ECONOMICA", "NIT", "REFERENCIAS_COMERCIALES", "PAF_ALTA",
    "FECHA_ALTA", "OPERACION_ASOCIADA_ALTA",
)
CONDITIONAL = (
    "RAZON_SOCIAL", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CARGO_ALTA_GERENCIA",
    "NOMBRES_APELLIDOS_CARGO_GERENCIA", "TIPO_DOC_ID", "NRO_DOC_ID", "DOMICILIO",
    "NOMBRE_REP_LEGAL", "NACIONALIDAD_REP_LEGAL", "PAIS_RESIDENCIA_REP_LEGAL",
    "FECHA_NACIMIENTO_REP_LEGAL", "ESTADO_CIVIL_REP_LEGAL", "NOMBRE_CONYUGE_REP_LEGAL",
    "DOMICILIO_PARTICULAR_REP_LEGAL", "PROFESION_REP_LEGAL", "CODIGO_ACTIVIDAD_ECO_REP_LEGAL",
    "DESC_ACTIVIDAD_ECO_REP_LEGAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL",
    "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "FECHA_INGRESO_TRAB_REP_LEGAL",
)
OPTIONAL_CONDITIONAL = (
    "FECHA_ULTIMA_TRANSACCION", "TIPO_CUENTA_ULTIMA_TRANSACCION", "CANAL_ATENCION_ULT_TRANS",
    "TELEFONO", "CODIGO_REP_LEGAL", "TIPO_DOCUMENTO_IDENT_REP_LEGAL",
    "DOCUMENTO_IDENTIDAD_REP_LEGAL", "TELEFONO_REP_LEGAL", "CORREO_ELECTRONICO_REP_LEGAL",
    "FECHA_INGRESO_TRABAJO_REP_LEGAL", "MONEDA_NIVEL_INGRESOS_REP_LEGAL",
    "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    "TIPO_RIESGO_REP_LEGAL", "FECHA_ULTIMA_ACTUALIZACION", "CANTIDAD_ACTUALIZACIONES",
)
OPTIONAL = (
    "EXT_DOC_ID", "NUMERO_REGISTRO", "CLASIFICACION_TIPO_RIESGO",
    "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "NIT_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL",
    "CORREO_ELECTRONICO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL",
    "REFERENCIAS_BANCARIAS_REP_LEGAL",
)
# Legal-representative fields required once CODIGO_REP_LEGAL is filled.
REP_LEGAL_DEPENDENTS = (
    "NOMBRE_REP_LEGAL", "NACIONALIDAD_REP_LEGAL", "PAIS_RESIDENCIA_REP_LEGAL",
    "FECHA_NACIMIENTO_REP_LEGAL", "DOMICILIO_PARTICULAR_REP_LEGAL", "PROFESION_REP_LEGAL",
    "CODIGO_ACTIVIDAD_ECO_REP_LEGAL", "DESC_ACTIVIDAD_ECO_REP_LEGAL", "LUGAR_TRABAJO_REP_LEGAL",
    "CARGO_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS",
    "FECHA_INGRESO_TRAB_REP_LEGAL",
)

# Report category per observation type (REGLA).
REGLA_BY_TIPO = (
    (TIPO_NULL, "NULL"),
    (TIPO_VACIO, "VACIO"),
    (TIPO_OBLIGADO, "OBLIGATORIO"),
    (TIPO_CONDICIONAL, "DEPENDE_DE"),
    (TIPO_OPC_CONDICIONAL, "FORMATO"),
    (TIPO_OPCIONAL, "INCONSISTENCIA"),
)
REGLA_OTHER = "OTRO"

# Friendly descriptions used by the audit report.
DESC_PLACEHOLDER = "Contiene palabras no permitidas"
DESC_MISSING = "Campo obligatorio sin datos"
DESC_BAD_FORMAT = "Formato inválido"
DESC_BAD_TEXT = "Texto con caracteres o patrones inválidos"
DESC_BAD_EMAIL = "Email inválido"
DESC_BAD_PHONE = "Teléfono inválido"
DESC_OPTIONAL_TEXT = "Texto con inconsistencias"

# Critical-record view: more than this many NULL fields.
CRITICAL_NULL_THRESHOLD = 5
# Heavy-record example: more than this many observations.
HEAVY_RECORD_THRESHOLD = 10
# Top-k size of the "fields with most problems" report.
TOP_FIELDS_K = 10

# ---------------------------------------------------------------------------
# [ours] choices where the specification is silent
# ---------------------------------------------------------------------------

# Per-field profile categories (first list wins for fields in two lists).
CATEGORY_LABELS = (
    (MANDATORY, "OBLIGATORIO"),
    (CONDITIONAL, "CONDICIONAL"),
    (OPTIONAL_CONDITIONAL, "OPC_CONDICIONAL"),
    (OPTIONAL, "OPCIONAL"),
)
# Field quality bands on completeness percent: (upper bound exclusive, label).
QUALITY_BANDS = ((40, "CRÍTICA"), (70, "BAJA"), (95, "BUENA"))
QUALITY_TOP = "EXCELENTE"
# Example codes kept per field and state.
EXAMPLE_CODES = 5
# Default "today" for date checks, so results repeat (the run date).
DEFAULT_AS_OF = "2025-06-30"
DEFAULT_RUN_ID = "20250630"
