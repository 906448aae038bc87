"""What the comparison SQL knows about the specification, written out on its own:
field, word and run lists, labels and which fields each field-level query covers.

FIXED VALUES (must equal the specification).
"""

FIELDS = (
    "CODIGO", "FECHA_ULTIMA_TRANSACCION", "TIPO_CUENTA_ULTIMA_TRANSACCION", "CANAL_ATENCION_ULT_TRANS", "RAZON_SOCIAL", "TIPO_SOCIEDAD_COMERCIAL", "CODIGO_ACTIVIDAD_ECONOMICA", "DESCRIPCION_ACTIVIDAD_ECONOMICA", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CARGO_ALTA_GERENCIA", "NOMBRES_APELLIDOS_CARGO_GERENCIA", "TIPO_DOC_ID", "NRO_DOC_ID", "EXT_DOC_ID", "NIT", "NUMERO_REGISTRO", "DOMICILIO", "TELEFONO", "REFERENCIAS_COMERCIALES", "CLASIFICACION_TIPO_RIESGO", "CODIGO_REP_LEGAL", "NOMBRE_REP_LEGAL", "NACIONALIDAD_REP_LEGAL", "PAIS_RESIDENCIA_REP_LEGAL", "TIPO_DOCUMENTO_IDENT_REP_LEGAL", "DOCUMENTO_IDENTIDAD_REP_LEGAL", "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "NIT_REP_LEGAL", "FECHA_NACIMIENTO_REP_LEGAL", "ESTADO_CIVIL_REP_LEGAL", "NOMBRE_CONYUGE_REP_LEGAL", "DOMICILIO_PARTICULAR_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL", "TELEFONO_REP_LEGAL", "CORREO_ELECTRONICO_REP_LEGAL", "PROFESION_REP_LEGAL", "CODIGO_ACTIVIDAD_ECO_REP_LEGAL", "DESC_ACTIVIDAD_ECO_REP_LEGAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL", "FECHA_INGRESO_TRABAJO_REP_LEGAL", "MONEDA_NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "FECHA_INGRESO_TRAB_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL", "TIPO_RIESGO_REP_LEGAL", "PAF_ALTA", "FECHA_ALTA", "OPERACION_ASOCIADA_ALTA", "FECHA_ULTIMA_ACTUALIZACION", "CANTIDAD_ACTUALIZACIONES",
)
MANDATORY = (
    "CODIGO", "TIPO_SOCIEDAD_COMERCIAL", "CODIGO_ACTIVIDAD_ECONOMICA", "DESCRIPCION_ACTIVIDAD_ECONOMICA", "NIT", "REFERENCIAS_COMERCIALES", "PAF_ALTA", "FECHA_ALTA", "OPERACION_ASOCIADA_ALTA",
)
CONDITIONAL = (
    "RAZON_SOCIAL", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CARGO_ALTA_GERENCIA", "NOMBRES_APELLIDOS_CARGO_GERENCIA", "TIPO_DOC_ID", "NRO_DOC_ID", "DOMICILIO", "NOMBRE_REP_LEGAL", "NACIONALIDAD_REP_LEGAL", "PAIS_RESIDENCIA_REP_LEGAL", "FECHA_NACIMIENTO_REP_LEGAL", "ESTADO_CIVIL_REP_LEGAL", "NOMBRE_CONYUGE_REP_LEGAL", "DOMICILIO_PARTICULAR_REP_LEGAL", "PROFESION_REP_LEGAL", "CODIGO_ACTIVIDAD_ECO_REP_LEGAL", "DESC_ACTIVIDAD_ECO_REP_LEGAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "FECHA_INGRESO_TRAB_REP_LEGAL",
)
OPTIONAL_CONDITIONAL = (
    "FECHA_ULTIMA_TRANSACCION", "TIPO_CUENTA_ULTIMA_TRANSACCION", "CANAL_ATENCION_ULT_TRANS", "TELEFONO", "CODIGO_REP_LEGAL", "TIPO_DOCUMENTO_IDENT_REP_LEGAL", "DOCUMENTO_IDENTIDAD_REP_LEGAL", "TELEFONO_REP_LEGAL", "CORREO_ELECTRONICO_REP_LEGAL", "FECHA_INGRESO_TRABAJO_REP_LEGAL", "MONEDA_NIVEL_INGRESOS_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL", "TIPO_RIESGO_REP_LEGAL", "FECHA_ULTIMA_ACTUALIZACION", "CANTIDAD_ACTUALIZACIONES",
)
OPTIONAL = (
    "EXT_DOC_ID", "NUMERO_REGISTRO", "CLASIFICACION_TIPO_RIESGO", "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "NIT_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL", "CORREO_ELECTRONICO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
)
REP_LEGAL_DEPENDENTS = (
    "NOMBRE_REP_LEGAL", "NACIONALIDAD_REP_LEGAL", "PAIS_RESIDENCIA_REP_LEGAL", "FECHA_NACIMIENTO_REP_LEGAL", "DOMICILIO_PARTICULAR_REP_LEGAL", "PROFESION_REP_LEGAL", "CODIGO_ACTIVIDAD_ECO_REP_LEGAL", "DESC_ACTIVIDAD_ECO_REP_LEGAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "FECHA_INGRESO_TRAB_REP_LEGAL",
)
PLACEHOLDER_WORDS = (
    "no tiene", "no especifica", "no existe", "no contiene", "sin informacion", "sin información", "desconocido", "n/a", "na", "null", "ninguno", "sin dato", "dato no disponible", "no aplica", "no corresponde", "no registrado", "no declarado", "no proveído", "no proporcionado", "información no disponible", "información desconocida", "s/d", "s/n", "sn",
)
KEYBOARD_RUNS = (
    "QWERTY", "ASDFGH", "ZXCVBN", "123456", "ABCDEF",
)
KEYBOARD_RUNS_DRAFT = (
    "ASDF", "QWERTY", "ZXCV", "QAZ", "WSX", "EDC", "RFV", "TGB", "YHN", "UJM",
)
ASCENDING_RUNS = (
    "0123", "1234", "2345", "3456", "4567", "5678", "6789", "7890", "8901", "9012",
)
DESCENDING_RUNS = (
    "9876", "8765", "7654", "6543", "5432", "4321", "3210", "2109", "1098", "0987",
)
GENERIC_DATES = (
    "00/00/0000", "31/12/9999", "01/01/1800",
)
LETTERS_CLASS = "A-ZÁÉÍÓÚÜÑ"
VOWELS_CLASS = "AEIOUÁÉÍÓÚÜ"
DEFAULT_AS_OF = "2025-06-30"
EXAMPLE_CODES = 5
QUALITY_BANDS = ((40, 'CRÍTICA'), (70, 'BAJA'), (95, 'BUENA'))
QUALITY_TOP = "EXCELENTE"
CATEGORY_LABELS = ((MANDATORY, 'OBLIGATORIO'), (CONDITIONAL, 'CONDICIONAL'), (OPTIONAL_CONDITIONAL, 'OPC_CONDICIONAL'), (OPTIONAL, 'OPCIONAL'))

# query -> (column prefix, fields)
FIELD_QUERIES = {
    "pb01_is_null": ("PB1", FIELDS), "pb02_is_blank": ("PB2", FIELDS), "pb03_is_empty": ("PB3", FIELDS), "pb04_is_filled": ("PB4", FIELDS), "pb05_upper_trim": ("PB5", ( "RAZON_SOCIAL", "DOMICILIO", "CARGO_REP_LEGAL",
    )),
    "pb06_only_digits": ("PB6", ( "NIT", "TELEFONO", "TELEFONO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    )),
    "pb07_double_simple": ("PB7", ( "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CANTIDAD_ACTUALIZACIONES",
    )),
    "pb08_double_locale": ("PB8", ( "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CANTIDAD_ACTUALIZACIONES",
    )),
    "pb09_positive_int": ("PB9", ( "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CANTIDAD_ACTUALIZACIONES",
    )),
    "pb10_nonneg_number": ("PB10", ( "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CANTIDAD_ACTUALIZACIONES",
    )),
    "pb11_positive_number": ("PB11", ( "NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS", "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CANTIDAD_ACTUALIZACIONES",
    )),
    "pb12_parsed_date": ("PB12", ( "FECHA_ULTIMA_TRANSACCION", "FECHA_NACIMIENTO_REP_LEGAL", "FECHA_INGRESO_TRABAJO_REP_LEGAL", "FECHA_INGRESO_TRAB_REP_LEGAL", "FECHA_ALTA", "FECHA_ULTIMA_ACTUALIZACION",
    )),
    "pb13_bad_date": ("PB13", ( "FECHA_ULTIMA_TRANSACCION", "FECHA_NACIMIENTO_REP_LEGAL", "FECHA_INGRESO_TRABAJO_REP_LEGAL", "FECHA_INGRESO_TRAB_REP_LEGAL", "FECHA_ALTA", "FECHA_ULTIMA_ACTUALIZACION",
    )),
    "v01_placeholder": ("V1", FIELDS), "v02_email": ("V2", ( "CORREO_ELECTRONICO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    )),
    "v03_phone": ("V3", ( "TELEFONO", "TELEFONO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    )),
    "v04_tax_id": ("V4", ( "NIT", "NIT_REP_LEGAL", "NRO_DOC_ID",
    )),
    "v05_address": ("V5", ( "DOMICILIO", "DOMICILIO_PARTICULAR_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL",
    )),
    "v06_free_text": ("V6", ( "RAZON_SOCIAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL", "EXT_DOC_ID", "NUMERO_REGISTRO", "CLASIFICACION_TIPO_RIESGO", "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "NIT_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL", "CORREO_ELECTRONICO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    )),
    "v06b_free_text_draft": ("V6B", ( "RAZON_SOCIAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL", "EXT_DOC_ID", "NUMERO_REGISTRO", "CLASIFICACION_TIPO_RIESGO", "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "NIT_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL", "CORREO_ELECTRONICO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    )),
    "v07_numeric_sequence": ("V7", ( "NUMERO_REGISTRO", "NIT_REP_LEGAL", "TELEFONO", "NRO_DOC_ID",
    )),
    "v08_repeated_letters": ("V8", ( "RAZON_SOCIAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL", "EXT_DOC_ID", "NUMERO_REGISTRO", "CLASIFICACION_TIPO_RIESGO", "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "NIT_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL", "CORREO_ELECTRONICO_REP_LEGAL", "REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL",
    )),
    "v09_optional_text": ("V9", OPTIONAL), "v10_optional_number": ("V10", ( "NUMERO_REGISTRO", "NIT_REP_LEGAL",
    )),
}
