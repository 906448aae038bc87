"""REGLA and DESCRIPCION of the audit report, per rule family (goldens from
the specification's description table)."""

from pyspark.sql import functions as F

from recordcheck.operators.detail import friendly_description, regla
from recordcheck.plans.catalog_party import party_catalog

WANT = {  # motivo -> (REGLA, DESCRIPCION)
    "NIT_NULL": ("NULL", "NIT_null"),
    "NIT_VACIO": ("VACIO", "NIT_vacio"),
    "NIT_FALTANTE": ("OBLIGATORIO", "Campo obligatorio sin datos"),
    "NIT_PALABRA_INVALIDA": ("OBLIGATORIO", "Contiene palabras no permitidas"),
    "NIT_FORMATO_INVALIDO": ("OBLIGATORIO", "Formato inválido"),
    "RAZON_SOCIAL_TEXTO_INVALIDO": ("OBLIGATORIO", "Texto con caracteres o patrones inválidos"),
    "IDENTIFICACION_CANT_INT_ALTA_GERENCIA_SIN_CARGO_ALTA_GERENCIA": ("DEPENDE_DE", "Requiere CARGO_ALTA_GERENCIA"),
    "IDENTIFICACION_CANT_INT_ALTA_GERENCIA_SIN_NOMBRES_APELLIDOS": ("DEPENDE_DE", "Requiere NOMBRES_APELLIDOS"),
    "CARGO_ALTA_GERENCIA_SIN_IDENTIFICACION_VALIDA": ("DEPENDE_DE", "Requiere IDENTIFICACION_VALIDA"),
    "CARGO_ALTA_GERENCIA_SIN_NOMBRES_APELLIDOS": ("DEPENDE_DE", "Requiere NOMBRES_APELLIDOS"),
    "NOMBRES_APELLIDOS_SIN_IDENTIFICACION_VALIDA": ("DEPENDE_DE", "Requiere IDENTIFICACION_VALIDA"),
    "NOMBRES_APELLIDOS_SIN_CARGO": ("DEPENDE_DE", "Requiere CARGO"),
    "TIPO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS": ("DEPENDE_DE", "TIPO_DOC_ID requiere NOMBRES_APELLIDOS"),
    "NRO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS": ("DEPENDE_DE", "NRO_DOC_ID requiere NOMBRES_APELLIDOS"),
    "PROFESION_REP_LEGAL_REQUERIDO_POR_CODIGO_REP_LEGAL": ("DEPENDE_DE", "PROFESION_REP_LEGAL requiere CODIGO_REP_LEGAL"),
    "NOMBRE_CONYUGE_REQUERIDO_POR_ESTADO_CIVIL": ("DEPENDE_DE", "NOMBRE_CONYUGE requiere ESTADO_CIVIL"),
    "DOMICILIO_INVALIDO": ("DEPENDE_DE", "DOMICILIO_INVALIDO"),
    "DOMICILIO_PARTICULAR_INVALIDO": ("DEPENDE_DE", "DOMICILIO_PARTICULAR_INVALIDO"),
    "FECHA_ULT_TRANS_REQUERIDA": ("FORMATO", "FECHA_ULT_TRANS_REQUERIDA"),
    "TIPO_CUENTA_ULT_TRANS_REQUERIDA": ("FORMATO", "TIPO_CUENTA_ULT_TRANS_REQUERIDA"),
    "CANAL_ULT_TRANS_REQUERIDO": ("FORMATO", "CANAL_ULT_TRANS es requerido"),
    "EMAIL_FORMATO_INVALIDO": ("FORMATO", "Email inválido"),
    "TELEFONO_INVALIDO": ("FORMATO", "Teléfono inválido"),
    "CODIGO_REP_LEGAL_REQUERIDO": ("FORMATO", "CODIGO_REP_LEGAL es requerido"),
    "AL_MENOS_UNA_REFERENCIA_REQUERIDA": ("FORMATO", "AL_MENOS_UNA_REFERENCIA_REQUERIDA"),
    "CANT_ACTUALIZACIONES_DEBE_SER_MAYOR_1": ("FORMATO", "CANT_ACTUALIZACIONES_DEBE_SER_MAYOR_1"),
    "EXT_DOC_ID_TEXTO_INVALIDO": ("INCONSISTENCIA", "Texto con inconsistencias"),
}


def test_report_wording_per_rule(spark):
    rules = {r.motivo: r for r in party_catalog().rules}
    rows = [(rules[m].field, m, rules[m].tipo) for m in WANT]
    df = spark.createDataFrame(rows, "campo string, motivo string, tipo string")
    got = df.select("motivo", regla(F.col("tipo")).alias("REGLA"),
                    friendly_description(F.col("campo"), F.col("motivo"), F.col("tipo")).alias("D")).collect()
    for r in got:
        assert (r["REGLA"], r["D"]) == WANT[r["motivo"]], r


def test_unknown_type_is_other(spark):
    df = spark.createDataFrame([("X", "X_Y", "INCONSISTENCIA_DATOS")], "campo string, motivo string, tipo string")
    r = df.select(regla(F.col("tipo")), friendly_description(F.col("campo"), F.col("motivo"), F.col("tipo"))).first()
    assert tuple(r) == ("OTRO", "X_Y")
