"""Extended catalogue goldens, the S13 option and empty input."""

from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.operators.evaluate import evaluate
from recordcheck.plans.audit import Audit
from recordcheck.plans.catalog_extended import EXTENDED_FAMILIES
from recordcheck.plans.catalog_party import party_catalog
from recordcheck.sources.fixtures import party_from_keys

SCHEMA = ", ".join(f"{f} string" for f in K.FIELDS)


def clean(spark):
    keys = spark.createDataFrame([(10,)], "key long")
    return party_from_keys(keys, "key", keep_key=None).collect()[0].asDict()


def motivos(spark, rows, **catalog_kw):
    df = spark.createDataFrame([tuple(r[f] for f in K.FIELDS) for r in rows], SCHEMA)
    cat = party_catalog(**catalog_kw)
    ev = evaluate(df, cat.rules, cat.fields)
    return [{o["motivo"] for o in r[0]} for r in ev.select("OBS_ARRAY").collect()]


def test_extended_clean_record_is_clean(spark):
    assert motivos(spark, [clean(spark)], extended=True) == [set()]


def test_extended_families_fire(spark):
    base = clean(spark)
    cases = [
        ({"IDENTIFICACION_CANT_INT_ALTA_GERENCIA": "dos"}, "IDENTIFICACION_CANT_INT_ALTA_GERENCIA_NO_NUMERICA"),
        ({"ESTADO_CIVIL_REP_LEGAL": None}, "ESTADO_CIVIL_REP_LEGAL_REQUERIDO_POR_NOMBRE_CONYUGE"),
        ({"CARGO_REP_LEGAL": "GGGG"}, "CARGO_REP_LEGAL_TEXTO_INCONSISTENTE"),
        ({"FECHA_ULTIMA_TRANSACCION": "31/12/9999"}, "FECHA_ULT_TRANS_FECHA_INVALIDA"),
        ({"TIPO_RIESGO_REP_LEGAL": " "}, "TIPO_RIESGO_REP_LEGAL_REQUERIDO_POR_CODIGO_REP_LEGAL"),
        ({"FECHA_INGRESO_TRABAJO_REP_LEGAL": "2015-02-01"}, "FECHA_INGRESO_TRABAJO_REP_LEGAL_FORMATO_FECHA_INVALIDO"),
        ({"REFERENCIAS_COM_REP_LEGAL": "FERRETERIA SOLIZ"}, "REFERENCIAS_COM_REP_LEGAL_SIN_NOMBRE_Y_TELEFONO"),
        ({"FECHA_ULTIMA_ACTUALIZACION": "01/01/2019"}, "FECHA_ULTIMA_ACTUALIZACION_MENOR_A_FECHA_ALTA"),
        ({"CODIGO_REP_LEGAL": None}, "CODIGO_REP_LEGAL_VACIO_CON_DEPENDIENTES"),
        ({"NIT_REP_LEGAL": "12345678"}, "NIT_REP_LEGAL_NUMERO_INCONSISTENTE"),
    ]
    got = motivos(spark, [{**base, **over} for over, _ in cases], extended=True)
    for (over, want), m in zip(cases, got):
        assert want in m, (over, m)
    assert len(cases) == len(EXTENDED_FAMILIES)


def test_transactions_all_mode(spark):
    base = clean(spark)
    one_missing = {**base, "FECHA_ULTIMA_TRANSACCION": None}
    two_missing = {**base, "FECHA_ULTIMA_TRANSACCION": None, "CANAL_ATENCION_ULT_TRANS": None}
    anym = motivos(spark, [one_missing, two_missing])
    allm = motivos(spark, [one_missing, two_missing], mutual="all")
    assert "FECHA_ULT_TRANS_REQUERIDA" in anym[0] and "FECHA_ULT_TRANS_REQUERIDA" in anym[1]
    assert "FECHA_ULT_TRANS_REQUERIDA" in allm[0] and "FECHA_ULT_TRANS_REQUERIDA" not in allm[1]


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    a = Audit(empty)
    r = a.record_counts().collect()[0]
    assert r["TOTAL_REGISTROS"] == 0 and r["PCT_CON_OBS"] is None
    prof = a.profile().collect()
    assert len(prof) == 54
    assert all(p["PCT_COMPLETITUD"] is None and p["CALIDAD_CAMPO"] is None for p in prof)
    assert a.detail().count() == 0
    assert a.top_fields().count() == 0


def test_generic_table_with_own_catalog(spark):
    from recordcheck.functions import validators as V2
    from recordcheck.operators import rules as R
    from recordcheck.plans.catalog_party import Catalog

    fields = ("ID", "EMAIL", "PHONE", "MANAGER")
    rules = (
        *(r for f in fields for r in (R.null_rule(f, "NULL", "ALTA"), R.blank_rule(f, "VACIO", "ALTA"))),
        R.required("ID", "ID_FALTANTE", "CAMP_OBLIGADO", "ALTA", "X1"),
        R.check("EMAIL", V2.email_invalid, "EMAIL_FORMATO_INVALIDO", "CAMP_OPC_CONDICIONAL", "MEDIA", "X2"),
        R.required_if_any("PHONE", ("MANAGER",), "PHONE_REQUERIDO_POR_MANAGER", "CAMP_CONDICIONAL", "ALTA", "X3"),
    )
    df = spark.createDataFrame([("1", "ana.rojas@x.bo", "77712345", None), ("2", "bad", None, "JEFE"),
                                (None, None, None, None)], "ID string, EMAIL string, PHONE string, MANAGER string")
    a = Audit(df, catalog=Catalog("contacts", fields, rules, ("X1", "X2", "X3")), record_id=("ID",))
    s = {r["ID"]: r for r in a.summary().collect()}
    assert s["1"]["CANT_TOTAL_OBS"] == 1                     # MANAGER null
    assert s["2"]["OBS_INCONSISTENCIAS"] == "EMAIL_FORMATO_INVALIDO"
    assert s["2"]["OBS_CONDICIONALES"] == "PHONE_REQUERIDO_POR_MANAGER"
    assert s[None]["CANT_NULL"] == 4 and s[None]["OBS_OBLIGADOS"] == "ID_FALTANTE"
    assert a.detail().count() == sum(r["CANT_TOTAL_OBS"] for r in s.values())
    assert a.profile().count() == 4
    assert a.report().select("ID").distinct().count() == 3
