"""Rule goldens: a clean record raises nothing; one change fires each family;
a NULL (non-numeric / missing) principal fires nothing."""

import pytest
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.operators.evaluate import evaluate
from recordcheck.plans.catalog_party import party_catalog, party_rules
from recordcheck.schema import FIELD_INDEX
from recordcheck.sources.fixtures import party_from_keys

FIRES = [
    ("R1", {"CODIGO": None}, "CODIGO", "CODIGO_NULL"),
    ("R2", {"CODIGO": "  "}, "CODIGO", "CODIGO_VACIO"),
    ("R3", {"PAF_ALTA": None}, "PAF_ALTA", "PAF_ALTA_FALTANTE"),
    ("R4", {"PAF_ALTA": "NO APLICA"}, "PAF_ALTA", "PAF_ALTA_PALABRA_INVALIDA"),
    ("R5", {"NIT": "123"}, "NIT", "NIT_FORMATO_INVALIDO"),
    ("R6", {"RAZON_SOCIAL": "QWERTY SA"}, "RAZON_SOCIAL", "RAZON_SOCIAL_TEXTO_INVALIDO"),
    ("R7", {"CARGO_ALTA_GERENCIA": None}, "IDENTIFICACION_CANT_INT_ALTA_GERENCIA",
     "IDENTIFICACION_CANT_INT_ALTA_GERENCIA_SIN_CARGO_ALTA_GERENCIA"),
    ("R8", {"NOMBRES_APELLIDOS_CARGO_GERENCIA": None}, "IDENTIFICACION_CANT_INT_ALTA_GERENCIA",
     "IDENTIFICACION_CANT_INT_ALTA_GERENCIA_SIN_NOMBRES_APELLIDOS"),
    ("R9", {"IDENTIFICACION_CANT_INT_ALTA_GERENCIA": "0"}, "CARGO_ALTA_GERENCIA",
     "CARGO_ALTA_GERENCIA_SIN_IDENTIFICACION_VALIDA"),
    ("R10", {"NOMBRES_APELLIDOS_CARGO_GERENCIA": " "}, "CARGO_ALTA_GERENCIA",
     "CARGO_ALTA_GERENCIA_SIN_NOMBRES_APELLIDOS"),
    ("R11", {"IDENTIFICACION_CANT_INT_ALTA_GERENCIA": None}, "NOMBRES_APELLIDOS_CARGO_GERENCIA",
     "NOMBRES_APELLIDOS_SIN_IDENTIFICACION_VALIDA"),
    ("R12", {"CARGO_ALTA_GERENCIA": None}, "NOMBRES_APELLIDOS_CARGO_GERENCIA", "NOMBRES_APELLIDOS_SIN_CARGO"),
    ("R13", {"TIPO_DOC_ID": None}, "TIPO_DOC_ID", "TIPO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS"),
    ("R14", {"NRO_DOC_ID": " "}, "NRO_DOC_ID", "NRO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS"),
    ("R15", {"PROFESION_REP_LEGAL": None}, "PROFESION_REP_LEGAL",
     "PROFESION_REP_LEGAL_REQUERIDO_POR_CODIGO_REP_LEGAL"),
    ("R16", {"ESTADO_CIVIL_REP_LEGAL": "Casada", "NOMBRE_CONYUGE_REP_LEGAL": None}, "NOMBRE_CONYUGE_REP_LEGAL",
     "NOMBRE_CONYUGE_REQUERIDO_POR_ESTADO_CIVIL"),
    ("R17", {"DOMICILIO": "12"}, "DOMICILIO", "DOMICILIO_INVALIDO"),
    ("R18", {"DOMICILIO_PARTICULAR_REP_LEGAL": "CASA"}, "DOMICILIO_PARTICULAR_REP_LEGAL",
     "DOMICILIO_PARTICULAR_INVALIDO"),
    ("R19", {"FECHA_ULTIMA_TRANSACCION": None}, "FECHA_ULTIMA_TRANSACCION", "FECHA_ULT_TRANS_REQUERIDA"),
    ("R20", {"TIPO_CUENTA_ULTIMA_TRANSACCION": None}, "TIPO_CUENTA_ULTIMA_TRANSACCION",
     "TIPO_CUENTA_ULT_TRANS_REQUERIDA"),
    ("R21", {"CANAL_ATENCION_ULT_TRANS": None}, "CANAL_ATENCION_ULT_TRANS", "CANAL_ULT_TRANS_REQUERIDO"),
    ("R22", {"CORREO_ELECTRONICO_REP_LEGAL": "ab@acme"}, "CORREO_ELECTRONICO_REP_LEGAL", "EMAIL_FORMATO_INVALIDO"),
    ("R23", {"TELEFONO_REP_LEGAL": "123"}, "TELEFONO_REP_LEGAL", "TELEFONO_INVALIDO"),
    ("R24", {"TELEFONO": "77777777"}, "TELEFONO", "TELEFONO_INVALIDO"),
    ("R25", {"CODIGO_REP_LEGAL": None}, "CODIGO_REP_LEGAL", "CODIGO_REP_LEGAL_REQUERIDO"),
    ("R26", {"REFERENCIAS_PERS_REP_LEGAL": None, "REFERENCIAS_COM_REP_LEGAL": " ",
             "REFERENCIAS_BANCARIAS_REP_LEGAL": None}, "REFERENCIAS_PERS_REP_LEGAL",
     "AL_MENOS_UNA_REFERENCIA_REQUERIDA"),
    ("R27", {"CANTIDAD_ACTUALIZACIONES": "1"}, "CANTIDAD_ACTUALIZACIONES", "CANT_ACTUALIZACIONES_DEBE_SER_MAYOR_1"),
    ("R28", {"EXT_DOC_ID": "LP"}, "EXT_DOC_ID", "EXT_DOC_ID_TEXTO_INVALIDO"),
]

SILENT = [  # (family, overrides): the family must not fire
    ("R7", {"IDENTIFICACION_CANT_INT_ALTA_GERENCIA": "abc", "CARGO_ALTA_GERENCIA": None}),
    ("R9", {"IDENTIFICACION_CANT_INT_ALTA_GERENCIA": "abc"}),
    ("R11", {"IDENTIFICACION_CANT_INT_ALTA_GERENCIA": "abc"}),
    ("R27", {"CANTIDAD_ACTUALIZACIONES": "abc"}),
    ("R16", {"ESTADO_CIVIL_REP_LEGAL": None, "NOMBRE_CONYUGE_REP_LEGAL": None}),
    ("R25", {"NOMBRE_REP_LEGAL": None, "CODIGO_REP_LEGAL": None}),
    ("R19", {"FECHA_ULTIMA_TRANSACCION": None, "TIPO_CUENTA_ULTIMA_TRANSACCION": None,
             "CANAL_ATENCION_ULT_TRANS": None}),
    ("R26", {"CODIGO_REP_LEGAL": None, "REFERENCIAS_PERS_REP_LEGAL": None, "REFERENCIAS_COM_REP_LEGAL": None,
             "REFERENCIAS_BANCARIAS_REP_LEGAL": None}),
]


@pytest.fixture(scope="module")
def clean_row(spark):
    keys = spark.createDataFrame([(10,)], "key long")   # k % 10 == 0: every cell has its good value
    return party_from_keys(keys, "key", keep_key=None).collect()[0].asDict()


def observations_of(spark, rows):
    df = spark.createDataFrame([tuple(r[f] for f in K.FIELDS) for r in rows],
                               ", ".join(f"{f} string" for f in K.FIELDS))
    cat = party_catalog()
    ev = evaluate(df, cat.rules, cat.fields)
    return [[(o["idx"], o["campo"], o["motivo"]) for o in r[0]] for r in ev.select("OBS_ARRAY").collect()]


def test_catalog_has_171_rules_in_28_families():
    rules = party_rules()
    assert len(rules) == 171
    assert sorted({r.rule_id for r in rules}, key=lambda x: int(x[1:])) == [f"R{i}" for i in range(1, 29)]


def test_clean_record_has_no_observation(spark, clean_row):
    assert observations_of(spark, [clean_row]) == [[]]


def test_each_family_fires(spark, clean_row):
    rows = [{**clean_row, **over} for _, over, _, _ in FIRES]
    got = observations_of(spark, rows)
    for (fam, over, field, motivo), obs in zip(FIRES, got):
        assert (FIELD_INDEX[field], field, motivo) in obs, (fam, over, obs)


def test_null_principal_fires_nothing(spark, clean_row):
    cat = party_catalog()
    rows = [{**clean_row, **over} for _, over in SILENT]
    got = observations_of(spark, rows)
    for (fam, over), obs in zip(SILENT, got):
        motivos = {r.motivo for r in cat.rules if r.rule_id == fam}
        assert not motivos & {m for _, _, m in obs}, (fam, over, obs)


def test_empty_mandatory_gives_two_observations(spark, clean_row):
    (obs,) = observations_of(spark, [{**clean_row, "PAF_ALTA": "   "}])
    assert [m for _, c, m in obs if c == "PAF_ALTA"] == ["PAF_ALTA_VACIO", "PAF_ALTA_FALTANTE"]


def test_numeric_optional_always_flagged(spark, clean_row):
    (obs,) = observations_of(spark, [{**clean_row, "NUMERO_REGISTRO": "48205170"}])
    assert (15, "NUMERO_REGISTRO", "NUMERO_REGISTRO_TEXTO_INVALIDO") in obs


def test_array_order_is_rule_order(spark, clean_row):
    (obs,) = observations_of(spark, [{**clean_row, "NIT": None, "CODIGO": "  ", "EXT_DOC_ID": "LP"}])
    assert [m for _, _, m in obs] == ["CODIGO_VACIO", "NIT_NULL", "CODIGO_FALTANTE", "NIT_FALTANTE",
                                      "EXT_DOC_ID_TEXTO_INVALIDO"]


def test_missing_optional_column_skips_r28(spark, clean_row):
    cols = [f for f in K.FIELDS if f != "EXT_DOC_ID"]
    df = spark.createDataFrame([tuple(clean_row[f] for f in cols)], ", ".join(f"{f} string" for f in cols))
    cat = party_catalog(df.columns)
    assert len(cat.rules) == 171 - 3
    ev = evaluate(df, cat.rules, cat.fields)
    assert ev.select(F.size("OBS_ARRAY")).collect()[0][0] == 0


def test_describe_lists_every_rule(spark):
    d = party_catalog().describe(spark)
    assert d.count() == 171
    assert d.filter("regla = 'R28'").count() == 10


def test_unicode_case_option_for_placeholders(spark, clean_row):
    row = {**clean_row, "PAF_ALTA": "SIN INFORMACIÓN"}
    df = spark.createDataFrame([tuple(row[f] for f in K.FIELDS)], ", ".join(f"{f} string" for f in K.FIELDS))
    got = []
    for unicode_case in (False, True):
        cat = party_catalog(unicode_case=unicode_case)
        obs = evaluate(df, cat.rules, cat.fields).select("OBS_ARRAY").first()[0]
        got.append({o["motivo"] for o in obs})
    assert "PAF_ALTA_PALABRA_INVALIDA" not in got[0]
    assert "PAF_ALTA_PALABRA_INVALIDA" in got[1]


def test_a_cell_looks_at_its_state_once(spark):
    """The state of a cell was worked out up to three times, also for good cells."""
    from recordcheck.sources.fixtures import MOSTLY_NULL, NULL_TOGETHER, PARTY_VALUES, party_cell_sql

    ks = [None, *range(3000), 2 ** 40 + 7]
    keys = spark.createDataFrame([(k,) for k in ks], "k long")
    by_key = {r["k"]: r for r in party_from_keys(keys, "k").collect()}
    assert set(by_key) == set(ks)

    for i, (name, good, bad) in enumerate(PARTY_VALUES):
        assert party_cell_sql(i, good, bad).count("k div 7") == 1, name
        for k in ks[1:]:
            cell, dirty = by_key[k][name], k % 10 != 0 and (k + i) % (3, 7, 11)[i % 3] == 0
            state = (k // 7 + i) % 4
            if (name == MOSTLY_NULL and 1 <= k % 10 <= 7) or (name in NULL_TOGETHER and k % 40 == 13) or (dirty and state == 0):
                assert cell is None, (name, k)
            elif dirty and state in (1, 2):
                assert cell == {1: "   ", 2: "NO APLICA"}[state], (name, k)
            elif name == "CANTIDAD_ACTUALIZACIONES" and not dirty:
                assert cell == "3", k
    assert by_key[None]["CANTIDAD_ACTUALIZACIONES"] == "3" and by_key[None]["RAZON_SOCIAL"] == "EMPRESA ANDINA SRL"
