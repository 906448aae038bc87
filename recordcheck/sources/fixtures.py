"""The ``party`` test input: a 54-column, all-string table in the audited
schema, derived row by row from a driver table key (``customer.c_custkey`` or
``orders.o_orderkey``).

This only produces input rows.  The audit never looks at how a cell was made;
it must be right for any data of this schema.

Cell rule (test-input specification): for field index ``i`` the cell is
*dirty* when ``k % 10 <> 0 AND (k + i) % p = 0`` with ``p = [3, 7, 11][i % 3]``;
a dirty cell takes the state ``(k div 7 + i) % 4``: 0 NULL, 1 three spaces,
2 ``NO APLICA``, 3 one of the field's bad values, in turn over ``k div 28``.
Otherwise the good value.  The cells of one field (``MOSTLY_NULL``) are NULL
wherever ``k % 10`` is 1 to 7, those of three (``NULL_TOGETHER``) wherever ``k % 40``
is 13.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.functions.sql import lit

# FIXED VALUES (test input): (field, good value as SQL expression over k, bad value).
PARTY_VALUES = (
    ("CODIGO", "'C' || CAST(k AS STRING)", "XXXX"),
    ("FECHA_ULTIMA_TRANSACCION", "'15/03/2025'", "31/12/9999"),
    ("TIPO_CUENTA_ULTIMA_TRANSACCION", "'CAJA DE AHORRO'", "XXXX"),
    ("CANAL_ATENCION_ULT_TRANS", "'AGENCIA'", "XXXX"),
    ("RAZON_SOCIAL", "'EMPRESA ANDINA SRL'", "QWERTY SA"),
    ("TIPO_SOCIEDAD_COMERCIAL", "'RESPONSABILIDAD LIMITADA'", "XXXX"),
    ("CODIGO_ACTIVIDAD_ECONOMICA", "'46201'", "XXXX"),
    ("DESCRIPCION_ACTIVIDAD_ECONOMICA", "'VENTA AL POR MAYOR'", "XXXX"),
    ("IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "'2'", "0"),
    ("CARGO_ALTA_GERENCIA", "'GERENTE GENERAL'", "XXXX"),
    ("NOMBRES_APELLIDOS_CARGO_GERENCIA", "'JUAN PEREZ'", "XXXX"),
    ("TIPO_DOC_ID", "'CI'", "XXXX"),
    ("NRO_DOC_ID", "'4820517'", "XXXX"),
    ("EXT_DOC_ID", "'ORURO'", "LP"),
    ("NIT", "'4820517015'", "123"),
    ("NUMERO_REGISTRO", "'REGISTRO COMERCIAL'", "48205170"),
    ("DOMICILIO", "'AVENIDA AMERICA ZONA NORTE'", "12"),
    ("TELEFONO", "CAST(70000000 + k % 1000000 AS STRING)", "77777777"),
    ("REFERENCIAS_COMERCIALES", "'PROVEEDORA CENTRAL'", "XXXX"),
    ("CLASIFICACION_TIPO_RIESGO", "'MEDIO'", "ABABAB"),
    ("CODIGO_REP_LEGAL", "'R' || CAST(k AS STRING)", "XXXX"),
    ("NOMBRE_REP_LEGAL", "'ANA ROJAS'", "XXXX"),
    ("NACIONALIDAD_REP_LEGAL", "'BOLIVIANA'", "XXXX"),
    ("PAIS_RESIDENCIA_REP_LEGAL", "'BOLIVIA'", "XXXX"),
    ("TIPO_DOCUMENTO_IDENT_REP_LEGAL", "'CI'", "XXXX"),
    ("DOCUMENTO_IDENTIDAD_REP_LEGAL", "'5930628'", "XXXX"),
    ("EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL", "'ORURO'", "BCDF"),
    ("NIT_REP_LEGAL", "'EN PROCESO'", "4820517015"),
    ("FECHA_NACIMIENTO_REP_LEGAL", "'20/05/1980'", "XXXX"),
    ("ESTADO_CIVIL_REP_LEGAL", "CASE WHEN k % 2 = 0 THEN 'CASADO' ELSE 'SOLTERO' END", "XXXX"),
    ("NOMBRE_CONYUGE_REP_LEGAL", "'LUIS MAMANI'", "XXXX"),
    ("DOMICILIO_PARTICULAR_REP_LEGAL", "'CALLE SUCRE ZONA CENTRAL'", "12345678"),
    ("DOMICILIO_COMERCIAL_REP_LEGAL", "'CALLE COMERCIO ZONA SUR'", "ASDFGH"),
    ("TELEFONO_REP_LEGAL", "CAST(60000000 + k % 1000000 AS STRING)", "123"),
    ("CORREO_ELECTRONICO_REP_LEGAL", "'contacto.legal@empresa.bo'", "ab@acme"),
    ("PROFESION_REP_LEGAL", "'INGENIERO'", "XXXX"),
    ("CODIGO_ACTIVIDAD_ECO_REP_LEGAL", "'71100'", "XXXX"),
    ("DESC_ACTIVIDAD_ECO_REP_LEGAL", "'INGENIERIA CIVIL'", "XXXX"),
    ("LUGAR_TRABAJO_REP_LEGAL", "'EMPRESA ANDINA'", "XXXX"),
    ("CARGO_REP_LEGAL", "'GERENTE'", "XXXX"),
    ("FECHA_INGRESO_TRABAJO_REP_LEGAL", "'01/02/2015'", "31/02/2024"),
    ("MONEDA_NIVEL_INGRESOS_REP_LEGAL", "'BOLIVIANOS'", "XXXX"),
    ("NIVEL_INGRESOS_REP_LEGAL", "'12.500,50'", "-5"),
    ("NIVEL_INGRESOS_REP_LEGAL_SUS", "'1,796.05'", "abc"),
    ("FECHA_INGRESO_TRAB_REP_LEGAL", "'01/02/2015'", "00/00/0000"),
    ("REFERENCIAS_PERS_REP_LEGAL", "'MARIA QUISPE 70512234'", "BCDF"),
    ("REFERENCIAS_COM_REP_LEGAL", "'FERRETERIA SOLIZ 70512235'", "ABCABCABC"),
    ("REFERENCIAS_BANCARIAS_REP_LEGAL", "'BANCO COMERCIAL 2205512'", "12"),
    ("TIPO_RIESGO_REP_LEGAL", "'BAJO'", "XXXX"),
    ("PAF_ALTA", "'AGENCIA CENTRAL'", "XXXX"),
    ("FECHA_ALTA", "'10/01/2020'", "10/01/2026"),
    ("OPERACION_ASOCIADA_ALTA", "'APERTURA DE CUENTA'", "XXXX"),
    ("FECHA_ULTIMA_ACTUALIZACION", "'10/06/2025'", "01/01/1800"),
    ("CANTIDAD_ACTUALIZACIONES", "'3'", "1"),
)
# FIXED VALUES (test input): more bad values of some fields.
MORE_BAD = {
    "FECHA_ULTIMA_TRANSACCION": ("5/3/2024", " 15/03/2025", "15/03/2025 10:00", "05-03-2024", "31/02/2024"),
    "FECHA_NACIMIENTO_REP_LEGAL": ("15/03/25", "1/ 2/1980", "30/02/1980", "20/13/1980"),
    "FECHA_INGRESO_TRABAJO_REP_LEGAL": ("1/2/2015", "01/02/2015x", "2015-02-01"),
    "FECHA_INGRESO_TRAB_REP_LEGAL": ("9/9/2019", "32/01/2020"),
    "FECHA_ALTA": ("9/1/2020", "1/7/2025 08:30", "0/1/2020"),
    "FECHA_ULTIMA_ACTUALIZACION": ("1/1/2019", " 9/1/2020 ", "31/04/2025"),
    "RAZON_SOCIAL": ("AAAA SRL", "12345", "ABABAB", "BCDF", "REFVIAL SRL", "XX"),
    "NIT": ("48205170159", "4820-517011", "102030100"),
    "NRO_DOC_ID": ("1234567", "XXXXX"),
    "EXT_DOC_ID": ("OOOORURO",),
    "CLASIFICACION_TIPO_RIESGO": ("AAAALTO",),
    "EXP_DOCUMENTO_IDENTIDAD_REP_LEGAL": ("PPPPOTOSI",),
    "REFERENCIAS_PERS_REP_LEGAL": ("MMMMARIA 70512234",),
    "REFERENCIAS_COM_REP_LEGAL": ("FFFFERRETERIA",),
    "REFERENCIAS_BANCARIAS_REP_LEGAL": ("BBBBANCO 2205512",),
    "NUMERO_REGISTRO": ("RRRREGISTRO", "12345", "1111", "98x76", "5791"),
    "NIT_REP_LEGAL": ("NNNNIT", "123456789", "777777", "135791"),
    "TELEFONO": ("123", "12345678", "70-512-234"),
    "TELEFONO_REP_LEGAL": ("66666666", "9876543"),
    "DOMICILIO": ("12345678", "CALLE S/N", "CASA"),
    "DOMICILIO_COMERCIAL_REP_LEGAL": ("12", "CCCCALLE SUCRE"),
    "CORREO_ELECTRONICO_REP_LEGAL": ("12345@acme.bo", "aaaa.rojas@acme.bo", "ana rojas@acme.bo"),
    "NIVEL_INGRESOS_REP_LEGAL": ("350", "1.234,56", "1,234.56", "12,5", "1.234.567", ",", "-,5", "Bs 100-"),
    "NIVEL_INGRESOS_REP_LEGAL_SUS": ("900.5", "-1.5", "1.796,05", "-", ".", "--3", "2,500,000.75"),
    "IDENTIFICACION_CANT_INT_ALTA_GERENCIA": ("3.5", "-2", "dos", " 4 "),
    "CANTIDAD_ACTUALIZACIONES": ("0", "2.9", "x", "-1"),
    "LUGAR_TRABAJO_REP_LEGAL": ("TTTT SA", "ASDFGH"),
    "CARGO_REP_LEGAL": ("JEFEEEE", "BCDF"),
}
MOSTLY_NULL = "OPERACION_ASOCIADA_ALTA"
NULL_TOGETHER = ("REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL")
PERIODS = (3, 7, 11)
BLANK = "   "
PLACEHOLDER = "NO APLICA"
KEY_OF = {"customer": "c_custkey", "orders": "o_orderkey"}

assert tuple(f for f, _, _ in PARTY_VALUES) == K.FIELDS


def party_cell_sql(i: int, good: str, bad: str) -> str:
    """Expression text of field ``i`` over the key column ``k``."""
    name, p = PARTY_VALUES[i][0], PERIODS[i % 3]
    dirty = f"(k % 10 <> 0 AND (k + {i}) % {p} = 0)"
    state = f"((k div 7 + {i}) % 4)"
    bads = (bad, *MORE_BAD.get(name, ()))
    # The lambda keeps the 54 cells out of one fused method (see ``functions.sql.unfused``).
    at = f"element_at(transform(array((k div 28) % {len(bads)}), _v -> _v), 1)"
    turn = f"element_at(array({', '.join(map(lit, bads))}), CAST({at} + 1 AS INT))"
    missing = (["k % 10 BETWEEN 1 AND 7"] if name == MOSTLY_NULL else []) + (["k % 40 = 13"] if name in NULL_TOGETHER else [])
    always = f"WHEN {' OR '.join(missing)} THEN CAST(NULL AS STRING) " if missing else ""
    # Most cells are good: the state is looked at in dirty ones only.
    return (f"CASE {always}WHEN {dirty} THEN CASE {state} WHEN 0 THEN CAST(NULL AS STRING) "
            f"WHEN 1 THEN {lit(BLANK)} WHEN 2 THEN {lit(PLACEHOLDER)} ELSE {turn} END ELSE {good} END")


def party_from_keys(keys: DataFrame, key_col: str, keep_key: str | None = "k") -> DataFrame:
    """Build the party table from any DataFrame with an integral key column.

    One narrow projection; partitioning follows the source scan.
    """
    base = keys.select(F.col(key_col).cast("bigint").alias("k"))
    cols = [f"{party_cell_sql(i, good, bad)} AS {name}" for i, (name, good, bad) in enumerate(PARTY_VALUES)]
    out = base.selectExpr(*(["k"] if keep_key else []), *cols)
    if keep_key and keep_key != "k":
        out = out.withColumnRenamed("k", keep_key)
    return out


def party(spark, sf_dir: str, source: str = "orders", keep_key: str | None = "k", tasks: int | None = None) -> DataFrame:
    """``party`` built from ``{sf_dir}/{source}.parquet`` (reads only the key column).

    A scan task takes whole row groups, and one of a few MB may hold a million keys;
    ``tasks`` deals the keys round-robin to so many tasks before any cell is made."""
    from recordcheck.sources.tables import read_table

    keys = read_table(spark, sf_dir, source).select(KEY_OF[source])
    return party_from_keys(keys.repartition(tasks) if tasks else keys, KEY_OF[source], keep_key)
