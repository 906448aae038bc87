"""Independent DuckDB SQL for every registered query.

Written against the specification, not generated from the Spark rule
catalogue: its own SQL predicates, one ``UNION ALL`` branch per rule instance
and ``string_agg ... ORDER BY`` for the lists.  Its field, word and run lists are
its own (``oracle.spec``); shared with the Spark side are only the ``party``
test-input values.

DuckDB's regex engine (RE2) has no back-references or look-around, and its
``(?i)`` folds Unicode while Java's folds ASCII only, so those checks are
spelled out here (positional comparisons, explicit character classes).
"""

from __future__ import annotations

from oracle import spec as K
from recordcheck.sources.fixtures import BLANK, MORE_BAD, MOSTLY_NULL, NULL_TOGETHER, PARTY_VALUES, PERIODS, PLACEHOLDER

FIELDS = list(K.FIELDS)
IDX = {f: i for i, f in enumerate(FIELDS)}
LT = r"[\n\r\x{85}\x{2028}\x{2029}]"        # Java line terminators
WORD = r"[\p{L}\p{Nd}\p{Mn}_]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ascii_fold(word: str) -> str:
    """RE2 pattern matching ``word`` with ASCII-only case folding."""
    out = []
    for ch in word:
        if ch.isascii() and ch.isalpha():
            out.append(f"[{ch.lower()}{ch.upper()}]")
        elif ch.isalnum() or ch == " ":
            out.append(ch)
        else:
            out.append("\\" + ch if ch in r".^$*+?()[]{}|\/-" else ch)
    return "".join(out)


PLACEHOLDER_RE2 = (f"(^|[^{WORD[1:-1]}])(" + "|".join(ascii_fold(w) for w in K.PLACEHOLDER_WORDS)
                   + f")($|[^{WORD[1:-1]}])")


# ---------------------------------------------------------------------------
# Input: the party table
# ---------------------------------------------------------------------------

def party_select(source: str = "orders") -> str:
    key = {"orders": "o_orderkey", "customer": "c_custkey"}[source]
    cols = ["k"]
    for i, (name, good, bad) in enumerate(PARTY_VALUES):
        p = PERIODS[i % 3]
        dirty = f"(k % 10 <> 0 AND (k + {i}) % {p} = 0)"
        st = f"((k // 7 + {i}) % 4)"
        bads = [bad, *MORE_BAD.get(name, ())]
        turn = f"[{', '.join(map(q, bads))}][(k // 28) % {len(bads)} + 1]"
        null = f"{dirty} AND {st} = 0" + (" OR k % 10 BETWEEN 1 AND 7" if name == MOSTLY_NULL else "")
        null += " OR k % 40 = 13" if name in NULL_TOGETHER else ""
        cols.append(
            f"CASE WHEN {null} THEN NULL "
            f"WHEN {dirty} AND {st} = 1 THEN {q(BLANK)} "
            f"WHEN {dirty} AND {st} = 2 THEN {q(PLACEHOLDER)} "
            f"WHEN {dirty} THEN {turn} ELSE {good} END AS {name}")
    return (f"SELECT {', '.join(cols)} FROM (SELECT CAST({key} AS BIGINT) AS k FROM {source})")


# ---------------------------------------------------------------------------
# SQL predicates (text -> boolean)
# ---------------------------------------------------------------------------

def is_null(c): return f"({c} IS NULL)"
def is_blank(c): return f"({c} IS NOT NULL AND trim({c}, ' ') = '')"
def empty(c): return f"(coalesce(trim({c}, ' '), '') = '')"
def filled(c): return f"(coalesce(trim({c}, ' '), '') <> '')"
def digits(c): return f"regexp_replace({c}, '[^0-9]', '', 'g')"


def placeholder(c):
    return f"coalesce(regexp_matches({c}, {q(PLACEHOLDER_RE2)}), false)"


def run4(s, case_fold=False):
    """Some character (not a line terminator) 4 times in a row."""
    v = f"lower({s})" if case_fold else s
    return (f"(len(list_filter(range(1, length({v}) - 2), lambda i: "
            f"substr({v}, i, 1) = substr({v}, i + 1, 1) AND substr({v}, i, 1) = substr({v}, i + 2, 1) "
            f"AND substr({v}, i, 1) = substr({v}, i + 3, 1) "
            f"AND NOT regexp_matches(substr({v}, i, 1), {q(LT)}))) > 0)")


def email_invalid(c):
    shape = q(r"^[A-Za-z0-9._%+\-]{3,}@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}(\r\n|" + LT + r")?$")
    return (f"(CASE WHEN {empty(c)} THEN false WHEN NOT regexp_matches({c}, {shape}) THEN true "
            f"ELSE {run4(c, case_fold=True)} OR regexp_matches({c}, '^[0-9]+@') END)")


def phone_invalid(c):
    d = digits(c)
    return (f"(CASE WHEN {empty(c)} THEN false ELSE length({d}) < 7 OR length({d}) > 8 "
            f"OR (length({d}) >= 2 AND {d} = repeat(left({d}, 1), length({d}))) END)")


def nit_invalid(c):
    d = digits(c)
    return (f"({filled(c)} AND (length({d}) < 8 OR NOT regexp_matches({d}, '(01|02|03|04)[1-9]$') "
            f"OR length({d}) <> length(regexp_replace({c}, '[ \\t\\n\\x0B\\f\\r]+', '', 'g'))))")


def address_invalid(c, min_len=5):
    t = f"trim({c}, ' ')"
    return (f"({filled(c)} AND (length({t}) < {min_len} "
            f"OR length(regexp_replace({t}, '[0-9]', '', 'g')) = 0 OR {placeholder(c)}))")


def unit_repeat(s):
    """Whole text is a 1..3 char [A-Z0-9] unit repeated 3+ times (a final line
    terminator allowed, as Java's ``$`` allows)."""
    t = f"regexp_replace({s}, {q('(\\r\\n|' + LT + ')$')}, '')"
    parts = [f"(length({t}) % {k} = 0 AND length({t}) >= {3 * k} "
             f"AND regexp_full_match(left({t}, {k}), '[A-Z0-9]+') "
             f"AND {t} = repeat(left({t}, {k}), length({t}) // {k}))" for k in (1, 2, 3)]
    return "(" + " OR ".join(parts) + ")"


def full_upper(c):
    """Upper case with the two-letter form of the sharp s, as Java gives it."""
    return f"upper(replace(trim({c}, ' '), 'ß', 'ss'))"


def text_invalid(c, min_len=3, runs=K.KEYBOARD_RUNS, four=None):
    s = full_upper(c)
    letters = f"regexp_replace({s}, '[^{K.LETTERS_CLASS}]', '', 'g')"
    kb = " OR ".join(f"contains({s}, {q(r)})" for r in runs)
    return (f"({filled(c)} AND (length(trim({c}, ' ')) < {min_len} "
            f"OR length(regexp_replace({c}, '[0-9]', '', 'g')) = 0 "
            f"OR {four or run4(s)} OR {unit_repeat(s)} OR {kb} "
            f"OR (length({letters}) >= 3 AND NOT regexp_matches({letters}, '[{K.VOWELS_CLASS}]')) "
            f"OR {placeholder(c)}))")


def legacy_int(c):
    """Non-ANSI text-to-int: edge control chars ignored, fraction truncated."""
    t = f"regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    sign = f"regexp_extract({t}, '^([+-]?)', 1)"
    ds = f"regexp_extract({t}, '^[+-]?([0-9]*)', 1)"
    return (f"(CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]*)') "
            f"THEN TRY_CAST({sign} || CASE WHEN {ds} = '' THEN '0' ELSE {ds} END AS INTEGER) END)")


def is_pos_int(c):
    return f"({filled(c)} AND {legacy_int(c)} > 0)"


MARRIED = "(" + "|".join(ascii_fold(w) for w in ("casad", "concubin")) + ")"


# ---------------------------------------------------------------------------
# The rules: (family, field, motivo, tipo, severidad, condition)
# ---------------------------------------------------------------------------

def rules() -> list[tuple[str, str, str, str, str, str]]:
    T_OB, T_CO, T_OC, T_OP = "CAMP_OBLIGADO", "CAMP_CONDICIONAL", "CAMP_OPC_CONDICIONAL", "CAMP_OPCIONAL"
    out = []
    for f in FIELDS:
        out.append(("R1", f, f"{f}_NULL", "NULL", "ALTA", is_null(f)))
        out.append(("R2", f, f"{f}_VACIO", "VACIO", "ALTA", is_blank(f)))
    for f in K.MANDATORY:
        out.append(("R3", f, f"{f}_FALTANTE", T_OB, "ALTA", empty(f)))
        out.append(("R4", f, f"{f}_PALABRA_INVALIDA", T_OB, "ALTA", f"({filled(f)} AND {placeholder(f)})"))
    out.append(("R5", "NIT", "NIT_FORMATO_INVALIDO", T_OB, "ALTA", nit_invalid("NIT")))
    out.append(("R6", "RAZON_SOCIAL", "RAZON_SOCIAL_TEXTO_INVALIDO", T_OB, "ALTA", text_invalid("RAZON_SOCIAL")))
    f8, f9, f10 = "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CARGO_ALTA_GERENCIA", "NOMBRES_APELLIDOS_CARGO_GERENCIA"
    pos8 = is_pos_int(f8)
    no8 = f"({empty(f8)} OR NOT {pos8})"
    out += [
        ("R7", f8, f"{f8}_SIN_{f9}", T_CO, "ALTA", f"({filled(f8)} AND {pos8} AND {empty(f9)})"),
        ("R8", f8, f"{f8}_SIN_NOMBRES_APELLIDOS", T_CO, "ALTA", f"({filled(f8)} AND {pos8} AND {empty(f10)})"),
        ("R9", f9, f"{f9}_SIN_IDENTIFICACION_VALIDA", T_CO, "ALTA", f"({filled(f9)} AND {no8})"),
        ("R10", f9, f"{f9}_SIN_NOMBRES_APELLIDOS", T_CO, "ALTA", f"({filled(f9)} AND {empty(f10)})"),
        ("R11", f10, "NOMBRES_APELLIDOS_SIN_IDENTIFICACION_VALIDA", T_CO, "ALTA", f"({filled(f10)} AND {no8})"),
        ("R12", f10, "NOMBRES_APELLIDOS_SIN_CARGO", T_CO, "ALTA", f"({filled(f10)} AND {empty(f9)})"),
        ("R13", "TIPO_DOC_ID", "TIPO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS", T_CO, "ALTA",
         f"({filled(f10)} AND {empty('TIPO_DOC_ID')})"),
        ("R14", "NRO_DOC_ID", "NRO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS", T_CO, "ALTA",
         f"({filled(f10)} AND {empty('NRO_DOC_ID')})"),
    ]
    for f in K.REP_LEGAL_DEPENDENTS:
        out.append(("R15", f, f"{f}_REQUERIDO_POR_CODIGO_REP_LEGAL", T_CO, "ALTA",
                    f"({filled('CODIGO_REP_LEGAL')} AND {empty(f)})"))
    ec = "ESTADO_CIVIL_REP_LEGAL"
    out.append(("R16", "NOMBRE_CONYUGE_REP_LEGAL", "NOMBRE_CONYUGE_REQUERIDO_POR_ESTADO_CIVIL", T_CO, "ALTA",
                f"({filled(ec)} AND regexp_matches({ec}, {q(MARRIED)}) AND {empty('NOMBRE_CONYUGE_REP_LEGAL')})"))
    out.append(("R17", "DOMICILIO", "DOMICILIO_INVALIDO", T_CO, "MEDIA", address_invalid("DOMICILIO")))
    out.append(("R18", "DOMICILIO_PARTICULAR_REP_LEGAL", "DOMICILIO_PARTICULAR_INVALIDO", T_CO, "MEDIA",
                address_invalid("DOMICILIO_PARTICULAR_REP_LEGAL")))
    t1, t2, t3 = "FECHA_ULTIMA_TRANSACCION", "TIPO_CUENTA_ULTIMA_TRANSACCION", "CANAL_ATENCION_ULT_TRANS"
    out += [
        ("R19", t1, "FECHA_ULT_TRANS_REQUERIDA", T_OC, "MEDIA", f"(({filled(t2)} OR {filled(t3)}) AND {empty(t1)})"),
        ("R20", t2, "TIPO_CUENTA_ULT_TRANS_REQUERIDA", T_OC, "MEDIA", f"(({filled(t1)} OR {filled(t3)}) AND {empty(t2)})"),
        ("R21", t3, "CANAL_ULT_TRANS_REQUERIDO", T_OC, "MEDIA", f"(({filled(t1)} OR {filled(t2)}) AND {empty(t3)})"),
        ("R22", "CORREO_ELECTRONICO_REP_LEGAL", "EMAIL_FORMATO_INVALIDO", T_OC, "MEDIA",
         email_invalid("CORREO_ELECTRONICO_REP_LEGAL")),
        ("R23", "TELEFONO_REP_LEGAL", "TELEFONO_INVALIDO", T_OC, "MEDIA", phone_invalid("TELEFONO_REP_LEGAL")),
        ("R24", "TELEFONO", "TELEFONO_INVALIDO", T_OC, "MEDIA", phone_invalid("TELEFONO")),
        ("R25", "CODIGO_REP_LEGAL", "CODIGO_REP_LEGAL_REQUERIDO", T_OC, "MEDIA",
         f"({filled('NOMBRE_REP_LEGAL')} AND {empty('CODIGO_REP_LEGAL')})"),
        ("R26", "REFERENCIAS_PERS_REP_LEGAL", "AL_MENOS_UNA_REFERENCIA_REQUERIDA", T_OC, "MEDIA",
         f"({filled('CODIGO_REP_LEGAL')} AND {empty('REFERENCIAS_PERS_REP_LEGAL')} "
         f"AND {empty('REFERENCIAS_COM_REP_LEGAL')} AND {empty('REFERENCIAS_BANCARIAS_REP_LEGAL')})"),
        ("R27", "CANTIDAD_ACTUALIZACIONES", "CANT_ACTUALIZACIONES_DEBE_SER_MAYOR_1", T_OC, "BAJA",
         f"({filled('FECHA_ULTIMA_ACTUALIZACION')} AND ({empty('CANTIDAD_ACTUALIZACIONES')} "
         f"OR {legacy_int('CANTIDAD_ACTUALIZACIONES')} <= 1))"),
    ]
    for f in K.OPTIONAL:
        out.append(("R28", f, f"{f}_TEXTO_INVALIDO", T_OP, "BAJA",
                    f"({filled(f)} AND ({text_invalid(f)} OR {placeholder(f)}))"))
    return out


def obs_union(families=None) -> str:
    """One row per fired rule: (k, ord, idx, campo, motivo, tipo, sev)."""
    parts = []
    for n, (fam, f, motivo, tipo, sev, cond) in enumerate(rules()):
        if families is not None and fam not in families:
            continue
        parts.append(f"SELECT k, {n} AS ord, CAST({IDX[f]} AS INTEGER) AS idx, {q(f)} AS campo, "
                     f"{q(motivo)} AS motivo, {q(tipo)} AS tipo, {q(sev)} AS sev FROM party WHERE {cond}")
    return "\nUNION ALL\n".join(parts)


def with_party(body: str, families=None, source: str = "orders", need_obs: bool = True,
               extra: tuple[str, ...] = ()) -> str:
    ctes = [f"party AS MATERIALIZED ({party_select(source)})"]
    if need_obs:
        ctes.append(f"obs AS MATERIALIZED ({obs_union(families)})")
    ctes.extend(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------------------
# Query bodies
# ---------------------------------------------------------------------------

def obs_rows(families) -> str:
    return with_party(
        "SELECT k, idx AS IDX_CAMPO, campo AS CAMPO, tipo AS TIPO_VERIFICACION, sev AS SEVERIDAD, "
        "motivo AS DESCRIPCION FROM obs", families)


SUMMARY_BODY = """
SELECT p.k, p.CODIGO, p.RAZON_SOCIAL, p.NIT,
  CAST(count(o.k) FILTER (WHERE o.tipo = 'NULL') AS BIGINT) AS CANT_NULL,
  CAST(count(o.k) FILTER (WHERE o.tipo = 'VACIO') AS BIGINT) AS CANT_VACIO,
  CAST(count(o.k) FILTER (WHERE o.tipo = 'CAMP_OBLIGADO') AS BIGINT) AS CANT_OBLIGADOS_FALTANTES,
  CAST(count(o.k) FILTER (WHERE o.tipo = 'CAMP_CONDICIONAL') AS BIGINT) AS CANT_CONDICIONALES_FALTANTES,
  CAST(count(o.k) FILTER (WHERE o.tipo = 'CAMP_OPC_CONDICIONAL') AS BIGINT) AS CANT_OPC_CONDICIONALES_FALTANTES,
  CAST(count(o.k) FILTER (WHERE o.tipo = 'CAMP_OPCIONAL') AS BIGINT) AS CANT_INCONSISTENCIAS_DATOS,
  CAST(count(o.k) AS BIGINT) AS CANT_TOTAL_OBS,
  coalesce(string_agg(CASE WHEN o.tipo IN ('NULL', 'VACIO') THEN o.campo || '_' || lower(o.tipo) END, ', ' ORDER BY o.ord), '') AS OBS_CAMPOS_NULL_VACIO,
  coalesce(string_agg(CASE WHEN o.tipo = 'CAMP_OBLIGADO' THEN o.motivo END, ', ' ORDER BY o.ord), '') AS OBS_OBLIGADOS,
  coalesce(string_agg(CASE WHEN o.tipo = 'CAMP_CONDICIONAL' THEN o.motivo END, ', ' ORDER BY o.ord), '') AS OBS_CONDICIONALES,
  coalesce(string_agg(CASE WHEN o.tipo IN ('CAMP_OPC_CONDICIONAL', 'CAMP_OPCIONAL') THEN o.motivo END, ', ' ORDER BY o.ord), '') AS OBS_INCONSISTENCIAS
FROM party p LEFT JOIN obs o ON o.k = p.k
GROUP BY p.k, p.CODIGO, p.RAZON_SOCIAL, p.NIT
"""


def summary_sql(where: str | None = None, source: str = "orders") -> str:
    body = "SELECT * FROM summary" + (f" WHERE {where}" if where else "")
    return with_party(body, source=source, extra=(f"summary AS ({SUMMARY_BODY})",))


DESCRIPCION_SQL = """CASE
  WHEN o.tipo = 'NULL' THEN o.campo || '_null'
  WHEN o.tipo = 'VACIO' THEN o.campo || '_vacio'
  WHEN o.tipo = 'CAMP_OBLIGADO' THEN CASE
    WHEN contains(o.motivo, 'PALABRA_INVALIDA') THEN 'Contiene palabras no permitidas'
    WHEN contains(o.motivo, 'FALTANTE') THEN 'Campo obligatorio sin datos'
    WHEN contains(o.motivo, 'FORMATO_INVALIDO') THEN 'Formato inválido'
    WHEN contains(o.motivo, 'TEXTO_INVALIDO') THEN 'Texto con caracteres o patrones inválidos'
    ELSE o.motivo END
  WHEN o.tipo = 'CAMP_CONDICIONAL' THEN CASE
    WHEN contains(o.motivo, 'REQUERIDO_POR') THEN replace(o.motivo, '_REQUERIDO_POR_', ' requiere ')
    WHEN contains(o.motivo, 'SIN_') THEN CASE WHEN contains(o.motivo, '_SIN_')
      THEN 'Requiere ' || regexp_extract(o.motivo, '^.*_SIN_(.*)$', 1) ELSE o.motivo END
    WHEN contains(o.motivo, '_DEPENDE_DE_') THEN 'Requiere ' || regexp_extract(o.motivo, '^.*_DEPENDE_DE_(.*)$', 1)
    ELSE o.motivo END
  WHEN o.tipo = 'CAMP_OPC_CONDICIONAL' THEN CASE
    WHEN contains(o.motivo, 'EMAIL') THEN 'Email inválido'
    WHEN contains(o.motivo, 'TELEFONO') THEN 'Teléfono inválido'
    WHEN contains(o.motivo, 'FORMATO') THEN 'Formato inválido'
    WHEN contains(o.motivo, 'REQUERIDO') THEN CASE WHEN contains(o.motivo, '_REQUERIDO')
      THEN regexp_extract(o.motivo, '^(.*?)_REQUERIDO', 1) || ' es requerido' ELSE o.motivo END
    ELSE o.motivo END
  WHEN o.tipo = 'CAMP_OPCIONAL' THEN CASE
    WHEN contains(o.motivo, 'TEXTO_INVALIDO') THEN 'Texto con inconsistencias'
    ELSE o.motivo END
  ELSE o.motivo END"""

REGLA_SQL = """CASE o.tipo WHEN 'NULL' THEN 'NULL' WHEN 'VACIO' THEN 'VACIO'
  WHEN 'CAMP_OBLIGADO' THEN 'OBLIGATORIO' WHEN 'CAMP_CONDICIONAL' THEN 'DEPENDE_DE'
  WHEN 'CAMP_OPC_CONDICIONAL' THEN 'FORMATO' WHEN 'CAMP_OPCIONAL' THEN 'INCONSISTENCIA' ELSE 'OTRO' END"""


def detail_sql(where: str | None = None) -> str:
    return with_party(
        "SELECT p.k, p.CODIGO, p.RAZON_SOCIAL, p.NIT, o.idx AS IDX_CAMPO, o.campo AS CAMPO, "
        "o.tipo AS TIPO_VERIFICACION, o.sev AS SEVERIDAD, o.motivo AS DESCRIPCION "
        "FROM obs o JOIN party p ON p.k = o.k" + (f" WHERE {where}" if where else ""))


def report_sql(where: str | None = None) -> str:
    return with_party(
        "SELECT * FROM (SELECT p.k, p.CODIGO, o.idx AS IDX_CAMPO, o.campo AS CAMPO, "
        f"o.tipo AS TIPO_VERIFICACION, {REGLA_SQL} AS REGLA, {DESCRIPCION_SQL} AS DESCRIPCION "
        "FROM obs o JOIN party p ON p.k = o.k)" + (f" WHERE {where}" if where else ""))


def totals_sql() -> str:
    return summary_sql().replace("SELECT * FROM summary", """SELECT
  CAST(sum(CANT_NULL) AS BIGINT) AS TOTAL_NULL, CAST(sum(CANT_VACIO) AS BIGINT) AS TOTAL_VACIO,
  CAST(sum(CANT_OBLIGADOS_FALTANTES) AS BIGINT) AS TOTAL_OBLIGADOS,
  CAST(sum(CANT_CONDICIONALES_FALTANTES) AS BIGINT) AS TOTAL_CONDICIONALES,
  CAST(sum(CANT_OPC_CONDICIONALES_FALTANTES) AS BIGINT) AS TOTAL_OPC_CONDICIONALES,
  CAST(sum(CANT_INCONSISTENCIAS_DATOS) AS BIGINT) AS TOTAL_INCONSISTENCIAS,
  CAST(sum(CANT_TOTAL_OBS) AS BIGINT) AS TOTAL_OBSERVACIONES FROM summary""")


def pct(part: str, whole: str) -> str:
    return (f"(CASE WHEN {whole} > 0 THEN CAST((20000 * ({part}) + {whole}) // (2 * {whole}) AS DOUBLE) / 100.0 END)")


def record_counts_sql() -> str:
    return summary_sql().replace("SELECT * FROM summary", f"""SELECT *, {pct('REGISTROS_CON_OBS', 'TOTAL_REGISTROS')} AS PCT_CON_OBS,
  {pct('REGISTROS_LIMPIOS', 'TOTAL_REGISTROS')} AS PCT_LIMPIOS FROM (SELECT
  count(*) AS TOTAL_REGISTROS, count(*) FILTER (WHERE CANT_TOTAL_OBS > 0) AS REGISTROS_CON_OBS,
  count(*) FILTER (WHERE CANT_TOTAL_OBS = 0) AS REGISTROS_LIMPIOS FROM summary)""")


def field_counts_sql(top: int | None = None) -> str:
    body = "SELECT campo AS CAMPO, count(*) AS count FROM obs GROUP BY campo"
    if top:
        body = f"SELECT * FROM ({body}) ORDER BY count DESC, CAMPO LIMIT {top}"
    return with_party(body)


def field_type_counts_sql() -> str:
    return with_party("SELECT campo AS CAMPO, tipo AS TIPO_VERIFICACION, count(*) AS count FROM obs GROUP BY campo, tipo")


def category(f: str) -> str:
    for members, label in K.CATEGORY_LABELS:
        if f in members:
            return label
    return "OPCIONAL"


def profile_sql(where: str | None = None, select: str = "*") -> str:
    rows = []
    for i, f in enumerate(FIELDS):
        ex = lambda cond: (f"(SELECT coalesce(string_agg(CODIGO, ', ' ORDER BY CODIGO), '') FROM "
                           f"(SELECT DISTINCT CODIGO FROM party WHERE {cond} AND trim(CODIGO, ' ') <> '' "
                           f"ORDER BY CODIGO LIMIT {K.EXAMPLE_CODES}))")
        rows.append(
            f"SELECT {q(f)} AS campo, {q(category(f))} AS CATEGORIA, count(*) AS n, "
            f"count(*) FILTER (WHERE {is_null(f)}) AS CANT_NULL, "
            f"count(*) FILTER (WHERE {is_blank(f)}) AS CANT_VACIO, "
            f"count(*) FILTER (WHERE {filled(f)} AND k IN (SELECT k FROM obs WHERE idx = {i} AND tipo NOT IN ('NULL', 'VACIO'))) AS CANT_INCONSISTENTES, "
            f"{ex(is_null(f))} AS CODIGOS_NULL_EJEMPLO, {ex(is_blank(f))} AS CODIGOS_VACIO_EJEMPLO FROM party")
    counts = "\nUNION ALL\n".join(rows)
    bands = " ".join(f"WHEN PCT_COMPLETITUD < {b} THEN {q(label)}" for b, label in K.QUALITY_BANDS)
    body = f"""SELECT {select} FROM (SELECT *, CASE WHEN PCT_COMPLETITUD IS NULL THEN NULL {bands} ELSE {q(K.QUALITY_TOP)} END AS CALIDAD_CAMPO
FROM (SELECT campo, CATEGORIA, CAST(CANT_NULL AS BIGINT) AS CANT_NULL, CAST(CANT_VACIO AS BIGINT) AS CANT_VACIO,
  CAST(CANT_INCONSISTENTES AS BIGINT) AS CANT_INCONSISTENTES,
  {pct('n - CANT_NULL - CANT_VACIO', 'n')} AS PCT_COMPLETITUD, {pct('CANT_NULL', 'n')} AS PCT_NULL,
  {pct('CANT_INCONSISTENTES', 'n')} AS PCT_INCONSISTENTE, CODIGOS_NULL_EJEMPLO, CODIGOS_VACIO_EJEMPLO
FROM ({counts})))""" + (f" WHERE {where}" if where else "")
    return with_party(body)


def category_avg_sql() -> str:
    inner = profile_sql()
    avg = lambda c: f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / count({c}) / 100.0"
    return (f"SELECT CATEGORIA, {avg('PCT_COMPLETITUD')} AS PCT_COMPLETITUD_PROMEDIO, "
            f"{avg('PCT_NULL')} AS PCT_NULL_PROMEDIO, {avg('PCT_INCONSISTENTE')} AS PCT_INCONSISTENTE_PROMEDIO "
            f"FROM ({inner}) GROUP BY CATEGORIA")


# ---------------------------------------------------------------------------
# Field-level parsers and validators
# ---------------------------------------------------------------------------

def upper_trim(c): return f"upper(trim({c}, ' '))"


def to_double_simple(c):
    return f"TRY_CAST(replace(regexp_replace({c}, '[^0-9.,\\-]', '', 'g'), ',', '.') AS DOUBLE)"


def to_double_locale(c):
    s = f"regexp_replace({c}, '[^0-9,.\\-]', '', 'g')"
    cm, dt = f"instr({s}, ',')", f"instr({s}, '.')"
    norm = (f"(CASE WHEN {cm} > 0 AND {dt} > 0 AND {dt} > {cm} THEN replace({s}, ',', '') "
            f"WHEN {cm} > 0 AND {dt} > 0 AND {cm} > {dt} THEN replace(replace({s}, '.', ''), ',', '.') "
            f"WHEN {cm} > 0 THEN replace({s}, ',', '.') ELSE {s} END)")
    # every '-' after the first character goes
    n1 = f"(left({norm}, 1) || replace(substr({norm}, 2), '-', ''))"
    # every '.' but the last goes
    last = f"(length({n1}) - instr(reverse({n1}), '.') + 1)"
    n2 = (f"(CASE WHEN length({n1}) - length(replace({n1}, '.', '')) > 1 "
          f"THEN replace(left({n1}, {last} - 1), '.', '') || substr({n1}, {last}) ELSE {n1} END)")
    n3 = f"(CASE WHEN {n2} IN ('-', '.') THEN '0' ELSE {n2} END)"
    return f"TRY_CAST({n3} AS DOUBLE)"


def numeric_sequence(c, min_len=4):
    d = digits(c)
    asc = "(" + "|".join(K.ASCENDING_RUNS) + ")"
    desc = "(" + "|".join(K.DESCENDING_RUNS) + ")"
    return (f"({filled(c)} AND length({d}) >= {min_len} AND ({d} = repeat(left({d}, 1), length({d})) "
            f"OR regexp_matches({d}, {q(asc)}) OR regexp_matches({d}, {q(desc)})))")


def repeated_letters(c, min_rep=4):
    s = full_upper(c)
    cmp = " AND ".join(f"substr({s}, i, 1) = substr({s}, i + {j}, 1)" for j in range(1, min_rep))
    return (f"({filled(c)} AND len(list_filter(range(1, length({s}) - {min_rep - 2}), lambda i: "
            f"{cmp} AND regexp_matches(substr({s}, i, 1), '[{K.LETTERS_CLASS}]'))) > 0)")


def parsed_date(c):
    """Day, month, year by splitting at the slashes: blanks before a number and
    anything after the year's digits do not count."""
    part = [f"string_split({c}, '/')[{i}]" for i in (1, 2, 3)]
    day, month = (f"ltrim({p}, {q(' ')} || chr(9))" for p in part[:2])
    year = f"regexp_extract(ltrim({part[2]}, {q(' ')} || chr(9)), '^[0-9]+')"
    ok = " AND ".join(f"regexp_full_match({n}, '[0-9]+')" for n in (day, month, year))
    y, m, d = (f"TRY_CAST({n} AS INTEGER)" for n in (year, month, day))
    return (f"(CASE WHEN {ok} AND {y} BETWEEN 1 AND 9999 AND {m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31 "
            f"THEN TRY_CAST(printf('%04d-%02d-%02d', {y}, {m}, {d}) AS DATE) END)")


def is_bad_date(c, as_of=K.DEFAULT_AS_OF):
    generic = ", ".join(q(g) for g in K.GENERIC_DATES)
    d = parsed_date(c)
    return (f"({empty(c)} OR coalesce({upper_trim(c)} IN ({generic}), false) OR {d} IS NULL "
            f"OR {d} > DATE {q(as_of)})")


DATE_FIELDS = ("FECHA_ULTIMA_TRANSACCION", "FECHA_NACIMIENTO_REP_LEGAL", "FECHA_INGRESO_TRABAJO_REP_LEGAL",
               "FECHA_INGRESO_TRAB_REP_LEGAL", "FECHA_ALTA", "FECHA_ULTIMA_ACTUALIZACION")


def field_checks_sql(exprs: dict[str, str]) -> str:
    cols = ", ".join(f"{e} AS {name}" for name, e in exprs.items())
    return with_party(f"SELECT k, {cols} FROM party", need_obs=False)


def numeric_text_sql() -> str:
    e = {"RAZON_SOCIAL_UPPER": upper_trim("RAZON_SOCIAL"), "NIT_DIGITOS": digits("NIT")}
    for f, tag in (("NIVEL_INGRESOS_REP_LEGAL", "ING"), ("NIVEL_INGRESOS_REP_LEGAL_SUS", "SUS")):
        e[f"{tag}_SIMPLE"] = to_double_simple(f)
        e[f"{tag}_LOCALE"] = to_double_locale(f)
        e[f"{tag}_NO_NEGATIVO"] = f"({filled(f)} AND {to_double_simple(f)} IS NOT NULL AND {to_double_simple(f)} >= 0.0)"
        e[f"{tag}_POSITIVO"] = f"({filled(f)} AND {to_double_locale(f)} IS NOT NULL AND {to_double_locale(f)} > 0.0)"
    e["CANT_GERENCIA_INT"] = legacy_int("IDENTIFICACION_CANT_INT_ALTA_GERENCIA")
    e["CANT_GERENCIA_POSITIVA"] = is_pos_int("IDENTIFICACION_CANT_INT_ALTA_GERENCIA")
    e["CANT_ACTUALIZACIONES_INT"] = legacy_int("CANTIDAD_ACTUALIZACIONES")
    return field_checks_sql(e)


def seq_repeat_sql() -> str:
    e = {}
    for f in ("NUMERO_REGISTRO", "NIT_REP_LEGAL", "TELEFONO", "TELEFONO_REP_LEGAL"):
        e[f"V7_{f}"] = numeric_sequence(f)
    for f in ("RAZON_SOCIAL",) + K.OPTIONAL[:6]:
        e[f"V8_{f}"] = repeated_letters(f)
        e[f"V9_{f}"] = f"({text_invalid(f)} OR {repeated_letters(f)})"
    for f in ("NUMERO_REGISTRO", "NIT_REP_LEGAL"):
        e[f"V10_{f}"] = numeric_sequence(f)
    return field_checks_sql(e)


def dates_sql() -> str:
    e = {}
    for f in DATE_FIELDS:
        e[f"{f}_FECHA"] = parsed_date(f)
        e[f"{f}_MALA"] = is_bad_date(f)
    return field_checks_sql(e)


def text_table_sql(table: str, keys: str) -> str:
    """Runs of four characters of long texts are found over their characters as
    rows, not by positions in the text."""
    same = "ch = lead(ch, 1) OVER w AND ch = lead(ch, 2) OVER w AND ch = lead(ch, 3) OVER w"
    return (f"WITH t AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM {table}), "
            f"c AS (SELECT rid, unnest(string_split({full_upper('text')}, '')) AS ch, "
            f"unnest(range(length({full_upper('text')}))) AS pos FROM t), "
            f"s AS (SELECT rid, ch, {same} AS same FROM c WINDOW w AS (PARTITION BY rid ORDER BY pos)), "
            f"r AS (SELECT rid, bool_or(same AND NOT regexp_matches(ch, {q(LT)})) AS run4, "
            f"bool_or(same AND regexp_matches(ch, '[{K.LETTERS_CLASS}]')) AS rep4 FROM s GROUP BY rid) "
            f"SELECT {keys}, {text_invalid('text', four='coalesce(run4, false)')} AS TEXTO_INVALIDO, "
            f"{text_invalid('text', runs=K.KEYBOARD_RUNS_DRAFT, four='coalesce(run4, false)')} AS TEXTO_INVALIDO_BORRADOR, "
            f"{numeric_sequence('text')} AS SECUENCIA_NUMERICA, ({filled('text')} AND coalesce(rep4, false)) AS LETRAS_REPETIDAS, "
            f"({filled('text')} AND {placeholder('text')}) AS TIENE_PALABRA_INVALIDA, {empty('text')} AS VACIO "
            f"FROM t LEFT JOIN r USING (rid)")


PIECES = "(SELECT doc_id, lang, unnest(regexp_split_to_array(text, '[ \\n]+')) AS pieza FROM documents)"


def pieces_email_sql() -> str:
    return f"SELECT doc_id, pieza, {email_invalid('pieza')} AS EMAIL_INVALIDO FROM {PIECES} WHERE contains(pieza, '@')"


def pieces_phone_sql() -> str:
    return (f"SELECT doc_id, pieza, {phone_invalid('pieza')} AS TELEFONO_INVALIDO, "
            f"{address_invalid('pieza')} AS DOMICILIO_INVALIDO FROM {PIECES} WHERE regexp_matches(pieza, '[0-9]')")


def placeholder_by_lang_sql() -> str:
    return (f"SELECT lang, count(*) AS PIEZAS, "
            f"count(*) FILTER (WHERE {filled('pieza')} AND {placeholder('pieza')}) AS CON_PALABRA_INVALIDA, "
            f"count(*) FILTER (WHERE {text_invalid('pieza')}) AS CON_TEXTO_INVALIDO FROM {PIECES} GROUP BY lang")


def documents_placeholder_sql() -> str:
    return f"SELECT doc_id, pieza, {filled('pieza')} AND {placeholder('pieza')} AS TIENE_PALABRA_INVALIDA FROM {PIECES}"


# Lines of the written table by what is done to them.
SHORT, LONG, BYTES = "k % 17 = 3", "k % 17 = 5", "k % 17 = 7"


def quarantine_sql() -> str:
    """Damaged lines: cut after 40 of the 55 fields, two fields more, a byte that is not UTF-8."""
    return with_party(f"""SELECT k, CASE WHEN {SHORT} THEN 'LINEA_CORTA' WHEN {LONG} THEN 'LINEA_LARGA' ELSE 'NO_DECODIFICABLE' END AS MOTIVO,
  CAST(CASE WHEN {SHORT} THEN 40 WHEN {LONG} THEN 57 ELSE 55 END AS BIGINT) AS CAMPOS
FROM party WHERE {SHORT} OR {LONG} OR {BYTES}""", need_obs=False)


def accepted_sql() -> str:
    return summary_sql(f"NOT ({SHORT} OR {LONG} OR {BYTES})")


def tx_required_all_sql() -> str:
    """Each of the three transaction fields, required when the other two are filled."""
    t = ("FECHA_ULTIMA_TRANSACCION", "TIPO_CUENTA_ULTIMA_TRANSACCION", "CANAL_ATENCION_ULT_TRANS")
    why = ("FECHA_ULT_TRANS_REQUERIDA", "TIPO_CUENTA_ULT_TRANS_REQUERIDA", "CANAL_ULT_TRANS_REQUERIDO")
    parts = []
    for f, motivo in zip(t, why):
        others = " AND ".join(filled(o) for o in t if o != f)
        parts.append(f"SELECT k, CAST({IDX[f]} AS INTEGER) AS IDX_CAMPO, '{f}' AS CAMPO, 'CAMP_OPC_CONDICIONAL' AS TIPO_VERIFICACION, "
                     f"'MEDIA' AS SEVERIDAD, '{motivo}' AS DESCRIPCION FROM party WHERE {others} AND {empty(f)}")
    return with_party("\nUNION ALL\n".join(parts), need_obs=False)


# ---------------------------------------------------------------------------
# Extended requirements (S families)
# ---------------------------------------------------------------------------

def ext_rules() -> list[tuple[str, str, str, str, str, str]]:
    OC, CO, OP = "CAMP_OPC_CONDICIONAL", "CAMP_CONDICIONAL", "CAMP_OPCIONAL"
    f8, f9, f10 = "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CARGO_ALTA_GERENCIA", "NOMBRES_APELLIDOS_CARGO_GERENCIA"
    num8 = to_double_locale(f8)
    out = [("S1", f8, f"{f8}_NO_NUMERICA", CO, "ALTA",
            f"({filled(f9)} AND {filled(f10)} AND NOT ({filled(f8)} AND {num8} IS NOT NULL AND {num8} > 0.0))"),
           ("S2", "ESTADO_CIVIL_REP_LEGAL", "ESTADO_CIVIL_REP_LEGAL_REQUERIDO_POR_NOMBRE_CONYUGE", CO, "ALTA",
            f"({filled('NOMBRE_CONYUGE_REP_LEGAL')} AND {empty('ESTADO_CIVIL_REP_LEGAL')})")]
    for f in ("LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL"):
        out.append(("S3", f, f"{f}_TEXTO_INCONSISTENTE", CO, "MEDIA",
                    f"({filled(f)} AND ({text_invalid(f)} OR {repeated_letters(f)}))"))
    tx = "FECHA_ULTIMA_TRANSACCION"
    out.append(("S4", tx, "FECHA_ULT_TRANS_FECHA_INVALIDA", OC, "MEDIA", f"({filled(tx)} AND {is_bad_date(tx)})"))
    for f in ("TIPO_DOCUMENTO_IDENT_REP_LEGAL", "DOCUMENTO_IDENTIDAD_REP_LEGAL", "FECHA_INGRESO_TRABAJO_REP_LEGAL",
              "MONEDA_NIVEL_INGRESOS_REP_LEGAL", "TIPO_RIESGO_REP_LEGAL"):
        out.append(("S5", f, f"{f}_REQUERIDO_POR_CODIGO_REP_LEGAL", OC, "MEDIA",
                    f"({filled('CODIGO_REP_LEGAL')} AND {empty(f)})"))
    job = "FECHA_INGRESO_TRABAJO_REP_LEGAL"
    out.append(("S6", job, f"{job}_FORMATO_FECHA_INVALIDO", OC, "MEDIA", f"({filled(job)} AND {parsed_date(job)} IS NULL)"))
    for f in ("REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL"):
        out.append(("S7", f, f"{f}_SIN_NOMBRE_Y_TELEFONO", OC, "BAJA",
                    f"({filled(f)} AND NOT (regexp_matches({f}, '[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]{{2,}}') "
                    f"AND regexp_matches({f}, '(^|[^0-9])[0-9]{{7,8}}([^0-9]|$)')))"))
    out.append(("S8", "FECHA_ULTIMA_ACTUALIZACION", "FECHA_ULTIMA_ACTUALIZACION_MENOR_A_FECHA_ALTA", OC, "MEDIA",
                f"({parsed_date('FECHA_ULTIMA_ACTUALIZACION')} < {parsed_date('FECHA_ALTA')})"))
    deps = " OR ".join(filled(d) for d in K.REP_LEGAL_DEPENDENTS)
    out.append(("S9", "CODIGO_REP_LEGAL", "CODIGO_REP_LEGAL_VACIO_CON_DEPENDIENTES", OC, "MEDIA",
                f"({empty('CODIGO_REP_LEGAL')} AND ({deps}))"))
    for f in ("NUMERO_REGISTRO", "NIT_REP_LEGAL"):
        out.append(("S12", f, f"{f}_NUMERO_INCONSISTENTE", OP, "BAJA", numeric_sequence(f)))
    return out


def extended_obs_sql() -> str:
    parts = [f"SELECT k, CAST({IDX[f]} AS INTEGER) AS IDX_CAMPO, {q(f)} AS CAMPO, {q(tipo)} AS TIPO_VERIFICACION, "
             f"{q(sev)} AS SEVERIDAD, {q(motivo)} AS DESCRIPCION FROM party WHERE {cond}"
             for _, f, motivo, tipo, sev, cond in ext_rules()]
    return with_party("\nUNION ALL\n".join(parts), need_obs=False)


# ---------------------------------------------------------------------------
# One query per predicate / validator
# ---------------------------------------------------------------------------

def nonneg_number(c):
    v = to_double_simple(c)
    return f"({filled(c)} AND {v} IS NOT NULL AND {v} >= 0.0)"


def positive_number(c):
    v = to_double_locale(c)
    return f"({filled(c)} AND {v} IS NOT NULL AND {v} > 0.0)"


SQL_FUNCTIONS = {
    "PB1": is_null, "PB2": is_blank, "PB3": empty, "PB4": filled, "PB5": upper_trim, "PB6": digits,
    "PB7": to_double_simple, "PB8": to_double_locale, "PB9": is_pos_int, "PB10": nonneg_number,
    "PB11": positive_number, "PB12": parsed_date, "PB13": is_bad_date,
    "V1": lambda c: f"({filled(c)} AND {placeholder(c)})", "V2": email_invalid, "V3": phone_invalid,
    "V4": nit_invalid, "V5": address_invalid, "V6": text_invalid, "V7": numeric_sequence,
    "V8": repeated_letters, "V9": lambda c: f"({text_invalid(c)} OR {repeated_letters(c)})",
    "V10": numeric_sequence, "V6B": lambda c: text_invalid(c, runs=K.KEYBOARD_RUNS_DRAFT),
}


def field_function_sql(prefix: str, fields) -> str:
    fn = SQL_FUNCTIONS[prefix]
    return field_checks_sql({f"{prefix}_{f}": fn(f) for f in fields})
