"""Extended catalogue: requirements stated for the table but absent from the
base rule set (families S1..S9, S12).  Off by default; enable with
``party_catalog(extended=True)``.  Conditions and reason codes here are this
library's reading of the written requirements [ours].

S10 and S11 are already covered by R1/R2 and R7..R16; S13 ("required when
*both* other transaction fields are filled") is the ``mutual="all"`` option of
``party_catalog``; S14 (observation type from the field's category) is
``schema.tipo_of``, used for every rule below.
"""

from __future__ import annotations

from recordcheck import constants as K
from recordcheck.functions import predicates as P
from recordcheck.functions import validators as V
from recordcheck.operators import rules as R
from recordcheck.operators.rules import Rule
from recordcheck.schema import tipo_of

EXTENDED_FAMILIES = ("S1", "S2", "S3", "S4", "S5", "S6", "S7", "S8", "S9", "S12")

F8, F9, F10 = "IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CARGO_ALTA_GERENCIA", "NOMBRES_APELLIDOS_CARGO_GERENCIA"
REP = "CODIGO_REP_LEGAL"
REP_REQUIRED = ("TIPO_DOCUMENTO_IDENT_REP_LEGAL", "DOCUMENTO_IDENTIDAD_REP_LEGAL",
                "FECHA_INGRESO_TRABAJO_REP_LEGAL", "MONEDA_NIVEL_INGRESOS_REP_LEGAL", "TIPO_RIESGO_REP_LEGAL")
REFERENCES = ("REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL")
NAME_PART = r"[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]{2,}"
PHONE_PART = r"(?<![0-9])[0-9]{7,8}(?![0-9])"


def extended_rules(as_of: str = K.DEFAULT_AS_OF) -> tuple[Rule, ...]:
    out: list[Rule] = []
    # The headcount must be a positive number once post and names are filled.
    out.append(R.custom(F8, lambda r: f"({r.filled(F9)} AND {r.filled(F10)} AND NOT {P.is_positive_number(F8)})",
                        f"{F8}_NO_NUMERICA", tipo_of(F8), K.SEV_ALTA, "S1", (F8, F9, F10)))
    # Marital status required once a spouse is named.
    out.append(R.required_if_any("ESTADO_CIVIL_REP_LEGAL", ("NOMBRE_CONYUGE_REP_LEGAL",),
                                 "ESTADO_CIVIL_REP_LEGAL_REQUERIDO_POR_NOMBRE_CONYUGE",
                                 tipo_of("ESTADO_CIVIL_REP_LEGAL"), K.SEV_ALTA, "S2"))
    # S3: workplace and post of the representative are consistent text.
    for f in ("LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL"):
        out.append(R.check(f, V.optional_text_inconsistent, f"{f}_TEXTO_INCONSISTENTE",
                           tipo_of(f), K.SEV_MEDIA, "S3"))
    # Last transaction date is a real, non-generic, past date.
    tx = "FECHA_ULTIMA_TRANSACCION"
    out.append(R.check(tx, lambda c: P.is_bad_date(c, as_of), "FECHA_ULT_TRANS_FECHA_INVALIDA",
                       tipo_of(tx), K.SEV_MEDIA, "S4"))
    # More representative fields required once the representative code is filled.
    for f in REP_REQUIRED:
        out.append(R.required_if_any(f, (REP,), f"{f}_REQUERIDO_POR_{REP}", tipo_of(f), K.SEV_MEDIA, "S5"))
    # Job start date in dd/MM/yyyy.
    job = "FECHA_INGRESO_TRABAJO_REP_LEGAL"
    out.append(R.check(job, lambda c: f"({P.parsed_date(c)} IS NULL)", f"{job}_FORMATO_FECHA_INVALIDO",
                       tipo_of(job), K.SEV_MEDIA, "S6"))
    # A filled reference carries a name and a 7-8 digit phone.
    for f in REFERENCES:
        out.append(R.check(f, lambda c: f"NOT ({P.rlike(c, NAME_PART)} AND {P.rlike(c, PHONE_PART)})",
                           f"{f}_SIN_NOMBRE_Y_TELEFONO", tipo_of(f), K.SEV_BAJA, "S7"))
    # Last update not before the opening date (when both parse).
    upd, alta = "FECHA_ULTIMA_ACTUALIZACION", "FECHA_ALTA"
    out.append(R.custom(upd, lambda r: f"({P.parsed_date(upd)} < {P.parsed_date(alta)})",
                        f"{upd}_MENOR_A_{alta}", tipo_of(upd), K.SEV_MEDIA, "S8", (upd, alta)))
    # Representative code empty while its dependents carry data.
    deps = K.REP_LEGAL_DEPENDENTS
    out.append(R.custom(REP, lambda r: f"({r.empty(REP)} AND (" + " OR ".join(r.filled(d) for d in deps) + "))",
                        f"{REP}_VACIO_CON_DEPENDIENTES", tipo_of(REP), K.SEV_MEDIA, "S9", (REP,) + deps))
    # Numeric optional fields use the digit-run / repeat check.
    for f in ("NUMERO_REGISTRO", "NIT_REP_LEGAL"):
        out.append(R.check(f, V.optional_number_inconsistent, f"{f}_NUMERO_INCONSISTENTE",
                           tipo_of(f), K.SEV_BAJA, "S12"))
    return tuple(out)
