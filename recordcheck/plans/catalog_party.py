"""Rule catalogue for legal-entity customer records (the 54-field table).

``party_rules`` returns the 171 rule instances of families R1..R28 in
evaluation order; ``extended_rules`` adds the requirements the base catalogue
leaves out (S-families), off by default.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from recordcheck import constants as K
from recordcheck.functions import predicates as P
from recordcheck.functions import validators as V
from recordcheck.operators import rules as R
from recordcheck.operators.rules import Rule

F8 = "IDENTIFICACION_CANT_INT_ALTA_GERENCIA"
F9 = "CARGO_ALTA_GERENCIA"
F10 = "NOMBRES_APELLIDOS_CARGO_GERENCIA"
TX1, TX2, TX3 = "FECHA_ULTIMA_TRANSACCION", "TIPO_CUENTA_ULTIMA_TRANSACCION", "CANAL_ATENCION_ULT_TRANS"
REP = "CODIGO_REP_LEGAL"
REFS = ("REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL")

FAMILIES = tuple(f"R{i}" for i in range(1, 29))


@dataclass(frozen=True)
class Catalog:
    name: str
    fields: tuple[str, ...]
    rules: tuple[Rule, ...]
    families: tuple[str, ...] = field(default=FAMILIES)

    def only(self, *rule_ids: str) -> "Catalog":
        keep = set(rule_ids)
        return Catalog(self.name, self.fields, tuple(r for r in self.rules if r.rule_id in keep),
                       tuple(f for f in self.families if f in keep))

    def __len__(self) -> int:
        return len(self.rules)

    def describe(self, spark):
        """The rules as a small DataFrame (one row per rule instance, in
        evaluation order): metadata for review, not audit data."""
        index = {f: i for i, f in enumerate(self.fields)}
        rows = [(n, r.rule_id, index[r.field], r.field, r.motivo, r.tipo, r.severidad, r.sql())
                for n, r in enumerate(self.rules)]
        return spark.createDataFrame(rows, "orden int, regla string, idx int, campo string, motivo string, "
                                           "tipo string, severidad string, condicion string")


def _null_blank(present: Sequence[str]) -> Iterable[Rule]:
    for f in present:
        yield R.null_rule(f, K.TIPO_NULL, K.SEV_ALTA, "R1")
        yield R.blank_rule(f, K.TIPO_VACIO, K.SEV_ALTA, "R2")


def _mandatory(pat: str) -> Iterable[Rule]:
    for f in K.MANDATORY:
        yield R.required(f, f"{f}_FALTANTE", K.TIPO_OBLIGADO, K.SEV_ALTA, "R3")
        yield R.check(f, lambda c: V.has_placeholder(c, pat), f"{f}_PALABRA_INVALIDA",
                      K.TIPO_OBLIGADO, K.SEV_ALTA, "R4")
    yield R.check("NIT", V.nit_invalid, "NIT_FORMATO_INVALIDO", K.TIPO_OBLIGADO, K.SEV_ALTA, "R5")
    yield R.check("RAZON_SOCIAL", lambda c: V.text_invalid(c, 3, pattern=pat), "RAZON_SOCIAL_TEXTO_INVALIDO",
                  K.TIPO_OBLIGADO, K.SEV_ALTA, "R6")


def _management() -> Iterable[Rule]:
    """R7..R14: the management headcount, post and name go together."""
    cond, alta = K.TIPO_CONDICIONAL, K.SEV_ALTA

    def count_positive(r):
        return f"({r.filled(F8)} AND {P.is_positive_int(F8)})"

    def count_missing(r):
        # NULL (no observation) when the count is filled but not numeric.
        return f"({r.empty(F8)} OR NOT {P.is_positive_int(F8)})"

    yield R.custom(F8, lambda r: f"({count_positive(r)} AND {r.empty(F9)})",
                   f"{F8}_SIN_{F9}", cond, alta, "R7", (F8, F9))
    yield R.custom(F8, lambda r: f"({count_positive(r)} AND {r.empty(F10)})",
                   f"{F8}_SIN_NOMBRES_APELLIDOS", cond, alta, "R8", (F8, F10))
    yield R.custom(F9, lambda r: f"({r.filled(F9)} AND {count_missing(r)})",
                   f"{F9}_SIN_IDENTIFICACION_VALIDA", cond, alta, "R9", (F9, F8))
    yield R.custom(F9, lambda r: f"({r.filled(F9)} AND {r.empty(F10)})",
                   f"{F9}_SIN_NOMBRES_APELLIDOS", cond, alta, "R10", (F9, F10))
    yield R.custom(F10, lambda r: f"({r.filled(F10)} AND {count_missing(r)})",
                   "NOMBRES_APELLIDOS_SIN_IDENTIFICACION_VALIDA", cond, alta, "R11", (F10, F8))
    yield R.custom(F10, lambda r: f"({r.filled(F10)} AND {r.empty(F9)})",
                   "NOMBRES_APELLIDOS_SIN_CARGO", cond, alta, "R12", (F10, F9))
    yield R.required_if_any("TIPO_DOC_ID", (F10,), "TIPO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS",
                            cond, alta, "R13")
    yield R.required_if_any("NRO_DOC_ID", (F10,), "NRO_DOC_ID_REQUERIDO_POR_NOMBRES_APELLIDOS",
                            cond, alta, "R14")


def _legal_representative(pat: str) -> Iterable[Rule]:
    """R15..R18."""
    cond = K.TIPO_CONDICIONAL
    for f in K.REP_LEGAL_DEPENDENTS:
        yield R.required_if_any(f, (REP,), f"{f}_REQUERIDO_POR_{REP}", cond, K.SEV_ALTA, "R15")
    spouse, status = "NOMBRE_CONYUGE_REP_LEGAL", "ESTADO_CIVIL_REP_LEGAL"
    yield R.custom(spouse,
                   lambda r: f"({r.filled(status)} AND {P.rlike(r.col(status), K.MARRIED_PATTERN)} "
                             f"AND {r.empty(spouse)})",
                   "NOMBRE_CONYUGE_REQUERIDO_POR_ESTADO_CIVIL", cond, K.SEV_ALTA, "R16", (status, spouse))
    address = lambda c: V.address_invalid(c, pattern=pat)
    yield R.check("DOMICILIO", address, "DOMICILIO_INVALIDO", cond, K.SEV_MEDIA, "R17")
    yield R.check("DOMICILIO_PARTICULAR_REP_LEGAL", address, "DOMICILIO_PARTICULAR_INVALIDO",
                  cond, K.SEV_MEDIA, "R18")


def _optional_conditional(mutual: str = "any") -> Iterable[Rule]:
    """R19..R27.  ``mutual``: a transaction field is required when *any*
    other one is filled (as built), or only when *all* others are (S13)."""
    t, m = K.TIPO_OPC_CONDICIONAL, K.SEV_MEDIA
    need = {"any": R.required_if_any, "all": R.required_if_all}[mutual]
    yield need(TX1, (TX2, TX3), "FECHA_ULT_TRANS_REQUERIDA", t, m, "R19")
    yield need(TX2, (TX1, TX3), "TIPO_CUENTA_ULT_TRANS_REQUERIDA", t, m, "R20")
    yield need(TX3, (TX1, TX2), "CANAL_ULT_TRANS_REQUERIDO", t, m, "R21")
    yield R.check("CORREO_ELECTRONICO_REP_LEGAL", V.email_invalid, "EMAIL_FORMATO_INVALIDO", t, m, "R22")
    yield R.check("TELEFONO_REP_LEGAL", V.phone_invalid, "TELEFONO_INVALIDO", t, m, "R23")
    yield R.check("TELEFONO", V.phone_invalid, "TELEFONO_INVALIDO", t, m, "R24")
    yield R.required_if_any(REP, ("NOMBRE_REP_LEGAL",), "CODIGO_REP_LEGAL_REQUERIDO", t, m, "R25")
    yield R.at_least_one(REFS[0], REFS, REP, "AL_MENOS_UNA_REFERENCIA_REQUERIDA", t, m, "R26")
    last, count = "FECHA_ULTIMA_ACTUALIZACION", "CANTIDAD_ACTUALIZACIONES"
    yield R.custom(count,
                   lambda r: f"({r.filled(last)} AND ({r.empty(count)} OR {P.legacy_int(count)} <= 1))",
                   "CANT_ACTUALIZACIONES_DEBE_SER_MAYOR_1", t, K.SEV_BAJA, "R27", (last, count))


def _optional(present: Sequence[str], pat: str) -> Iterable[Rule]:
    """Free-text check on optional fields that exist in the input.

    Specified as "V6 or V1"; V6 already contains the V1 placeholder test
    under the same filled-field guard, so V6 alone is the same condition and
    scans the text once instead of twice."""
    for f in K.OPTIONAL:
        if f in present:
            yield R.check(f, lambda c: V.text_invalid(c, 3, pattern=pat),
                          f"{f}_TEXTO_INVALIDO", K.TIPO_OPCIONAL, K.SEV_BAJA, "R28")


def party_rules(columns: Sequence[str] | None = None, mutual: str = "any",
                unicode_case: bool = False, header: bool = False) -> tuple[Rule, ...]:
    """The R1..R28 rule instances for an input with ``columns`` (default: all 54).

    R1/R2 cover every audited field present (``header``: every column, in the
    order of the header) and R28 every optional field present; the other rules
    need their fields.  ``unicode_case`` makes the
    placeholder words fold accented capitals too (default: ASCII only, as
    specified).
    """
    present = [f for f in K.FIELDS if columns is None or f in columns]
    pat = V.placeholder_pattern(unicode_case=unicode_case)
    return (*_null_blank(columns if header and columns else present), *_mandatory(pat), *_management(), *_legal_representative(pat),
            *_optional_conditional(mutual), *_optional(present, pat))


def party_catalog(columns: Sequence[str] | None = None, extended: bool = False,
                  as_of: str = K.DEFAULT_AS_OF, mutual: str = "any", unicode_case: bool = False,
                  header: bool = False) -> Catalog:
    """The catalogue for an input with ``columns``.  A field's index is its code in
    the list of 54; with ``header`` the columns are those of the file: indices are
    their positions, and columns beyond the 54 are audited for NULL and blank."""
    rules = party_rules(columns, mutual, unicode_case, header)
    families = FAMILIES
    if extended:
        from recordcheck.plans.catalog_extended import EXTENDED_FAMILIES, extended_rules
        rules = rules + extended_rules(as_of)
        families = FAMILIES + EXTENDED_FAMILIES
    return Catalog("party", tuple(columns) if header and columns else K.FIELDS, rules, families)


__all__ = ["Catalog", "party_catalog", "party_rules", "FAMILIES"]
