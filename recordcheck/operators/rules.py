"""Declarative rules.

A rule names the field it reports on, the reason (``motivo``), the observation
type and severity, and a condition: a function of a ``FieldRefs`` object that
returns boolean Spark SQL expression text.  Rules never see a DataFrame.

A NULL condition behaves as false (three-valued logic is kept on purpose: a
non-numeric count makes "count > 0" unknown and no observation is raised).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from recordcheck.functions import predicates as P
from recordcheck.functions.sql import all_of, any_of, ident


class FieldRefs:
    """Field access handed to rule conditions (expression text)."""

    def col(self, field: str) -> str:
        return ident(field)

    def empty(self, field: str) -> str:
        return P.is_empty(field)

    def filled(self, field: str) -> str:
        return P.is_filled(field)


Condition = Callable[[FieldRefs], str]


@dataclass(frozen=True)
class Rule:
    rule_id: str          # family id, e.g. "R3"
    field: str            # field the observation is reported on
    motivo: str           # reason code
    tipo: str             # observation type label
    severidad: str        # severity label
    condition: Condition  # FieldRefs -> boolean expression text
    uses: tuple[str, ...] = ()  # every field the condition reads
    # "null" or "blank": the rule is that state of its field and nothing else, so
    # the field's bit is the rule's bit.
    state: str | None = None

    def sql(self, refs: FieldRefs | None = None) -> str:
        return self.condition(refs or FieldRefs())


# Builders --------------------------------------------------------------------

def null_rule(field: str, tipo: str, severidad: str, rule_id: str = "R1") -> Rule:
    return Rule(rule_id, field, f"{field}_NULL", tipo, severidad,
                lambda r, f=field: P.is_null(f), (field,), "null")


def blank_rule(field: str, tipo: str, severidad: str, rule_id: str = "R2") -> Rule:
    return Rule(rule_id, field, f"{field}_VACIO", tipo, severidad,
                lambda r, f=field: P.is_blank(f), (field,), "blank")


def required(field: str, motivo: str, tipo: str, severidad: str, rule_id: str) -> Rule:
    """Observation when the field is empty."""
    return Rule(rule_id, field, motivo, tipo, severidad, lambda r, f=field: r.empty(f), (field,))


def check(field: str, validator: Callable[[str], str], motivo: str, tipo: str,
          severidad: str, rule_id: str) -> Rule:
    """Observation when the field is filled and ``validator`` says invalid."""
    return Rule(rule_id, field, motivo, tipo, severidad,
                lambda r, f=field, v=validator: f"({r.filled(f)} AND {v(f)})", (field,))


def required_if_any(field: str, principals: Sequence[str], motivo: str, tipo: str,
                    severidad: str, rule_id: str) -> Rule:
    """Observation when any principal is filled and ``field`` is empty."""
    principals = tuple(principals)
    return Rule(rule_id, field, motivo, tipo, severidad,
                lambda r: all_of([any_of(r.filled(p) for p in principals), r.empty(field)]),
                principals + (field,))


def required_if_all(field: str, principals: Sequence[str], motivo: str, tipo: str,
                    severidad: str, rule_id: str) -> Rule:
    """Observation when every principal is filled and ``field`` is empty."""
    principals = tuple(principals)
    return Rule(rule_id, field, motivo, tipo, severidad,
                lambda r: all_of([*(r.filled(p) for p in principals), r.empty(field)]),
                principals + (field,))


def at_least_one(report_on: str, group: Sequence[str], principal: str, motivo: str,
                 tipo: str, severidad: str, rule_id: str) -> Rule:
    """Observation when ``principal`` is filled and every field of ``group`` is empty."""
    group = tuple(group)
    return Rule(rule_id, report_on, motivo, tipo, severidad,
                lambda r: all_of([r.filled(principal), *(r.empty(g) for g in group)]),
                (principal,) + group)


def custom(field: str, condition: Condition, motivo: str, tipo: str, severidad: str,
           rule_id: str, uses: Sequence[str] = ()) -> Rule:
    """Any other condition over one or more fields."""
    return Rule(rule_id, field, motivo, tipo, severidad, condition, tuple(uses) or (field,))
