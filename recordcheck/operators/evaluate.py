"""Rules -> masks -> one observation array.

The rules come to bits (``operators.masks``); an observation is a constant, picked
by its bit: ``CASE WHEN bit THEN array(<literal observation>) ELSE <empty array>
END`` per rule, joined by ``flatten`` in rule order.  A rule that is false *or*
NULL sets no bit and adds nothing.  (``array_compact`` / ``filter`` would do the same
but are higher-order functions without code generation.)

Expressions are built as Spark SQL text and become Columns in one call, so
planning a 171-rule audit costs few Python-to-JVM round trips instead of tens of
thousands.  It is a few narrow projections over the input: no shuffle, no UDF, no
chain of ``withColumn`` (a chain nests one projection per rule, and a filter on
top makes the optimizer substitute the array into itself).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordcheck.functions.sql import ident, lit, unfused
from recordcheck.operators.masks import Layout, with_masks
from recordcheck.operators.rules import Rule
from recordcheck.schema import OBS_COL

DEFAULT_BLOCK = 9              # rules that are tested together first
OBS_SQL_TYPE = "ARRAY<STRUCT<idx: INT, campo: STRING, motivo: STRING, tipo: STRING, severidad: STRING>>"
EMPTY_OBS = f"CAST(array() AS {OBS_SQL_TYPE})"


def observation_sql(rule: Rule, idx: int) -> str:
    return (f"array(named_struct('idx', {int(idx)}, 'campo', {lit(rule.field)}, "
            f"'motivo', {lit(rule.motivo)}, 'tipo', {lit(rule.tipo)}, "
            f"'severidad', {lit(rule.severidad)}))")


def observations_sql(layout: Layout, field_index: dict[str, int], block_size: int = DEFAULT_BLOCK) -> str:
    """Expression text of the ``array<struct>`` of fired observations over the masks."""
    rules = range(len(layout.rules))
    elements = [f"CASE WHEN {layout.bit(n).test} THEN {observation_sql(layout.rules[n], field_index[layout.rules[n].field])} "
                f"ELSE {EMPTY_OBS} END" for n in rules]
    if not elements:
        return EMPTY_OBS
    # Most rules are silent on most records: a block without a bit set is skipped.
    blocks = [f"CASE WHEN {layout.any_of(rules[i:i + block_size])} THEN flatten(array({', '.join(elements[i:i + block_size])})) "
              f"ELSE {EMPTY_OBS} END" for i in rules[::block_size]]
    none = f"transform({unfused(f'{layout.bit(0).word} = 0L', 'STRING')}, _v -> named_struct('idx', 0, 'campo', _v, 'motivo', _v, 'tipo', _v, 'severidad', _v))"
    return f"flatten(array({', '.join(blocks)}, {none}))"


def layout_of(df: DataFrame, rules: Sequence[Rule], fields: Sequence[str]) -> Layout:
    """The bits of the rules and of the audited fields that ``df`` has."""
    missing = sorted({f for r in rules for f in r.uses + (r.field,)} - set(df.columns))
    if missing:
        raise ValueError(f"rules read columns absent from the input: {missing}")
    return Layout(rules, [f for f in fields if f in df.columns])


def observations_column(layout: Layout, fields: Sequence[str], block_size: int = DEFAULT_BLOCK) -> Column:
    return F.expr(observations_sql(layout, {f: i for i, f in enumerate(fields)}, block_size))


def evaluate(df: DataFrame, rules: Sequence[Rule], fields: Sequence[str],
             obs_col: str = OBS_COL, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Append the observation array to every row of ``df``.

    ``fields`` fixes each field's index (its code).  Columns of ``df`` that no
    rule reads (keys, extra data) pass through unchanged.
    """
    layout = layout_of(df, rules, fields)
    return with_masks(df, layout).select(
        *[F.col(ident(c)) for c in df.columns], observations_column(layout, fields, block_size).alias(obs_col))
