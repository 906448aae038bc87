"""One row per observation: the detail table (OUT2) and the categorised audit
report (OUT3, with REGLA and a friendly DESCRIPCION)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.functions.sql import lit
from recordcheck.operators.masks import Layout
from recordcheck.operators.rules import Rule
from recordcheck.schema import OBS_COL

# FIXED VALUES: report wording.  Per observation type, the first entry whose
# needle occurs in ``motivo`` decides the description.  An action is either
# ("text", value) or ("replace", regex, replacement) applied to ``motivo``.
DESCRIPTION_TABLE = (
    (K.TIPO_OBLIGADO, (
        ("PALABRA_INVALIDA", ("text", K.DESC_PLACEHOLDER)),
        ("FALTANTE", ("text", K.DESC_MISSING)),
        ("FORMATO_INVALIDO", ("text", K.DESC_BAD_FORMAT)),
        ("TEXTO_INVALIDO", ("text", K.DESC_BAD_TEXT)),
    ), None),
    (K.TIPO_CONDICIONAL, (
        ("REQUERIDO_POR", ("replace", "_REQUERIDO_POR_", " requiere ")),
        ("SIN_", ("replace", ".*_SIN_", "Requiere ")),
    ), ("replace", ".*_DEPENDE_DE_", "Requiere ")),
    (K.TIPO_OPC_CONDICIONAL, (
        ("EMAIL", ("text", K.DESC_BAD_EMAIL)),
        ("TELEFONO", ("text", K.DESC_BAD_PHONE)),
        ("FORMATO", ("text", K.DESC_BAD_FORMAT)),
        ("REQUERIDO", ("replace", "_REQUERIDO.*", " es requerido")),
    ), None),
    (K.TIPO_OPCIONAL, (
        ("TEXTO_INVALIDO", ("text", K.DESC_OPTIONAL_TEXT)),
    ), None),
)
# NULL / VACIO observations are described as "<campo>_<lower tipo>".
SUFFIXED_TYPES = (K.TIPO_NULL, K.TIPO_VACIO)

# Stored per-record id of a materialized evaluation; used only as the last
# sort key of ordered outputs and never returned.
ROW_ID = "_rc_row_id"

DETAIL_COLUMNS = ("CODIGO", "RAZON_SOCIAL", "NIT", "IDX_CAMPO", "CAMPO", "TIPO_VERIFICACION",
                  "SEVERIDAD", "DESCRIPCION")
REPORT_COLUMNS = ("CODIGO", "IDX_CAMPO", "CAMPO", "TIPO_VERIFICACION", "REGLA", "DESCRIPCION")


def _action(motivo: Column, action) -> Column:
    if action is None:
        return motivo
    if action[0] == "text":
        return F.lit(action[1])
    return F.regexp_replace(motivo, action[1], action[2])


def regla(tipo: Column) -> Column:
    """REGLA: report category of an observation type."""
    out = None
    for t, label in K.REGLA_BY_TIPO:
        out = F.when(tipo == t, F.lit(label)) if out is None else out.when(tipo == t, F.lit(label))
    return out.otherwise(F.lit(K.REGLA_OTHER))


def friendly_description(campo: Column, motivo: Column, tipo: Column) -> Column:
    """DESCRIPCION of the audit report."""
    out = None
    for t in SUFFIXED_TYPES:
        branch = F.concat(campo, F.lit("_" + t.lower()))
        out = F.when(tipo == t, branch) if out is None else out.when(tipo == t, branch)
    for t, cases, fallback in DESCRIPTION_TABLE:
        inner = None
        for needle, action in cases:
            hit = motivo.contains(needle)
            inner = (F.when(hit, _action(motivo, action)) if inner is None
                     else inner.when(hit, _action(motivo, action)))
        inner = inner.otherwise(_action(motivo, fallback))
        out = out.when(tipo == t, inner)
    return out.otherwise(motivo)


def describe(rule: Rule) -> str:
    """DESCRIPCION of a rule's observations (``friendly_description`` of constants)."""
    if rule.tipo in SUFFIXED_TYPES:
        return f"{rule.field}_{rule.tipo.lower()}"
    for tipo, cases, fallback in DESCRIPTION_TABLE:
        if tipo == rule.tipo:
            action = next((a for needle, a in cases if needle in rule.motivo), fallback)
            if action is None:
                return rule.motivo
            return action[1] if action[0] == "text" else re.sub(action[1], action[2], rule.motivo)
    return rule.motivo


def _fired(masked: DataFrame, layout: Layout, carry: Sequence[str]) -> DataFrame:
    """One row per rule that fired on a record; ``_n`` is its number.  The numbers are
    a column first: the generator itself would interpret their expression."""
    rows = masked.select(*carry, F.expr(layout.fired()).alias("_ns")).select(*carry, F.explode_outer("_ns").alias("_n"))
    return rows.filter(F.col("_n").isNotNull())


def _of_rule(layout: Layout, values: Sequence, kind: str = "STRING") -> Column:
    """A constant of the rule ``_n``."""
    listed = ", ".join(str(int(v)) if kind == "INT" else lit(v) for v in values)
    return F.expr(f"element_at(array({listed}), _n + 1)") if layout.rules else F.lit(None).cast(kind)


def _numbered(masked: DataFrame, layout: Layout, fields: Sequence[str], ids: Sequence[str], order: str, code: str) -> DataFrame:
    """Record ids, ``_n`` and IDX_CAMPO of every observation, in order.  Its texts
    follow from ``_n`` after the sort: neither sampled nor shuffled."""
    index = {f: i for i, f in enumerate(fields)}
    rows = _fired(masked, layout, _carry(masked, list(ids)))
    return _ordered(rows.withColumn("IDX_CAMPO", _of_rule(layout, [index[r.field] for r in layout.rules], "INT")), order, code)


def mask_detail(masked: DataFrame, layout: Layout, fields: Sequence[str], keys: Sequence[str] = (), order: str = "global",
                record_id: Sequence[str] = ("CODIGO", "RAZON_SOCIAL", "NIT")) -> DataFrame:
    """OUT2 from masks: everything an observation says is a constant of its rule."""
    rules, ids = layout.rules, [*keys, *record_id]
    return _numbered(masked, layout, fields, ids, order, record_id[0]).select(
        *ids, "IDX_CAMPO",
        _of_rule(layout, [r.field for r in rules]).alias("CAMPO"),
        _of_rule(layout, [r.tipo for r in rules]).alias("TIPO_VERIFICACION"),
        _of_rule(layout, [r.severidad for r in rules]).alias("SEVERIDAD"),
        _of_rule(layout, [r.motivo for r in rules]).alias("DESCRIPCION"))


def mask_report(masked: DataFrame, layout: Layout, fields: Sequence[str], keys: Sequence[str] = (), order: str = "global",
                code: str = "CODIGO") -> DataFrame:
    """OUT3 from masks."""
    categories, rules, ids = dict(K.REGLA_BY_TIPO), layout.rules, [*keys, code]
    return _numbered(masked, layout, fields, ids, order, code).select(
        *ids, "IDX_CAMPO",
        _of_rule(layout, [r.field for r in rules]).alias("CAMPO"),
        _of_rule(layout, [r.tipo for r in rules]).alias("TIPO_VERIFICACION"),
        _of_rule(layout, [categories.get(r.tipo, K.REGLA_OTHER) for r in rules]).alias("REGLA"),
        _of_rule(layout, [describe(r) for r in rules]).alias("DESCRIPCION"))


def _exploded(evaluated: DataFrame, carry: Sequence[str], obs_col: str) -> DataFrame:
    """One row per observation; records without observations vanish.

    Written as ``explode_outer`` + a filter on the generated column rather
    than ``explode``: for an inner explode Spark infers ``size(array) > 0``
    and pushes it below the projection that builds the array, which would
    evaluate every rule twice (once in the pushed filter)."""
    rows = evaluated.select(*carry, F.explode_outer(obs_col).alias("_o"))
    return rows.filter(F.col("_o").isNotNull())


def _ordered(df: DataFrame, order: str, code: str = "CODIGO") -> DataFrame:
    """Order by the record code, IDX_CAMPO (ties are unspecified).  When the
    row id of a materialized evaluation is present it is the last key: a code
    shared by a third of all records then still spreads over many range
    partitions."""
    keys = [code, "IDX_CAMPO"] + ([ROW_ID] if ROW_ID in df.columns else [])
    if order == "global":
        df = df.orderBy(*keys)
    elif order == "range":
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    elif order == "local":
        df = df.sortWithinPartitions(*keys)
    return df.drop(ROW_ID) if ROW_ID in df.columns else df


def _carry(evaluated: DataFrame, cols: list[str]) -> list[str]:
    return cols + ([ROW_ID] if ROW_ID in evaluated.columns else [])


def detail(evaluated: DataFrame, keys: Sequence[str] = (), order: str = "global",
           obs_col: str = OBS_COL, record_id: Sequence[str] = ("CODIGO", "RAZON_SOCIAL", "NIT")) -> DataFrame:
    """OUT2 ``detalle_observaciones``: records without observations vanish.

    ``order``: "global" (sorted by CODIGO, IDX_CAMPO as specified), "range"
    (range-partitioned and sorted inside each partition: files hold disjoint
    ranges), "local" (sorted inside whatever partitions there are) or "none".
    """
    rows = _exploded(evaluated, _carry(evaluated, [*keys, *record_id]), obs_col)
    out = rows.select(
        *_carry(evaluated, [*keys, *record_id]),
        F.col("_o.idx").alias("IDX_CAMPO"),
        F.col("_o.campo").alias("CAMPO"),
        F.col("_o.tipo").alias("TIPO_VERIFICACION"),
        F.col("_o.severidad").alias("SEVERIDAD"),
        F.col("_o.motivo").alias("DESCRIPCION"),
    )
    return _ordered(out, order, record_id[0])


def audit_report(evaluated: DataFrame, keys: Sequence[str] = (), order: str = "global",
                 obs_col: str = OBS_COL, code: str = "CODIGO") -> DataFrame:
    """OUT3 ``reporte_auditoria`` with REGLA and friendly DESCRIPCION."""
    rows = _exploded(evaluated, _carry(evaluated, [*keys, code]), obs_col)
    o = F.col("_o")
    out = rows.select(
        *_carry(evaluated, [*keys, code]),
        o["idx"].alias("IDX_CAMPO"),
        o["campo"].alias("CAMPO"),
        o["tipo"].alias("TIPO_VERIFICACION"),
        regla(o["tipo"]).alias("REGLA"),
        friendly_description(o["campo"], o["motivo"], o["tipo"]).alias("DESCRIPCION"),
    )
    return _ordered(out, order, code)
