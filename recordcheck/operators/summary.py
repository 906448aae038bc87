"""Per-record counters and lists (SM1..SM10) and the executive summary (OUT1).

From masks, counters are bit counts and lists bit tests.  From an observation
array (``with_summary``), one fold over its elements gives all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.functions.sql import ident, lit
from recordcheck.operators.masks import Layout
from recordcheck.schema import OBS_COL

COUNTERS = (
    ("CANT_NULL", (K.TIPO_NULL,)),
    ("CANT_VACIO", (K.TIPO_VACIO,)),
    ("CANT_OBLIGADOS_FALTANTES", (K.TIPO_OBLIGADO,)),
    ("CANT_CONDICIONALES_FALTANTES", (K.TIPO_CONDICIONAL,)),
    ("CANT_OPC_CONDICIONALES_FALTANTES", (K.TIPO_OPC_CONDICIONAL,)),
    ("CANT_INCONSISTENCIAS_DATOS", (K.TIPO_OPCIONAL,)),
)
TOTAL = "CANT_TOTAL_OBS"
LISTS = ("OBS_CAMPOS_NULL_VACIO", "OBS_OBLIGADOS", "OBS_CONDICIONALES", "OBS_INCONSISTENCIAS")
SUMMARY_COLUMNS = tuple(n for n, _ in COUNTERS) + (TOTAL,) + LISTS
RECORD_ID = ("CODIGO", "RAZON_SOCIAL", "NIT")


# The observation types of every list, and what an observation adds to it.
LIST_TYPES = ((K.TIPO_NULL, K.TIPO_VACIO), (K.TIPO_OBLIGADO,), (K.TIPO_CONDICIONAL,), (K.TIPO_OPC_CONDICIONAL, K.TIPO_OPCIONAL))
SEP = ", "


def mask_summary(layout: Layout) -> list[Column]:
    """SM1..SM10 as Columns over the masks."""
    rules = list(enumerate(layout.rules))
    texts = {n: f"{r.field}_{r.tipo.lower()}" if r.tipo in LIST_TYPES[0] else r.motivo for n, r in rules}
    cols = [F.expr(layout.count([n for n, r in rules if r.tipo in tipos])).alias(name) for name, tipos in COUNTERS]
    cols.append(F.expr(layout.count([n for n, _ in rules])).alias(TOTAL))
    cols += [F.expr(layout.joined({n: texts[n] for n, r in rules if r.tipo in tipos}, SEP)).alias(name)
             for name, tipos in zip(LISTS, LIST_TYPES)]
    return cols


def _folded(obs_col: str) -> Column:
    """A struct of SM1..SM10: one ``aggregate`` over the observations."""
    def types(tipos: Sequence[str]) -> str:
        return f"x.tipo IN ({', '.join(lit(t) for t in tipos)})"

    zero = ", ".join([f"'{name}', 0" for name, _ in COUNTERS] + [f"'{TOTAL}', 0"] + [f"'{name}', ''" for name in LISTS])
    steps = [f"'{name}', s.{name} + if({types(tipos)}, 1, 0)" for name, tipos in COUNTERS] + [f"'{TOTAL}', s.{TOTAL} + 1"]
    for name, tipos in zip(LISTS, LIST_TYPES):
        text = "concat(x.campo, '_', lower(x.tipo))" if tipos == LIST_TYPES[0] else "x.motivo"
        steps.append(f"'{name}', if({types(tipos)}, concat(s.{name}, if(s.{name} = '', '', {lit(SEP)}), {text}), s.{name})")
    return F.expr(f"aggregate({ident(obs_col)}, named_struct({zero}), (s, x) -> named_struct({', '.join(steps)}))")


def with_summary(evaluated: DataFrame, obs_col: str = OBS_COL) -> DataFrame:
    """A table with observations plus SM1..SM10, by one pass over the array."""
    folded = evaluated.select("*", _folded(obs_col).alias("_rc_summary"))
    return folded.select(*[F.col(ident(c)) for c in evaluated.columns], *[F.col(f"_rc_summary.{c}").alias(c) for c in SUMMARY_COLUMNS])


def executive_summary(scored: DataFrame, keys: Sequence[str] = (),
                      record_id: Sequence[str] = RECORD_ID) -> DataFrame:
    """OUT1 ``resumen_ejecutivo``: record id + counters + lists.

    ``scored`` must carry the summary columns (see ``with_summary``); ``keys``
    are extra pass-through columns put first.
    """
    return scored.select(*keys, *record_id, *SUMMARY_COLUMNS)
