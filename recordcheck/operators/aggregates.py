"""Global totals and per-field counts (AG1..AG5, SO2).

Every aggregate here is partial on the map side, so the shuffle carries one
row per task whatever the input size or skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.functions.sql import lit
from recordcheck.operators.masks import Layout, rule_totals
from recordcheck.operators.summary import COUNTERS, TOTAL

TOTAL_NAMES = (
    ("CANT_NULL", "TOTAL_NULL"),
    ("CANT_VACIO", "TOTAL_VACIO"),
    ("CANT_OBLIGADOS_FALTANTES", "TOTAL_OBLIGADOS"),
    ("CANT_CONDICIONALES_FALTANTES", "TOTAL_CONDICIONALES"),
    ("CANT_OPC_CONDICIONALES_FALTANTES", "TOTAL_OPC_CONDICIONALES"),
    ("CANT_INCONSISTENCIAS_DATOS", "TOTAL_INCONSISTENCIAS"),
    (TOTAL, "TOTAL_OBSERVACIONES"),
)
assert [a for a, _ in TOTAL_NAMES[:-1]] == [n for n, _ in COUNTERS]


def pct_half_up(part: Column, whole: Column) -> Column:
    """``round(100 * part / whole, 2)`` with half-up rounding done in integer
    arithmetic, so the value does not depend on floating-point order; NULL
    when ``whole`` is 0."""
    part, whole = part.cast("long"), whole.cast("long")
    num, den = part * 20000 + whole, F.when(whole > 0, whole * 2)
    # floor(num / den) exactly: subtract the remainder, then divide a multiple.
    basis_points = ((num - F.pmod(num, den)) / den).cast("long")
    return basis_points.cast("double") / F.lit(100.0)


def record_counts(summary: DataFrame) -> DataFrame:
    """AG1 + AG2 in one pass: total, with observations, clean, and percents."""
    agg = summary.agg(
        F.count(F.lit(1)).alias("TOTAL_REGISTROS"),
        F.count_if(F.col(TOTAL) > 0).alias("REGISTROS_CON_OBS"),
        F.count_if(F.col(TOTAL) == 0).alias("REGISTROS_LIMPIOS"),
    )
    return agg.select(
        "*",
        pct_half_up(F.col("REGISTROS_CON_OBS"), F.col("TOTAL_REGISTROS")).alias("PCT_CON_OBS"),
        pct_half_up(F.col("REGISTROS_LIMPIOS"), F.col("TOTAL_REGISTROS")).alias("PCT_LIMPIOS"),
    )


def type_totals(summary: DataFrame) -> DataFrame:
    """AG3: the seven global sums (BIGINT)."""
    return summary.agg(*[F.sum(F.col(c).cast("long")).alias(name) for c, name in TOTAL_NAMES])


def rule_counts(masked: DataFrame, layout: Layout) -> DataFrame:
    """(CAMPO, TIPO_VERIFICACION, count) of every rule that fired at all."""
    rules = layout.rules
    if not rules:
        return masked.sparkSession.createDataFrame([], "CAMPO string, TIPO_VERIFICACION string, count long")
    campo, tipo = (f"element_at(array({', '.join(map(lit, names))}), rule + 1)" for names in
                   ([r.field for r in rules], [r.tipo for r in rules]))
    return rule_totals(masked, layout).select(F.expr(campo).alias("CAMPO"), F.expr(tipo).alias("TIPO_VERIFICACION"), "count")


def field_counts(counts: DataFrame) -> DataFrame:
    """AG4: observations per field."""
    return counts.groupBy("CAMPO").agg(F.sum("count").alias("count"))


def top_fields(counts: DataFrame, k: int = K.TOP_FIELDS_K) -> DataFrame:
    """SO2: the ``k`` fields with most observations (ties by name)."""
    return field_counts(counts).orderBy(F.desc("count"), "CAMPO").limit(k)


def field_type_counts(counts: DataFrame) -> DataFrame:
    """AG5: observations per field and observation type, most first."""
    return (counts.groupBy("CAMPO", "TIPO_VERIFICACION").agg(F.sum("count").alias("count"))
            .orderBy(F.desc("count"), "CAMPO", "TIPO_VERIFICACION"))
