"""Filtered views over the executive summary and the report (VW1..VW4,
SO4, EX1..EX6).  All are row filters; they belong on a materialized
evaluation (see ``plans.audit.Audit``) so the rule array is not recomputed
inside the filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordcheck import constants as K


def critical_records(summary: DataFrame, null_threshold: int = K.CRITICAL_NULL_THRESHOLD) -> DataFrame:
    """VW1: a mandatory-field observation, or more than ``null_threshold`` NULL fields."""
    return summary.filter((F.col("CANT_OBLIGADOS_FALTANTES") > 0) | (F.col("CANT_NULL") > null_threshold))


def dependency_records(summary: DataFrame) -> DataFrame:
    """VW2: at least one conditional (dependency) observation."""
    return summary.filter(F.col("CANT_CONDICIONALES_FALTANTES") > 0)


def inconsistent_records(summary: DataFrame) -> DataFrame:
    """VW3: at least one optional-field inconsistency."""
    return summary.filter(F.col("CANT_INCONSISTENCIAS_DATOS") > 0)


def clean_records(summary: DataFrame) -> DataFrame:
    """VW4: no observation at all."""
    return summary.filter(F.col("CANT_TOTAL_OBS") == 0)


def missing_mandatory(summary: DataFrame) -> DataFrame:
    """EX1: records with a mandatory-field observation."""
    return summary.filter(F.col("CANT_OBLIGADOS_FALTANTES") > 0)


def heavy_records(summary: DataFrame, threshold: int = K.HEAVY_RECORD_THRESHOLD,
                  limit: int | None = None, tiebreak: str | None = None, code: str = "CODIGO") -> DataFrame:
    """SO4: records with more than ``threshold`` observations, most first.

    The count has few distinct values, so a global sort on it alone would put
    each value's records in one range partition; ``tiebreak`` (a unique
    column, dropped from the result) lets a hot value spread out."""
    keys = [F.desc("CANT_TOTAL_OBS"), F.col(code)] + ([F.col(tiebreak)] if tiebreak else [])
    out = summary.filter(F.col("CANT_TOTAL_OBS") > threshold).orderBy(*keys)
    out = out.limit(limit) if limit else out
    return out.drop(tiebreak) if tiebreak else out


def record_lookup(rows: DataFrame, codigo: str) -> DataFrame:
    """EX2 / EX3: detail or report rows of one record code."""
    return rows.filter(F.col("CODIGO") == codigo)


def by_type(report: DataFrame, tipo: str) -> DataFrame:
    """EX4: report rows of one observation type."""
    return report.filter(F.col("TIPO_VERIFICACION") == tipo)


def by_rule_category(report: DataFrame, regla: str) -> DataFrame:
    """EX5: report rows of one REGLA category."""
    return report.filter(F.col("REGLA") == regla)


def bad_tax_id(summary: DataFrame) -> DataFrame:
    """EX6: records whose tax id has a bad format.  That reason is a
    mandatory-field observation, so it is looked up in OBS_OBLIGADOS."""
    return summary.filter(F.col("OBS_OBLIGADOS").contains("NIT_FORMATO_INVALIDO"))
