"""Data model: the audited table and the observation array."""

from __future__ import annotations

from pyspark.sql import types as T

from recordcheck import constants as K

# array<struct<idx, campo, motivo, tipo, severidad>>: which field, why, which
# type and how severe (declared as text in operators.evaluate).
OBS_COL = "OBS_ARRAY"

FIELD_INDEX = {name: i for i, name in enumerate(K.FIELDS)}


def string_schema(fields=K.FIELDS) -> T.StructType:
    """All-string, nullable schema of the audited table (CSV input)."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def category_of(field: str) -> str:
    """Profile category of a field; the first list that names it wins."""
    for members, label in K.CATEGORY_LABELS:
        if field in members:
            return label
    return K.CATEGORY_LABELS[-1][1]


def tipo_of(field: str) -> str:
    """Observation type implied by a field's category (fallback: optional)."""
    if field in K.MANDATORY:
        return K.TIPO_OBLIGADO
    if field in K.CONDITIONAL:
        return K.TIPO_CONDICIONAL
    if field in K.OPTIONAL_CONDITIONAL:
        return K.TIPO_OPC_CONDICIONAL
    return K.TIPO_OPCIONAL
