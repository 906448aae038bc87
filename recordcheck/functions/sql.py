"""Spark SQL expression text.

Predicates, validators and rules are written as Spark SQL expression text and
turned into a Column once (``F.expr``).  A 171-rule audit built Column by
Column costs tens of thousands of Python-to-JVM calls (seconds per query);
as text it is one call and the JVM parser does the rest.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def ident(name: str) -> str:
    """Quoted column reference."""
    return "`" + name.replace("`", "``") + "`"


def x(e: str) -> str:
    """A field name becomes a quoted reference; anything else is taken as an
    expression already."""
    return ident(e) if _NAME.match(e) else e


def lit(s: str) -> str:
    """Spark SQL string literal (backslash-escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unfused(e: str, kind: str) -> str:
    """An empty ``array<kind>`` made by a lambda function over ``e`` (a column), to be
    put beside the parts of a long expression.  Spark generates no code for lambdas, so
    it leaves the projection they are in out of the fused method of the stage and cuts it
    into many small ones.  Projections of hundreds of branches need that: fused they are one
    method of 8 to 64 KB, which the JVM never compiles but interprets row by row.  (Only the
    lambda itself is interpreted: never put the long expression into it.)"""
    return f"slice(transform(array(CAST({e} AS {kind})), _v -> _v), 1, 0)"


def any_of(parts) -> str:
    parts = list(parts)
    return "(" + " OR ".join(parts) + ")" if parts else "false"


def all_of(parts) -> str:
    parts = list(parts)
    return "(" + " AND ".join(parts) + ")" if parts else "true"


def column(expr_text: str) -> Column:
    """Column of an expression text."""
    return F.expr(expr_text)
