"""Carrying a caller's columns past an operator's own names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """(inner, carried, restore): ``inner`` has every column of ``docs`` under a
    neutral name plus the ``needed`` ones under their own, ``restore`` selects the
    former back under the caller's names.  So no column of the caller can clash
    with one of the operator."""
    names = docs.columns
    carried = [f"_c{i}" for i in range(len(names))]
    inner = docs.select(*[docs[f"`{n}`"].alias(c) for n, c in zip(names, carried)], *[docs[n].alias(n) for n in needed])

    def restore(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(n) for n, c in zip(names, carried)])

    return inner, carried, restore
