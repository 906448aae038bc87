"""Joins and keys that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 20_000             # rows of one key from which on it is taken out of a shuffle


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], n: str, hot: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row per key, ``n`` = rows of that
    key in ``rows``), without a task that gets a hot key: keys with at least
    ``hot`` rows are broadcast, so their rows stay where they are, the others are
    shuffled.  A broadcast key stands for ``hot`` rows, so the broadcast holds at
    most (rows / hot) keys."""
    hot = HOT_ROWS if hot is None else hot
    few = keyed.filter(F.col(n) >= hot).drop(n)
    most = keyed.filter(F.col(n) < hot).drop(n)
    marked = rows.join(F.broadcast(few.select(*on).withColumn("_hot", F.lit(True))), on, "left")
    here = marked.filter("_hot").drop("_hot").join(F.broadcast(few), on)
    there = marked.filter("_hot IS NULL").drop("_hot").join(most, on)
    return here.unionByName(there)
