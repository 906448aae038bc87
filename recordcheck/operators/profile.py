"""Per-field quality profile (PF1..PF10): one row per audited field.

The profile of a set of records is a *state* that can be stored and added up: per
field and state (NULL, blank, filled but flagged) the number of records and the
first few codes.

* Every task adds up its records' mask bits and folds their codes into one
  sorted list of at most ``examples`` per field and state (PF7): one pass over five
  numbers and the code.
* These small states are folded over ``FOLDS`` groups, and those into one.
  Nothing is sorted or collected beyond that size, and a code that a third of
  all records share is one entry of each list.

States of several runs, days or parts of a table are merged by the same fold
(``merge_states``) without reading a record.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.functions import predicates as P
from recordcheck.functions.sql import ident, lit
from recordcheck.operators.aggregates import pct_half_up
from recordcheck.operators.masks import Layout, bit_counts
from recordcheck.schema import category_of

PROFILE_COLUMNS = ("campo", "CATEGORIA", "CANT_NULL", "CANT_VACIO", "CANT_INCONSISTENTES",
                   "PCT_COMPLETITUD", "PCT_NULL", "PCT_INCONSISTENTE", "CALIDAD_CAMPO",
                   "CODIGOS_NULL_EJEMPLO", "CODIGOS_VACIO_EJEMPLO")
# States of a field; ALL counts the records (field "").
NULL_STATE, BLANK_STATE, FLAGGED_STATE, ALL = "NULL", "VACIO", "INCONSISTENTE", "TODOS"
STATE_SCHEMA = "campo string, estado string, n bigint, codigos array<string>"
FOLDS = 1_000


def quality_band(pct: Column) -> Column:
    out = None
    for bound, label in K.QUALITY_BANDS:
        out = F.when(pct < bound, F.lit(label)) if out is None else out.when(pct < bound, F.lit(label))
    return F.when(pct.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(F.lit(K.QUALITY_TOP)))


# States ---------------------------------------------------------------------------

def _emit(counts: dict[int, int], best: dict[int, list[str]]) -> pa.RecordBatch:
    keys = sorted(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), pa.array([counts[k] for k in keys], pa.int64()),
         pa.array([best.get(k, []) for k in keys], pa.list_(pa.string()))], names=["state", "n", "codes"])


def _of_records(k: int, words: Sequence[str], states: Sequence[tuple[int, int, int]], flagged: Sequence[tuple[int, int, int, dict[int, int]]]):
    """The state of a task's records.  ``states``: (state, word, bit);  ``flagged``:
    (state, words and bit that must be off, masks of which one must hit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {0: 0, **{s: 0 for s, _, _ in states}, **{s: 0 for s, *_ in flagged}}
        best: dict[int, list[str]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch.column(w).to_numpy() for w in words]
            totals = bit_counts(values)
            counts[0] += batch.num_rows
            for state, word, bit in states:
                counts[state] += int(totals[word][bit])
            for state, off, bit, masks in flagged:
                hit = np.zeros(batch.num_rows, dtype=bool)
                for word, mask in masks.items():
                    hit |= (values[word] & mask) != 0
                empty = (values[off[0]] | values[off[1]]) >> bit & 1
                counts[state] += int((hit & (empty == 0)).sum())
            column = batch.column("code")
            valid = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            if not len(valid):
                continue
            encoded = column.take(pa.array(valid)).dictionary_encode()
            codes = encoded.dictionary.to_pylist()
            order = sorted(range(len(codes)), key=codes.__getitem__)      # code points order like UTF-8 bytes
            rank = np.empty(len(codes), dtype=np.int64)
            rank[order] = np.arange(len(codes))
            of_row = rank[encoded.indices.to_numpy()]
            by = np.argsort(of_row, kind="stable")
            starts = np.flatnonzero(np.concatenate(([True], of_row[by][1:] != of_row[by][:-1])))
            once = {}
            for state, word, bit in states:
                if word not in once:                                       # one word per distinct code
                    once[word] = np.bitwise_or.reduceat(values[word][valid][by], starts)
                hits = np.flatnonzero((once[word] >> bit) & 1)[:k].tolist()
                if hits:
                    best[state] = sorted({*best.get(state, ()), *(codes[order[i]] for i in hits)})[:k]
        yield _emit(counts, best)
    return run


def profile_states(masked: DataFrame, layout: Layout, fields: Sequence[str], code_col: str = "CODIGO",
                   examples: int = K.EXAMPLE_CODES) -> DataFrame:
    """The mergeable state of a profile: campo, estado, n, codigos (the first
    ``examples`` distinct filled codes, ascending)."""
    words = layout.columns
    content: dict[str, dict[int, int]] = {}
    for n, r in enumerate(layout.rules):
        if r.tipo not in (K.TIPO_NULL, K.TIPO_VACIO):
            bit, masks = layout.bit(n), content.setdefault(r.field, {})
            masks[words.index(bit.word)] = masks.get(words.index(bit.word), 0) | bit.mask
    names, states, flagged = [(0, "", ALL)], [], []
    for f in fields:
        null, blank = layout.null_bit(f), layout.blank_bit(f)
        for state, bit in ((NULL_STATE, null), (BLANK_STATE, blank)):
            states.append((len(names), words.index(bit.word), bit.number))
            names.append((len(names), f, state))
        if f in content:
            # A field with content observations that is itself empty is not "filled".
            flagged.append((len(names), (words.index(null.word), words.index(blank.word)), null.number, content[f]))
            names.append((len(names), f, FLAGGED_STATE))
    code = F.expr(f"CASE WHEN {P.is_filled(code_col)} THEN {ident(code_col)} END").alias("code")
    partial = (masked.select(code, *words).mapInArrow(_of_records(examples, words, states, flagged),
                                                      "state int, n long, codigos array<string>")
               .withColumn("fold", F.pmod(F.spark_partition_id(), F.lit(FOLDS))))
    # The states of every FOLDS-th task, then one per fold.
    folded = partial.groupBy("state", "fold").agg(F.sum("n").alias("n"), _first(examples).alias("codigos"))
    # Constants of the state's number (a table of them would be made by Python workers).
    campo, estado = (F.expr(f"element_at(array({', '.join(lit(name[i]) for name in names)}), state + 1)") for i in (1, 2))
    return merge_states(folded.select("n", "codigos", campo.alias("campo"), estado.alias("estado")), examples)


def _first(k: int) -> Column:
    """The first ``k`` of several short lists of codes."""
    return F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("codigos")))), 1, k)


def merge_states(states: DataFrame, examples: int = K.EXAMPLE_CODES) -> DataFrame:
    """States of several sets of records (the union of their tables) as one.  A run
    brings one row of at most ``examples`` codes per field and state."""
    return states.groupBy("campo", "estado").agg(F.sum("n").alias("n"), _first(examples).alias("codigos"))


def profile_of_states(states: DataFrame, fields: Sequence[str]) -> DataFrame:
    """PF1..PF7 from a state."""
    # At most 3 len(fields) + 1 small rows: one struct of the whole profile.
    found = states.agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat_ws("/", "estado", "campo"), F.struct("n", "codigos")))).alias("m"))

    named = F.array(*[F.struct(F.lit(f).alias("campo"), F.lit(category_of(f)).alias("CATEGORIA")) for f in fields])
    long = found.select("m", F.inline(named))

    def at(state: str, part: str) -> Column:
        return F.element_at("m", F.concat(F.lit(f"{state}/"), F.col("campo")))[part]

    def count(state: str) -> Column:
        return F.coalesce(at(state, "n"), F.lit(0).cast("long"))

    none = F.expr("CAST(array() AS ARRAY<STRING>)")
    long = long.select(
        "campo", "CATEGORIA", F.coalesce(F.element_at("m", F.lit(f"{ALL}/"))["n"], F.lit(0).cast("long")).alias("_n"),
        count(NULL_STATE).alias("CANT_NULL"), count(BLANK_STATE).alias("CANT_VACIO"), count(FLAGGED_STATE).alias("CANT_INCONSISTENTES"),
        F.coalesce(at(NULL_STATE, "codigos"), none).alias("CODIGOS_NULL_EJEMPLO"),
        F.coalesce(at(BLANK_STATE, "codigos"), none).alias("CODIGOS_VACIO_EJEMPLO"))
    n = F.col("_n")
    return long.select(
        "campo", "CATEGORIA", "CANT_NULL", "CANT_VACIO", "CANT_INCONSISTENTES",
        pct_half_up(n - F.col("CANT_NULL") - F.col("CANT_VACIO"), n).alias("PCT_COMPLETITUD"),
        pct_half_up(F.col("CANT_NULL"), n).alias("PCT_NULL"),
        pct_half_up(F.col("CANT_INCONSISTENTES"), n).alias("PCT_INCONSISTENTE"),
        "CODIGOS_NULL_EJEMPLO", "CODIGOS_VACIO_EJEMPLO",
    ).withColumn("CALIDAD_CAMPO", quality_band(F.col("PCT_COMPLETITUD"))).select(*PROFILE_COLUMNS)


def field_profile(masked: DataFrame, layout: Layout, fields: Sequence[str] = K.FIELDS, code_col: str = "CODIGO",
                  examples: int = K.EXAMPLE_CODES) -> DataFrame:
    """PF1..PF7: ``resumen_por_campo`` of a table with masks; the first ``examples``
    codes are shown per field and state."""
    return profile_of_states(profile_states(masked, layout, fields, code_col, examples), fields)


# Views ------------------------------------------------------------------------------

def worst_fields(profile: DataFrame, n: int = 10) -> DataFrame:
    """PF8: lowest completeness first (ties by name)."""
    return profile.orderBy(F.asc_nulls_last("PCT_COMPLETITUD"), "campo").limit(n)


def critical_fields(profile: DataFrame) -> DataFrame:
    """PF9: fields whose completeness band is CRÍTICA (< 40 %)."""
    return profile.filter(F.col("CALIDAD_CAMPO") == K.QUALITY_BANDS[0][1])


def mandatory_below(profile: DataFrame, pct: float = 95) -> DataFrame:
    """PF9: mandatory fields with completeness under ``pct``."""
    return profile.filter((F.col("CATEGORIA") == "OBLIGATORIO") & (F.col("PCT_COMPLETITUD") < pct))


def null_above(profile: DataFrame, pct: float = 20) -> DataFrame:
    """PF9: fields with more than ``pct`` percent NULL."""
    return profile.filter(F.col("PCT_NULL") > pct)


def excellent_fields(profile: DataFrame) -> DataFrame:
    """PF9: fields in the top band."""
    return profile.filter(F.col("CALIDAD_CAMPO") == K.QUALITY_TOP)


def one_field(profile: DataFrame, campo: str) -> DataFrame:
    """PF9: the profile row of one field."""
    return profile.filter(F.col("campo") == campo)


def category_averages(profile: DataFrame) -> DataFrame:
    """PF10: average percents per category.  Percents are exact hundredths,
    so they are averaged as integer hundredths (order-independent sums)."""
    def avg_of(c: str) -> Column:
        hundredths = F.round(F.col(c) * 100).cast("long")
        return (F.sum(hundredths).cast("double") / F.count(c) / F.lit(100.0))

    return profile.groupBy("CATEGORIA").agg(
        avg_of("PCT_COMPLETITUD").alias("PCT_COMPLETITUD_PROMEDIO"),
        avg_of("PCT_NULL").alias("PCT_NULL_PROMEDIO"),
        avg_of("PCT_INCONSISTENTE").alias("PCT_INCONSISTENTE_PROMEDIO"),
    )
