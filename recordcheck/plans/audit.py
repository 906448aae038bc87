"""The audit run: evaluate once, derive every output from that.

``Audit(df)`` evaluates the catalogue over ``df`` into bit masks (see
``operators.masks``).  With ``materialize=True`` (the default for production runs)
record ids and masks are written as parquet under the session's checkpoint
folder and read back: five numbers a record for the 171 rules, from which the
summary, detail, report, views, totals and profile all follow.

With ``materialize=False`` everything stays one lazy plan.  That suits a
single projection or aggregation (the summary, totals), but do not filter it
on a counter: the optimizer pushes the filter below the projections and
substitutes the rules into the predicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.operators import aggregates as AG
from recordcheck.operators import detail as D
from recordcheck.operators import profile as PF
from recordcheck.operators import views as VW
from recordcheck.functions.sql import ident
from recordcheck.operators.evaluate import DEFAULT_BLOCK, evaluate, layout_of, observations_column
from recordcheck.operators.detail import ROW_ID
from recordcheck.operators.masks import Layout, with_masks
from recordcheck.operators.summary import RECORD_ID, executive_summary, mask_summary
from recordcheck.plans.catalog_party import Catalog, party_catalog
from recordcheck.schema import OBS_COL
from recordcheck.sources.delimited import write_delimited
from recordcheck.sources.storage import (delete_path, lookup_options, publish, run_path, scratch_path,
                                         scratch_table, side_by_side, staging_path, write_parquet)

STATES = "perfil_estados"       # output that holds the mergeable state of the profile


class Audit:
    def __init__(self, df: DataFrame, catalog: Catalog | None = None, keys: Sequence[str] = (),
                 materialize: bool = True, block_size: int = DEFAULT_BLOCK,
                 spread: int | None = None, record_id: Sequence[str] = RECORD_ID):
        self.spark = df.sparkSession
        self.source = df
        self.catalog = catalog or party_catalog(df.columns)
        self.keys = tuple(keys)
        self.materialize = materialize
        self.block_size = block_size
        # rule evaluation is CPU-bound: an input of few partitions (one small file)
        # may be dealt round-robin to ``spread`` partitions first; off by default
        self.spread = spread
        # columns that identify a record in the outputs; the first is its code
        self.record_id = tuple(record_id)
        self._masked: DataFrame | None = None
        self._layout: Layout | None = None
        self._scratch: str | None = None

    # evaluation ----------------------------------------------------------------

    @property
    def layout(self) -> Layout:
        """Which bit of the masks is whose."""
        if self._layout is None:
            self._layout = layout_of(self.source, self.catalog.rules, self.catalog.fields)
        return self._layout

    def _input(self) -> DataFrame:
        return self.source.repartition(self.spread) if self.spread else self.source

    def evaluated(self) -> DataFrame:
        """Input columns + OBS_ARRAY (lazy; not materialized)."""
        return evaluate(self._input(), self.catalog.rules, self.catalog.fields, block_size=self.block_size)

    @property
    def masked(self) -> DataFrame:
        """Keys, record id and masks, materialized when asked.  The audited
        columns themselves are not stored again."""
        if self._masked is None:
            names = list(dict.fromkeys((*self.keys, *self.record_id)))
            masked = with_masks(self._input(), self.layout).select(*[ident(c) for c in names], *self.layout.columns)
            if self.materialize:
                # A stored row id: the last sort key of ordered outputs, so the
                # range partitioner can split a hot CODIGO across partitions.
                # Assigned once at write time, then read back: deterministic.
                masked = masked.withColumn(ROW_ID, F.monotonically_increasing_id())
                self._scratch = scratch_path(self.spark, "masked")
                masked = scratch_table(self.spark, masked, "masked", self._scratch)
            self._masked = masked
        return self._masked

    @property
    def scored(self) -> DataFrame:
        """Keys, record id, OBS_ARRAY and SM1..SM10 of every record, from the masks."""
        kept = [ident(c) for c in self.masked.columns if c not in self.layout.columns]
        return self.masked.select(*kept, self._observations(), *mask_summary(self.layout))

    def _observations(self):
        return observations_column(self.layout, self.catalog.fields, self.block_size).alias(OBS_COL)

    def release(self) -> None:
        """Delete the materialized evaluation (outputs already written stay)."""
        if self._scratch:
            delete_path(self.spark, self._scratch)
        self._scratch, self._masked = None, None

    def __enter__(self) -> "Audit":
        return self

    def __exit__(self, *exc) -> None:
        self.release()

    # outputs -------------------------------------------------------------------

    def summary(self) -> DataFrame:
        return executive_summary(self.scored, self.keys, self.record_id)

    def detail(self, order: str = "global") -> DataFrame:
        return D.mask_detail(self.masked, self.layout, self.catalog.fields, self.keys, order, self.record_id)

    def report(self, order: str = "global") -> DataFrame:
        return D.mask_report(self.masked, self.layout, self.catalog.fields, self.keys, order, self.record_id[0])

    def critical(self) -> DataFrame:
        return VW.critical_records(self.summary())

    def dependencies(self) -> DataFrame:
        return VW.dependency_records(self.summary())

    def inconsistencies(self) -> DataFrame:
        return VW.inconsistent_records(self.summary())

    def clean(self) -> DataFrame:
        return VW.clean_records(self.summary())

    def heavy_records(self, threshold: int = K.HEAVY_RECORD_THRESHOLD, limit: int | None = None) -> DataFrame:
        """SO4, ordered with the stored row id as the last key (skew-safe)."""
        carry = [ROW_ID] if ROW_ID in self.masked.columns else []
        rows = executive_summary(self.scored, self.keys + tuple(carry), self.record_id)
        return VW.heavy_records(rows, threshold, limit, tiebreak=carry[0] if carry else None,
                                code=self.record_id[0])

    def record_counts(self) -> DataFrame:
        return AG.record_counts(self.summary())

    def type_totals(self) -> DataFrame:
        return AG.type_totals(self.summary())

    def rule_counts(self) -> DataFrame:
        """Observations per rule that fired: CAMPO, TIPO_VERIFICACION, count."""
        return AG.rule_counts(self.masked, self.layout)

    def field_counts(self) -> DataFrame:
        return AG.field_counts(self.rule_counts())

    def top_fields(self, k: int = K.TOP_FIELDS_K) -> DataFrame:
        return AG.top_fields(self.rule_counts(), k)

    def field_type_counts(self) -> DataFrame:
        return AG.field_type_counts(self.rule_counts())

    def profile(self, examples: int = K.EXAMPLE_CODES) -> DataFrame:
        """PF1..PF7 with up to ``examples`` example codes per field and state."""
        return PF.field_profile(self.masked, self.layout, self._profiled(), self.record_id[0], examples)

    def profile_states(self, examples: int = K.EXAMPLE_CODES) -> DataFrame:
        """The mergeable state of the profile (``operators.profile.merge_states``)."""
        return PF.profile_states(self.masked, self.layout, self._profiled(), self.record_id[0], examples)

    def _profiled(self) -> tuple[str, ...]:
        return tuple(f for f in self.catalog.fields if f in self.layout.fields)

    # sinks ---------------------------------------------------------------------

    def write(self, root: str, run_id: str = K.DEFAULT_RUN_ID, csv: bool = False,
              csv_single_file: bool = False, extra: dict[str, DataFrame] | None = None,
              row_group_bytes: int | None = None) -> str:
        """SNK1 (+ SNK2 when ``csv``): the six parquet outputs and the mergeable
        profile state under ``<root>/resultados_<run_id>``, plus ``extra`` tables.
        Everything is staged first: a run that fails leaves the former outputs as
        they were.  Detail and report files hold disjoint, sorted ranges of
        (code, field), and row groups carry a Bloom filter of their codes, so a
        reader of one code skips the others; the views and the CSV copies are
        made from the parquet files.  Outputs are written side by side in three
        rounds: profile states and summary; the views of the summary; field profile,
        detail and report.  No round begins after a write has failed."""
        out = run_path(root, run_id)
        staged = staging_path(out)
        try:
            self._write_staged(staged, csv, csv_single_file, extra or {}, row_group_bytes)
            publish(self.spark, staged, out)
        except BaseException:
            delete_path(self.spark, staged)
            raise
        return out

    def _write_staged(self, staged: str, csv: bool, csv_single_file: bool, extra: dict[str, DataFrame],
                      row_group_bytes: int | None) -> None:
        by_code = lookup_options(self.record_id[0], row_group_bytes)
        schemas = {}

        def put(name: str, df: DataFrame) -> None:
            schemas[name] = df.schema
            write_parquet(df, f"{staged}/{name}", **(by_code if self.record_id[0] in df.columns else {}))

        def written(name: str) -> DataFrame:
            return self.spark.read.schema(schemas[name]).parquet(f"{staged}/{name}")

        self.masked                                     # evaluated once, before the outputs share it
        side_by_side(self.spark,
                     lambda: write_parquet(self.profile_states(), f"{staged}/{STATES}"),
                     lambda: put("resumen_ejecutivo", self.summary()))
        states = self.spark.read.schema(PF.STATE_SCHEMA).parquet(f"{staged}/{STATES}")
        summary = written("resumen_ejecutivo")
        side_by_side(self.spark,
                     lambda: put("registros_criticos", VW.critical_records(summary)),
                     lambda: put("registros_con_dependencias", VW.dependency_records(summary)))
        side_by_side(self.spark,
                     lambda: put("resumen_por_campo", PF.profile_of_states(states, self._profiled())),
                     lambda: put("detalle_observaciones", self.detail(order="range")),
                     lambda: put("reporte_auditoria", self.report(order="range")))
        for name, df in extra.items():
            put(name, df)
        if csv:
            for name in ("reporte_auditoria", "resumen_por_campo", "resumen_ejecutivo"):
                write_delimited(written(name), f"{staged}/{name}_csv", single_file=csv_single_file)


def merged_profile(spark: SparkSession, runs: Sequence[str], fields: Sequence[str] = K.FIELDS,
                   examples: int = K.EXAMPLE_CODES) -> DataFrame:
    """PF1..PF7 over all records of several written runs (paths that ``Audit.write``
    returned), from their stored states; no record is read again."""
    states = spark.read.schema(PF.STATE_SCHEMA).parquet(*[f"{run}/{STATES}" for run in runs])
    return PF.profile_of_states(PF.merge_states(states, examples), fields)
