"""Audit files as they land: ``readStream`` of delimited text -> per-record
executive summary -> ``writeStream`` parquet (append).

Each micro-batch is one narrow projection (no shuffle, no state); the sink
and the checkpoint location must be on shared storage so a restarted query
resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from recordcheck import constants as K
from recordcheck.operators.evaluate import layout_of
from recordcheck.operators.masks import with_masks
from recordcheck.operators.summary import RECORD_ID, SUMMARY_COLUMNS, mask_summary
from recordcheck.plans.catalog_party import Catalog, party_catalog
from recordcheck.schema import string_schema


def audit_stream(spark: SparkSession, source_dir: str, fields: Sequence[str] = K.FIELDS,
                 keys: Sequence[str] = (), catalog: Catalog | None = None, sep: str = ";",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming executive summary of the delimited files under ``source_dir``."""
    reader = (spark.readStream.schema(string_schema(tuple(keys) + tuple(fields)))
              .option("header", True).option("sep", sep).option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.csv(source_dir)
    cat = catalog or party_catalog(src.columns)
    layout = layout_of(src, cat.rules, cat.fields)
    return with_masks(src, layout).select(*keys, *RECORD_ID, *mask_summary(layout)).select(*keys, *RECORD_ID, *SUMMARY_COLUMNS)


def start_audit_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                       available_now: bool = False, **kwargs) -> StreamingQuery:
    """Start the audit: append the summary rows to parquet under ``sink_dir``."""
    writer = (audit_stream(spark, source_dir, **kwargs).writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
