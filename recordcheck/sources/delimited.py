"""Delimited text in and out (SRC1, SRC2, SNK2).

The audited table arrives as a ``;``-separated file with a header.  Every
column is read as a nullable string with an explicit schema (no inference
pass over the data): the names of the first file's header, or a fixed list.
``enforceSchema=False`` makes Spark check every file's header against that
schema instead of trusting positions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordcheck.schema import string_schema


def header_of(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> list[str]:
    """Column names of a delimited file (reads one line)."""
    return spark.read.option("header", True).option("sep", sep).option("encoding", encoding).csv(path).columns


def read_delimited(spark: SparkSession, path: str, fields: Sequence[str] | None = None,
                   sep: str = ";", ignore_corrupt_files: bool = False,
                   encoding: str = "UTF-8") -> DataFrame:
    """SRC1 (+ SRC2 when ``ignore_corrupt_files``: rows of unreadable files are
    left out): read the audited table.  Columns are those of the header, in its
    order; with ``fields`` (e.g. ``constants.FIELDS``) the header must be exactly
    these.

    Missing values and ``""`` become NULL; whitespace-only text survives (it is
    the blank state).  Short lines are padded with NULL.
    """
    names = list(fields) if fields is not None else header_of(spark, path, sep, encoding)
    reader = (spark.read.schema(string_schema(names))
              .option("header", True)
              .option("sep", sep)
              .option("enforceSchema", False)
              .option("encoding", encoding)
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False)
              .option("mode", "PERMISSIVE"))
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", True)
    return reader.csv(path)


CORRUPT = "_rc_corrupt"
REJECTED_COLUMNS = ("ARCHIVO", "MOTIVO", "CAMPOS", "LINEA")
LINE_SHORT, LINE_LONG, LINE_BROKEN, LINE_BYTES, FILE_DAMAGED = (
    "LINEA_CORTA", "LINEA_LARGA", "LINEA_ILEGIBLE", "NO_DECODIFICABLE", "ARCHIVO_DANADO")


def read_quarantined(spark: SparkSession, path: str, fields: Sequence[str] | None = None, sep: str = ";",
                     header: bool = True, encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """SRC1 / SRC2 without loss: (rows, rejected).  ``rows`` are the lines with
    exactly the fields of the table, as ``read_delimited`` gives them; every other
    line is a row of ``rejected`` (file, reason, number of fields, text):
    fewer or more fields than the header, not parseable, or bytes that are no text
    in ``encoding`` (they show as U+FFFD, as does a real one).

    Both are lazy; columns are not pruned below the parser, since a pruned parse
    would no longer see that a line is short or long."""
    names = list(fields) if fields is not None else header_of(spark, path, sep, encoding)
    schema = string_schema(names).add(T.StructField(CORRUPT, T.StringType(), True))
    lines = (spark.read.schema(schema)
             .option("header", header).option("sep", sep).option("enforceSchema", not header).option("encoding", encoding)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
             .csv(path))
    text = F.coalesce(F.col(CORRUPT), F.concat_ws(sep, *[F.coalesce(lines[f"`{n}`"], F.lit("")) for n in names]))
    undecoded = text.contains("\ufffd")
    lines = lines.select("*", F.col("_metadata.file_path").alias("_rc_file"), text.alias("_rc_line"), undecoded.alias("_rc_bytes"))
    good = lines.filter(F.col(CORRUPT).isNull() & ~F.col("_rc_bytes")).select(*[F.col(f"`{n}`") for n in names])
    # Separators outside of quoted parts.
    bare = F.regexp_replace("_rc_line", r'"(?:[^"\\]|\\.|"")*"', "")
    count = (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1
    n, bad = F.col("CAMPOS"), F.col(CORRUPT).isNotNull()
    reason = (F.when(bad & (n < len(names)), LINE_SHORT).when(bad & (n > len(names)), LINE_LONG)
              .when(F.col("_rc_bytes"), LINE_BYTES).otherwise(LINE_BROKEN))
    rejected = (lines.filter(bad | F.col("_rc_bytes")).withColumn("CAMPOS", count.cast("long"))
                .select(F.col("_rc_file").alias("ARCHIVO"), reason.alias("MOTIVO"), "CAMPOS", F.col("_rc_line").alias("LINEA")))
    return good, rejected


def _gzip_state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unpack every file to its end, a piece at a time, keeping nothing."""
    for batch in batches:
        damaged, readable = [], []
        for cell in batch.column("content"):
            data, at, size, ok = memoryview(cell.as_buffer()), 0, 0, True
            try:
                while at < len(data):
                    member = zlib.decompressobj(wbits=31)
                    while not member.eof:
                        if at >= len(data):
                            raise EOFError
                        piece = data[at:at + (1 << 20)]
                        size += len(member.decompress(piece))
                        at += len(piece) - len(member.unused_data)
            except (zlib.error, EOFError):
                ok = False
            damaged.append(not ok)
            readable.append(size)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(damaged), pa.array(readable, pa.int64())],
                                         names=["ARCHIVO", "DANADO", "BYTES_LEGIBLES"])


def damaged_files(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """SRC2: the gzip files under ``path`` that do not unpack to their end, with the
    bytes that can be read: (ARCHIVO, MOTIVO, BYTES_LEGIBLES).  One task checks one
    file (gzip cannot be split when it is read either); files of 2 GB and more are
    refused by the reader."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    found = files.mapInArrow(_gzip_state, "ARCHIVO string, DANADO boolean, BYTES_LEGIBLES long")
    return found.filter("DANADO").select("ARCHIVO", F.lit(FILE_DAMAGED).alias("MOTIVO"), "BYTES_LEGIBLES")


def write_delimited(df: DataFrame, path: str, sep: str = ";", single_file: bool = False,
                    mode: str = "overwrite") -> None:
    """SNK2: header + separator.  ``single_file`` funnels all rows through one
    task and is meant for small outputs (spreadsheet hand-off) only."""
    out = text_ready(df)
    out = out.coalesce(1) if single_file else out
    (out.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path))


def text_ready(df: DataFrame, sep: str = ", ") -> DataFrame:
    """Array columns joined into text, so the frame fits a delimited file."""
    cols = [F.array_join(F.col(f.name), sep).alias(f.name) if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)
