"""Parquet sinks, run-stamped output paths and the shared scratch area.

A run's outputs are staged beside their place and moved there when all are
written (``publish``), so a run that fails leaves the former outputs.


Scratch tables (materialized evaluations) go under the folder the cluster
names in ``spark.checkpoint.dir``; only a local session (tests, a laptop) may go
without one and gets a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordcheck import constants as K

_LOCAL_SCRATCH: dict[str, str] = {}


def run_path(root: str, run_id: str = K.DEFAULT_RUN_ID) -> str:
    """SNK3: ``<root>/resultados_<run_id>``."""
    return f"{root.rstrip('/')}/resultados_{run_id}"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """SNK1; ``options``: options of the Parquet writer."""
    df.write.mode(mode).options(**options).parquet(path)


def side_by_side(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Runs the writes at the same time, each in a thread of the driver: one is planned
    while others run, and the last tasks of one do not keep cores idle.  All have ended
    when this returns; the first error is raised then."""
    with ThreadPoolExecutor(len(writes)) as pool:
        ended = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for one in ended:
        one.result()


def lookup_options(code: str = "CODIGO", row_group_bytes: int | None = None) -> dict[str, str]:
    """Writer options for tables that are searched by one code: a Bloom filter per
    row group, sized by the codes that are there, so a reader skips row groups
    without the code whatever the order of the rows."""
    out = {f"parquet.bloom.filter.enabled#{code}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    if row_group_bytes:
        out["parquet.block.size"] = str(row_group_bytes)
    return out


def lookup(spark: SparkSession, path: str, value: str, code: str = "CODIGO") -> DataFrame:
    """EX2 / EX3 over a written output: the rows of one code.  The comparison is
    pushed to the scan, which reads only row groups that can hold the code."""
    return spark.read.parquet(path).filter(F.col(code) == value)


COMPLETE = "_COMPLETE"         # marker of a folder of outputs that was written to its end


def staging_path(out: str) -> str:
    """A new folder beside ``out``; its name starts with ``_``, so readers of the
    root skip it."""
    root, _, name = out.rstrip("/").rpartition("/")
    return f"{root}/_staging-{name}-{uuid.uuid4().hex}"


def _former(out: str) -> str:
    root, _, name = out.rstrip("/").rpartition("/")
    return f"{root}/_former-{name}"


def publish(spark: SparkSession, staged: str, out: str) -> None:
    """``staged``, written to its end, becomes ``out`` in place of what was there:
    marker, former folder aside, staged folder in its place, former folder gone.
    Until the renames nothing of the former outputs is touched; if the second
    rename fails the first is taken back (and by ``recover`` if the driver dies
    between them)."""
    target, fs = _file_system(spark, out)
    source, _ = _file_system(spark, staged)
    former, _ = _file_system(spark, _former(out))
    fs.create(_file_system(spark, f"{staged}/{COMPLETE}")[0]).close()
    recover(spark, out)
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, former):
        raise OSError(f"cannot move {out} aside")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(former, target)
        raise OSError(f"cannot move {staged} to {out}")
    if replaced:
        fs.delete(former, True)


def recover(spark: SparkSession, out: str) -> None:
    """What an interrupted ``publish`` of ``out`` left: the former outputs go back if
    no new ones are in place, else they go."""
    target, fs = _file_system(spark, out)
    former, _ = _file_system(spark, _former(out))
    if fs.exists(former):
        if fs.exists(target):
            fs.delete(former, True)
        else:
            fs.rename(former, target)


def read_audited_parquet(spark: SparkSession, path: str, fields=K.FIELDS, keys=()) -> DataFrame:
    """The audited table stored as parquet: ``keys`` + ``fields``, every field
    as a string (non-string columns are cast, as a delimited read would give
    them).  Only these columns are read (pruned at the scan)."""
    df = spark.read.parquet(path)
    missing = [f for f in (*keys, *fields) if f not in df.columns]
    if missing:
        raise ValueError(f"audited table lacks columns: {missing}")
    return df.select(*keys, *[df[f].cast("string").alias(f) for f in fields])


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared folder: ``spark.checkpoint.dir``, or what
    ``sparkContext.setCheckpointDir`` named.  With neither, a local session gets
    a private temporary folder; a cluster must name one, since its executors
    do not share local folders."""
    context = spark.sparkContext
    named = (spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
             or context.getCheckpointDir())
    if named:
        return named.rstrip("/")
    if not (context.master or "").split("[")[0] == "local":
        raise ValueError("scratch tables need a folder that all executors share: set spark.checkpoint.dir")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="recordcheck-ckpt-")
    return _LOCAL_SCRATCH[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{checkpoint_dir(spark)}/recordcheck-{label}-{uuid.uuid4().hex}"
    hpath, fs = _file_system(spark, path)
    fs.deleteOnExit(hpath)
    return path


def scratch_table(spark: SparkSession, df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage (later actions read files, not the plan that made them)
    and survives executor loss, unlike a cached or locally checkpointed frame.
    """
    path = path or scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop FileSystem of the path
    (local, HDFS or object store alike)."""
    hpath, fs = _file_system(spark, path)
    return bool(fs.delete(hpath, True))
