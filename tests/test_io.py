"""Delimited round trip and the parquet sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.plans.audit import Audit
from recordcheck.sources.delimited import read_delimited, write_delimited
from recordcheck.sources.storage import run_path


def test_csv_round_trip_keeps_null_and_blank(spark, party_small):
    out = tempfile.mkdtemp(prefix="rc-csv-")
    write_delimited(party_small, f"{out}/party")
    back = read_delimited(spark, f"{out}/party", fields=("k",) + K.FIELDS)
    back = back.withColumn("k", F.col("k").cast("long"))
    assert back.count() == party_small.count()
    assert back.exceptAll(party_small).count() == 0
    blanks = back.filter(F.col("CODIGO") == "   ").count()
    assert blanks == party_small.filter(F.col("CODIGO") == "   ").count() > 0


def test_header_names_are_checked(spark, party_small):
    out = tempfile.mkdtemp(prefix="rc-csv-")
    write_delimited(party_small.select("k", "CODIGO"), f"{out}/two")
    df = read_delimited(spark, f"{out}/two", fields=("k", "NIT"))
    try:
        df.collect()
        raised = False
    except Exception:
        raised = True
    assert raised


def test_write_all_outputs(spark, party_small):
    root = tempfile.mkdtemp(prefix="rc-out-")
    a = Audit(party_small, keys=("k",))
    path = a.write(root, run_id="20250630", csv=True)
    assert path == run_path(root, "20250630")
    names = {"resumen_ejecutivo", "detalle_observaciones", "reporte_auditoria", "resumen_por_campo",
             "registros_criticos", "registros_con_dependencias", "reporte_auditoria_csv",
             "resumen_por_campo_csv", "resumen_ejecutivo_csv"}
    assert names <= set(os.listdir(path))
    assert spark.read.parquet(f"{path}/resumen_ejecutivo").count() == 1500
    assert spark.read.parquet(f"{path}/resumen_por_campo").count() == 54


def test_release_deletes_the_scratch_table(spark, party_small):
    with Audit(party_small, keys=("k",)) as a:
        a.summary().count()
        scratch = a._scratch
        assert scratch and os.path.exists(scratch.replace("file:", ""))
    assert not os.path.exists(scratch.replace("file:", ""))


def test_parquet_source_round_trip(spark, party_small):
    from recordcheck.sources.storage import read_audited_parquet, write_parquet

    out = tempfile.mkdtemp(prefix="rc-pq-")
    write_parquet(party_small, f"{out}/party")
    back = read_audited_parquet(spark, f"{out}/party", keys=("k",))
    assert back.columns == ["k", *K.FIELDS]
    assert back.exceptAll(party_small).count() == 0


def test_command_line_audit(spark, party_small):
    from recordcheck.__main__ import main

    base = tempfile.mkdtemp(prefix="rc-cli-")
    write_delimited(party_small.drop("k"), f"{base}/in")
    out = main(["--input", f"{base}/in", "--output", f"{base}/out", "--run-id", "20251130"], spark=spark)
    assert out.endswith("resultados_20251130")
    assert spark.read.parquet(f"{out}/resumen_ejecutivo").count() == 1500
    assert spark.read.parquet(f"{out}/resumen_por_campo").count() == 54


def test_reordered_and_wider_files_are_audited(spark, party_small):
    from recordcheck.plans.catalog_party import party_catalog

    base = tempfile.mkdtemp(prefix="rc-hdr-")
    wide = party_small.select("NOTA", *reversed(K.FIELDS)) if "NOTA" in party_small.columns else party_small.select(
        F.when(F.col("k") % 2 == 0, F.lit("x")).alias("NOTA"), *reversed(K.FIELDS))
    write_delimited(wide, f"{base}/in")
    back = read_delimited(spark, f"{base}/in")
    assert back.columns == wide.columns
    cat = party_catalog(back.columns, header=True)
    a = Audit(back, catalog=cat)
    rows = {r["campo"]: r for r in a.profile().collect()}
    assert rows["NOTA"]["CANT_NULL"] == wide.filter("NOTA IS NULL").count() > 0
    assert rows["NIT"]["CANT_NULL"] == party_small.filter("NIT IS NULL").count()
    first = a.detail(order="none").filter("CAMPO = 'NOTA'").first()
    assert first["IDX_CAMPO"] == 0                    # position in the header
    try:
        read_delimited(spark, f"{base}/in", fields=K.FIELDS).collect()
        raised = False
    except Exception:
        raised = True
    assert raised                                     # the strict check is still there


def test_corrupt_files_are_left_out_only_when_asked(spark):
    import gzip

    base = tempfile.mkdtemp(prefix="rc-bad-")
    text = "CODIGO;NIT\n" + "".join(f"C{i};{i}\n" for i in range(5000))
    with gzip.open(f"{base}/a.csv.gz", "wb") as f:
        f.write(text.encode())
    whole = gzip.compress(text.replace("C", "D").replace("DODIGO", "CODIGO").encode())
    with open(f"{base}/b.csv.gz", "wb") as f:
        f.write(whole[: len(whole) // 2])
    good = read_delimited(spark, base, fields=("CODIGO", "NIT"), ignore_corrupt_files=True)
    codes = [r["CODIGO"] for r in good.collect()]
    assert sum(c.startswith("C") for c in codes) == 5000
    try:
        read_delimited(spark, base, fields=("CODIGO", "NIT")).collect()
        raised = False
    except Exception:
        raised = True
    assert raised


def test_sorted_files_hold_disjoint_ranges(spark, party_small):
    import glob

    root = tempfile.mkdtemp(prefix="rc-rng-")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        with Audit(party_small, keys=("k",)) as a:
            path = a.write(root)
    finally:
        spark.conf.unset(key)
    ranges = []
    for f in glob.glob(f"{path}/detalle_observaciones/part-*"):
        rows = [(r["CODIGO"] or "", r["IDX_CAMPO"]) for r in spark.read.parquet(f).select("CODIGO", "IDX_CAMPO").collect()]
        assert rows == sorted(rows)
        if rows:
            ranges.append((rows[0], rows[-1]))
    ranges.sort()
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from recordcheck.sources import storage

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.named

    class Session:
        conf, sparkContext = Conf(), Context()

    Context.named = None
    with pytest.raises(ValueError):
        storage.checkpoint_dir(Session())
    Context.named = "hdfs://shared/"
    assert storage.checkpoint_dir(Session()) == "hdfs://shared"
