"""Outputs that survive a failed run, lookups that skip row groups, quarantine."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.plans import audit as A
from recordcheck.plans.audit import Audit
from recordcheck.sources import delimited as D
from recordcheck.sources import storage as S


# Overwrite -------------------------------------------------------------------------

def test_a_failed_run_leaves_the_former_outputs(spark, party_small, monkeypatch):
    root = tempfile.mkdtemp(prefix="rc-safe-")
    with Audit(party_small, keys=("k",)) as first:
        out = first.write(root)
    before = {n: spark.read.parquet(f"{out}/{n}").count() for n in ("resumen_ejecutivo", "reporte_auditoria", "resumen_por_campo")}
    written = []
    real = A.write_parquet

    def half_way(df, path, *args, **options):
        if len(written) == 3:
            df = df.withColumn("_bad", F.expr("raise_error('lost')"))       # dies while files are written
        written.append(path)
        real(df, path, *args, **options)

    monkeypatch.setattr(A, "write_parquet", half_way)
    with Audit(party_small.limit(10), keys=("k",)) as second:
        with pytest.raises(Exception, match="lost"):
            second.write(root)
    assert len(written) == 4
    assert {n: spark.read.parquet(f"{out}/{n}").count() for n in before} == before
    assert os.path.exists(f"{out}/{S.COMPLETE}")
    assert os.listdir(root) == [os.path.basename(out)]                       # nothing staged is left
    monkeypatch.undo()
    with Audit(party_small.limit(10), keys=("k",)) as third:
        assert third.write(root) == out
    assert spark.read.parquet(f"{out}/resumen_ejecutivo").count() == 10
    assert os.listdir(root) == [os.path.basename(out)]


def test_renames_are_taken_back(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="rc-safe-")
    out, staged = f"{root}/resultados_1", S.staging_path(f"{root}/resultados_1")
    spark.range(3).write.parquet(f"{out}/t")
    with pytest.raises(Exception):
        S.publish(spark, f"{root}/nowhere\0", out)                           # cannot be marked or moved
    assert spark.read.parquet(f"{out}/t").count() == 3
    # the driver died between the renames: the former outputs come back
    os.rename(out, f"{root}/_former-resultados_1")
    S.recover(spark, out)
    assert spark.read.parquet(f"{out}/t").count() == 3
    # ... or it died before it deleted them
    os.makedirs(f"{root}/_former-resultados_1")
    spark.range(5).write.parquet(f"{staged}/t")
    S.publish(spark, staged, out)
    assert spark.read.parquet(f"{out}/t").count() == 5 and os.listdir(root) == ["resultados_1"]


# Lookups ---------------------------------------------------------------------------

def rows_read(df):
    """Rows that leave the scan: what skipped row groups and pages leave over."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


def test_lookup_reads_a_small_share(spark, party_small):
    root = tempfile.mkdtemp(prefix="rc-look-")
    # names in no order, so ranges of row groups do not tell codes apart
    df = party_small.withColumn("CODIGO", F.md5(F.col("k").cast("string")))
    with Audit(df.repartition(6, "k"), keys=("k",)) as audit:
        out = audit.write(root, row_group_bytes=16 << 10)
    code = df.filter("k = 700").first()["CODIGO"]
    for name in ("detalle_observaciones", "reporte_auditoria", "resumen_ejecutivo"):
        table = f"{out}/{name}"
        total = spark.read.parquet(table).count()
        found = S.lookup(spark, table, code)
        want = spark.read.parquet(table).filter(F.concat("CODIGO", F.lit("")) == code).count()
        assert found.count() == want
        assert rows_read(found) <= total / 4, name
        assert rows_read(S.lookup(spark, table, "no such code")) == 0, name


# Quarantine --------------------------------------------------------------------------

def test_damaged_lines_come_out_as_rows(spark):
    base = tempfile.mkdtemp(prefix="rc-q-")
    with open(f"{base}/a.csv", "wb") as f:
        f.write(b"CODIGO;NIT;NOTA\nC1;1;x\nC2;2\nC3;3;y;z;w\nC4;4;caf\xe9\nC5;5;\"a;b\"\n;;\nC6;6;caf\xc3\xa9\n")
    with open(f"{base}/b.csv", "wb") as f:
        f.write(b"CODIGO;NIT;NOTA\nD1;1;\"x;y\";1;2\nD2;2;ok\n")
    rows, rejected = D.read_quarantined(spark, base)
    assert rows.columns == ["CODIGO", "NIT", "NOTA"]
    assert sorted((r["CODIGO"] or "", r["NOTA"]) for r in rows.collect()) == [
        ("", None), ("C1", "x"), ("C5", "a;b"), ("C6", "café"), ("D2", "ok")]
    assert rows.select("CODIGO").filter("CODIGO IS NOT NULL").count() == 4       # pruned reads see the same lines
    assert rows.count() == 5
    got = sorted((os.path.basename(r["ARCHIVO"]), r["LINEA"], r["MOTIVO"], r["CAMPOS"]) for r in rejected.collect())
    assert got == [("a.csv", "C2;2", D.LINE_SHORT, 2), ("a.csv", "C3;3;y;z;w", D.LINE_LONG, 5), ("a.csv", "C4;4;caf�", D.LINE_BYTES, 3),
                   ("b.csv", 'D1;1;"x;y";1;2', D.LINE_LONG, 5)]
    assert tuple(rejected.columns) == D.REJECTED_COLUMNS


def test_damaged_gzip_is_reported(spark):
    base = tempfile.mkdtemp(prefix="rc-gz-")
    text = ("CODIGO;NIT\n" + "".join(f"C{i};{i * 7919}\n" for i in range(30_000))).encode()
    whole = gzip.compress(text)
    files = {"whole.csv.gz": whole, "two.csv.gz": whole + gzip.compress(b"C;1\n"), "cut.csv.gz": whole[:len(whole) // 2],
             "bits.csv.gz": whole[:5000] + b"\0\0\0\0" + whole[5004:], "empty.csv.gz": b""}
    for name, data in files.items():
        with open(f"{base}/{name}", "wb") as f:
            f.write(data)
    got = {os.path.basename(r["ARCHIVO"]): r for r in D.damaged_files(spark, base).collect()}
    assert set(got) == {"cut.csv.gz", "bits.csv.gz"}
    assert all(r["MOTIVO"] == D.FILE_DAMAGED and r["BYTES_LEGIBLES"] < len(text) for r in got.values())
    assert got["cut.csv.gz"]["BYTES_LEGIBLES"] > len(text) // 4


def test_command_line_quarantine(spark, party_small):
    from recordcheck.__main__ import main

    base = tempfile.mkdtemp(prefix="rc-cli-q-")
    os.makedirs(f"{base}/in")
    rows = [["" if c is None else c for c in r] for r in party_small.drop("k").limit(30).collect()]
    with open(f"{base}/in/a.csv", "w", encoding="utf-8") as f:
        f.write(";".join(K.FIELDS) + "\n")
        for n, r in enumerate(rows):
            f.write(";".join(r[:20] if n % 10 == 3 else r) + "\n")
    out = main(["--input", f"{base}/in", "--output", f"{base}/out", "--quarantine"], spark=spark)
    assert spark.read.parquet(f"{out}/resumen_ejecutivo").count() == 27
    bad = spark.read.parquet(f"{out}/lineas_rechazadas").collect()
    assert len(bad) == 3 and {r["MOTIVO"] for r in bad} == {D.LINE_SHORT} and {r["CAMPOS"] for r in bad} == {20}


# Writing the outputs -------------------------------------------------------------------

def test_views_are_made_from_the_written_summary(spark, party_small, monkeypatch):
    """The lists of the summary are built once, not once more for every view."""
    from recordcheck.operators import views as VW

    read = {}
    for name in ("critical_records", "dependency_records"):
        def view(summary, name=name, made=getattr(VW, name)):
            read[name] = summary.inputFiles()
            return made(summary)
        monkeypatch.setattr(VW, name, view)
    with Audit(party_small, keys=("k",)) as audit:
        out = audit.write(tempfile.mkdtemp(prefix="rc-views-"))
        monkeypatch.undo()
        want = {"registros_criticos": audit.critical(), "registros_con_dependencias": audit.dependencies()}
        for name, df in want.items():
            got = spark.read.parquet(f"{out}/{name}")
            assert got.columns == df.columns and got.count() > 0
            assert got.exceptAll(df).count() == df.exceptAll(got).count() == 0
    assert len(read) == 2
    assert all(files and all("/resumen_ejecutivo/" in f for f in files) for files in read.values())


def test_outputs_are_written_side_by_side(party_small, monkeypatch):
    """Detail and report begin without waiting for each other; a third write that
    fails leaves no outputs and no staged files."""
    import threading

    met, put = threading.Barrier(2, timeout=60), A.write_parquet

    def meet(df, path, **options):
        if path.endswith(("/detalle_observaciones", "/reporte_auditoria")):
            met.wait()
        put(df, path, **options)

    monkeypatch.setattr(A, "write_parquet", meet)
    root = tempfile.mkdtemp(prefix="rc-side-")
    with Audit(party_small, keys=("k",)) as audit:
        audit.write(root)

        def fail(df, path, **options):
            if path.endswith("/reporte_auditoria"):
                raise RuntimeError("disk full")
            put(df, path, **options)

        monkeypatch.setattr(A, "write_parquet", fail)
        other = tempfile.mkdtemp(prefix="rc-side-")
        with pytest.raises(RuntimeError, match="disk full"):
            audit.write(other)
    assert os.listdir(root) and not os.listdir(other)


def test_views_and_profile_do_not_wait_for_detail_and_report(party_small, monkeypatch):
    import threading

    put, early = A.write_parquet, {n: threading.Event() for n in ("resumen_por_campo", "registros_criticos", "registros_con_dependencias")}

    def late(df, path, **options):
        name = path.rpartition("/")[2]
        if name in ("detalle_observaciones", "reporte_auditoria"):
            assert all(done.wait(60) for done in early.values())
        put(df, path, **options)
        if name in early:
            early[name].set()

    monkeypatch.setattr(A, "write_parquet", late)
    with Audit(party_small, keys=("k",)) as audit:
        out = audit.write(tempfile.mkdtemp(prefix="rc-late-"))
    assert {"detalle_observaciones", "reporte_auditoria", *early} <= set(os.listdir(out))
