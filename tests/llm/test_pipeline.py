"""The pipeline's stages on their own inputs, and the entry's guard."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
import corpus_pipeline as C
from recordcheck.llm import ngram_join, quality, registry, secret_scan
from recordcheck.sources.storage import scratch_table
from tests.conftest import ROOT, SMALL
from tests.llm.test_ngram import brute as brute_components
from tests.llm.test_secrets import brute as brute_spans


def test_stages_act_on_their_input(spark, small_docs):
    docs, seen = small_docs, {}
    for name, stage in C.STAGES:
        out = scratch_table(spark, stage(spark, docs, SMALL), f"test-{name}")
        if name != C.STAGES[-1][0]:
            assert out.columns == small_docs.columns
        seen[name] = (docs.collect(), out.collect())
        docs = out
    before, after = seen["quality_rules"]
    stats = quality.with_stats(small_docs)
    want = {r["doc_id"] for r in quality.judged(stats, quality.estimate(stats)).collect() if r["kept"]}
    assert {r["doc_id"] for r in after} == want and 0 < len(after) < len(before)
    before, after = seen["ngram_jaccard"]
    groups = brute_components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(str(r["doc_id"]) for r in after) == sorted({g[2] for g in groups})
    before, after = seen["secret_scan"]
    texts = {r["doc_id"]: r["text"] for r in after}
    assert len(after) == len(before)
    for r in before:
        assert (texts[r["doc_id"]] != r["text"]) == bool(brute_spans(r["text"]))
    before, after = seen["mix_sources"]
    assert {r["text"] for r in after} <= {r["text"] for r in before}
    words = sum(len((r["text"] or "").split()) for r in before)
    assert abs(sum(len((r["text"] or "").split()) for r in after) - 1.5 * words) < 0.25 * words
    before, after = seen["best_fit_packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


def test_run_gives_the_last_stage(spark):
    assert set(C.run(spark, SMALL).columns) >= {"doc_id", "piece", "sequence_id", "offset", "length"}


def test_queries_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in registry.queries()}
    assert set(registry.queries()) | {"pipeline"} <= names
    assert set(registry.oracle_sql()) == {"op4_warc_revisits", "op5_mix_sources", "op7_secret_scan", "op12_hard_negatives",
                                          "op13_conversation_trie"}


def test_oracles_match(spark):
    import duckdb

    from tools.compare_oracle import TABLES, canon

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for name, sql in registry.oracle_sql().items():
        df = registry.queries()[name](spark, SMALL)
        rows = [tuple(r) for r in df.collect()]
        res = con.execute(sql)
        columns = [d[0] for d in res.description]
        assert canon(df.columns, rows) == canon(columns, res.fetchall()), name


def test_entry_works_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "recordcheck", "oracle"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
