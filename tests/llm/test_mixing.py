"""Mixing: targets, selection and repeats against brute force."""

import pytest
from pyspark.sql import functions as F

from recordcheck.llm import mixing as M
from tests.llm.conftest import docs_frame


def fill(sizes, weights, total):
    """Targets by repeated sharing of the excess."""
    targets = [0.0] * len(sizes)
    capped, left = set(), total
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        if not free:
            return targets
        share = left / sum(weights[i] for i in free)
        over = [i for i in free if share * weights[i] > 2 * sizes[i]]
        if not over:
            for i in free:
                targets[i] = share * weights[i]
            return targets
        for i in over:
            targets[i] = 2.0 * sizes[i]
            left -= targets[i]
            capped.add(i)


@pytest.mark.parametrize("sizes", [[100, 10, 1000], [5, 5, 5, 5], [1, 0, 0, 10_000, 3], [7], [0, 0]])
def test_targets(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes))]
    df = spark.createDataFrame([(n if i else None, s) for i, (n, s) in enumerate(zip(names, sizes))], "source string, source_size long")
    order = sorted(range(len(sizes)), key=lambda i: (i == 0, names[i]))          # null (the first) comes last
    weights = [0] * len(sizes)
    for place, i in enumerate(order):
        weights[i] = M.SOURCE_WEIGHTS[place % 3]
    want = fill(sizes, weights, 1.5 * sum(sizes))
    got = {r["source"]: r["target"] for r in M.source_targets(df).collect()}
    for i, n in enumerate(names):
        assert got[n if i else None] == pytest.approx(want[i])


def test_selection_is_the_prefix_in_key_order(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 7)                                       # many parts
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        (F.col("id") % 17).alias("size"), (-F.log((F.xxhash64("id") % 10**6 + 10**6 + 0.5) / (2 * 10**6 + 1))).alias("key"))
    targets = M.source_targets(items.groupBy("source").agg(F.sum("size").alias("source_size")))
    plan = {r["source"]: r for r in M.cutoffs(items, targets).collect()}
    for source, p in plan.items():
        rows = sorted((r["key"], r["size"]) for r in items.filter(F.col("source") == source).collect())
        rest, before, want = p["target"] - p["epochs"] * p["source_size"], 0, []
        for key, size in rows:
            if 2 * before + size <= 2 * rest:
                want.append(key)
            before += size
        got = [k for k, _ in rows if p["cutoff"] is not None and (k <= p["cutoff"] if p["inclusive"] else k < p["cutoff"])]
        assert got == want, source
        assert abs(sum(s for k, s in rows if k in set(got)) - rest) <= 17


def test_mix_repeats_rows_and_keeps_columns(spark, odd_docs):
    df = docs_frame(spark, odd_docs, extra=("target", "epochs", "cutoff", "cell"))
    items, plan = M.plan(df)
    out = M.mix(df)
    assert out.columns == df.columns
    sizes = {r["source"]: 0 for r in plan.collect()}
    for r in out.collect():
        sizes[r["source"]] += len((r["text"] or "").split())
        assert r["target"] == f"own-{r['doc_id'] if r['doc_id'] is not None else 'null'}"
    for p in plan.collect():
        longest = max(r["size"] for r in items.filter(F.col("source").eqNullSafe(F.lit(p["source"]))).collect())
        assert abs(sizes[p["source"]] - p["target"]) <= 2 * longest
    again = M.mix(df).groupBy("doc_id").count().collect()
    assert sorted(map(str, again)) == sorted(map(str, out.groupBy("doc_id").count().collect()))
    assert M.mix(df.limit(0)).count() == 0
