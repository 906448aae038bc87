"""Hash-prefix forest: recall and exact scores against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordcheck.llm import ann as N
from tests.conftest import MEDIUM


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def brute(ids, x, query, k):
    at = ids.index(query)
    score = {i: float((x[at] * x[j]).sum()) for j, i in enumerate(ids) if j != at}
    return sorted(score.items(), key=lambda s: (-s[1], s[0]))[:k]


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    got = {}
    for r in N.op8_hash_prefix_forest(spark, MEDIUM).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    rows = table.collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=float)
    assert set(got) == {i for i in ids if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        assert sorted(r for r, _, _ in found) == list(range(1, 21))
        want = brute(ids, x, q, 20)
        hit += len({i for i, _ in want} & {i for _, i, _ in found})
        exact = dict(brute(ids, x, q, len(ids)))
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, i, s in found)
    assert hit / (20 * len(got)) >= 0.9


def test_recall_on_clusters(spark, monkeypatch):
    """2,000 vectors in 40 tight clusters, several chunks; every query reaches 0.75, all together 0.9."""
    monkeypatch.setattr(N, "CHUNK", 300)
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(40, 32))
    x = (centers[rng.integers(0, 40, 2000)] + 0.2 * rng.normal(size=(2000, 32))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = {}
    for r in N.search(df, df.filter("vec_id % 20 = 0"), k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(scores, -np.inf)
    shares = [len(got[q] & set(np.argsort(-scores[q], kind="stable")[:20].tolist())) / 20 for q in range(0, 2000, 20)]
    assert np.mean(shares) >= 0.9 and min(shares) >= 0.75


def test_a_shared_vector_sends_few_ids(spark):
    """The rank limit acts before the shuffle: a task sends at most k + 1 ids of one vector."""
    df = frame(spark, [(i, [1.0, 2.0], 0) for i in range(3000)] + [(5000, [2.0, 1.0], 0)])
    classes = N._classes(df, "vec_id", "embedding", 20)
    assert {r["rep"]: r["ids"] for r in classes.collect()} == {0: list(range(21)), 5000: [5000]}
    plan = classes.limit(9)._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and "Final" in limits[0] and "Partial" in limits[1]


def test_many_chunks_ties_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 60)
    monkeypatch.setattr(N, "FIRST", 25)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.2, 3)).astype(np.float32).tolist(), 0) for i in range(600)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(300)]                       # one very common vector
    rows += [(2000 + i, rng.normal(size=5).astype(np.float32).tolist(), 1) for i in range(10)]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 8, 0), (3003, [float("nan")] * 8, 0), (3004, [float("inf")] + [1.0] * 7, 0),
             (None, [1.0] * 8, 0)]
    df = frame(spark, rows)
    got = {}
    for r in N.search(df, df.filter((F.col("vec_id") % 20 == 0)), k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for dim in (8, 5):
        some = [r for r in rows if r[0] is not None and r[0] < 3000 and len(r[1]) == dim]
        ids, x = [r[0] for r in some], np.array([r[1] for r in some], dtype=np.float32).astype(float)
        for q in (i for i in ids if i % 20 == 0):
            want = brute(ids, x, q, 20)
            found = [i for _, i, _ in sorted(got[q])]
            assert len(found) == len(want)
            hit += len(set(found) & {i for i, _ in want})
            total += len(want)
            scores = [s for _, _, s in sorted(got[q])]
            assert all(a > b or (a == b and i < j) for a, b, i, j in zip(scores, scores[1:], found, found[1:]))
    assert hit / total >= 0.9
    assert not {3000, 3001, 3002} & set(got)
    common = [i for _, i, _ in sorted(got[1000]) if i == 7 or 1000 <= i < 1300]    # one vector: ties go to smaller ids
    assert len(common) > 5 and common == [7, *range(1001, 1000 + len(common))]


def test_empty_table(spark):
    df = frame(spark, [(1, [1.0], 0)])
    assert N.search(df.limit(0), df.limit(0)).count() == 0
    assert N.search(df, df).count() == 0                                           # no other row


def test_longest_match_is_a_stretch():
    rng = np.random.default_rng(2)
    codes = np.sort(rng.integers(0, 2 ** N.BITS, 500))
    chunk = N._Chunk(2, codes, np.arange(500), [np.zeros(2, np.float32).tobytes()] * 500)
    for code in rng.integers(0, 2 ** N.BITS, 20):
        low, high = chunk.longest(int(code), 12)
        shared = [N.BITS - int(int(c) ^ int(code)).bit_length() for c in codes]
        depth = min(shared[low:high])
        assert high - low >= 12 and all((s >= depth) == (low <= i < high) for i, s in enumerate(shared))
