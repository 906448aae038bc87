"""N-gram Jaccard join: components against all pairs."""

import random
import re

import numpy as np
import pytest

from recordcheck.llm import graph
from recordcheck.llm import ngram_join as J
from tests.llm.conftest import docs_frame

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def brute_set(text):
    words = SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component) of every row."""
    sets = [brute_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((str(r[0]), len(s), str(least[find(i)] if r[0] is not None else None)) for i, (r, s) in enumerate(zip(rows, sets)))


def family(rng, first, n, base, edits):
    """Copies of ``base`` with up to ``edits`` replaced words each."""
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((first + i, " ".join(w), "en", "a"))
    return rows


@pytest.mark.parametrize("seed,cut", [(1, 128), (2, 4)])
def test_against_all_pairs(spark, odd_docs, seed, cut, monkeypatch):
    monkeypatch.setattr(J, "LEADER_ROWS", cut)                                     # large groups are cut
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = list(odd_docs)
    for k, (n, length, edits) in enumerate([(40, 120, 3), (60, 150, 8), (30, 60, 2), (50, 200, 25), (8, 9, 1), (6, 6, 1)]):
        rows += family(rng, 1000 * (k + 1), n, [rng.choice(vocabulary) for _ in range(length)], edits)
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows += [(9000 + i, " ".join(passage + [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]), "en", "a") for i in range(40)]
    rows += [(9500, "one two three", "en", "a"), (9501, "ONE two\nthree", "en", "a"), (9502, "one two", "en", "a"),
             (9503, "A B C D E F G H", "en", "a"), (9504, "a b c d e f g h", "en", "a"), (9505, "é É", "en", "a")]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]))
                 for r in J.join_components(docs_frame(spark, rows, extra=("key", "comp"))).collect())
    assert got == brute(rows)


def test_one_of_each_group_stays(spark, odd_docs):
    df = docs_frame(spark, odd_docs, extra=("key", "n", "tokens"))
    out = J.keep_one(df)
    assert out.columns == df.columns
    ids = sorted(str(r["doc_id"]) for r in out.collect())
    # both texts of id 6 stay (its repeated row once)
    assert ids == ["1", "2", "3", "4", "6", "6", "7", "8", "None", "None"]
    assert J.keep_one(df.limit(0)).count() == 0


def test_rows_with_one_id_are_told_apart(spark):
    """Text ids with any characters; rows of one id and different texts."""
    words = " ".join(f"w{i}" for i in range(60))
    near, other, third = words + " end", " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    rows = [("a|b", words), ("c", near), ("c", other), ("c", other), ("c", third), ("", third + " z"), ("|", "short"), (None, words), ("-", "one two")]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = sorted((str(r["doc_id"]), r["component_id"] or "") for r in J.join_components(df).collect())
    assert got == sorted([("a|b", "a|b"), ("c", "a|b"), ("c", "c"), ("c", "c"), ("c", ""), ("", ""), ("|", "|"), ("None", ""), ("-", "-")])
    kept = sorted((str(r["doc_id"]), r["text"]) for r in J.keep_one(df).collect())
    assert kept == sorted([("a|b", words), ("c", other), ("", third + " z"), ("|", "short"), ("None", words), ("-", "one two")])


def test_prefix_bounds():
    """Two sets at the threshold share what each must find in its prefix."""
    rng = random.Random(0)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = set(rng.sample(range(10**6), n))
        b = set(rng.sample(sorted(a), rng.randint(max(1, int(0.7 * n)), n))) | set(rng.sample(range(10**6), rng.randint(0, n // 4)))
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        pa, pb = (set(sorted(s)[:J.prefix_length(len(s))]) for s in (a, b))
        assert len(pa & pb) >= max(J.shared_needed(len(a)), J.shared_needed(len(b)))
        x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
        differ = int(sum(int(v).bit_count() for v in np.bitwise_xor(J.parity_bits(x).view(np.uint64), J.parity_bits(y).view(np.uint64))))
        assert differ <= len(a ^ b)


def test_components(spark):
    rng = random.Random(3)
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(0, 60)] + [("a", "b"), ("b", "a"), ("c", "c")]
    edges += [("hub", f"x{i}") for i in range(200)]
    rng.shuffle(edges)
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"} and got["a"] == got["b"] == "a"
    assert {got[f"x{i}"] for i in range(200)} == {"hub"} and "c" not in got
    assert graph.components(spark.createDataFrame([], "a string, b string")).count() == 0
