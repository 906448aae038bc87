"""Prefix trie against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from recordcheck.llm import conversation_trie as C
from tests.conftest import SMALL


def brute(rows):
    """rows: (conv_id, turn, role, text); turns of one number by digest."""
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((t is not None, t or 0), key, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + turns[h:]
    return nodes(built)


def nodes(built):
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        own = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"],
                   r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def conversations(seed=2):
    rng = random.Random(seed)
    texts = ["", "hello there", "a  b\tc\nd", "é 日本 x", "no", None]
    rows = []
    for c in range(160):
        start = rng.randint(0, 6)
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), texts[start % 6] if t < 3 else rng.choice(texts)))
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(90) for t in range(4)]           # one very common conversation
    rows += [(2000 + 20 * c, t, "user", f"same {t}" if t < 30 else f"own {c % 7} {t}") for c in range(25) for t in range(34)]
    rows += [(3000, t, "user", f"long {t % 5}") for t in range(300)]
    rows += [(4000, None, "user", "none"), (4000, 1, "user", "b"), (4000, 1, "user", "a"), (4000, 1, "user", "a"),
             (None, 1, "user", "a"), (-7, 1, "user", "a"), (-20, 1, "user", "minus"), (-20, 2, "user", "minus 2")]
    return rows


def op(df):
    return C.prefix_trie(C.shared_starts(C.sequences(df)))


def test_against_brute_force(spark):
    rows = conversations()
    from pyspark.sql import functions as F

    df = frame(spark, rows).withColumn("path", F.lit("own")).withColumn("words", F.lit(1)).withColumn("key", F.lit(1))
    assert result(op(df)) == brute(rows)


@pytest.mark.parametrize("key,shard", [(2, 5), (3, 17), (24, 8)])
def test_many_shards(spark, monkeypatch, key, shard):
    """Boundary nodes over shards, also when shards split a common start."""
    monkeypatch.setattr(C, "KEY", key)
    monkeypatch.setattr(C, "SHARD", shard)
    monkeypatch.setattr(C, "IDS", 7)
    rows = conversations(key)
    assert result(op(frame(spark, rows))) == brute(rows)


def test_turnless_and_empty(spark):
    assert op(frame(spark, [(1, 1, "user", "a")]).limit(0)).count() == 0
    # 1: h = 3, no base: nothing is left of its one turn
    assert zlib.crc32(b"1") % 4 == 3
    got = result(op(frame(spark, [(1, 1, "user", "a")])))
    assert got == [(1, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_tree_is_balanced():
    tree = C.TernaryTree()
    n = 1023
    for i in C.median_order(n):
        tree.insert([i], i)
    assert sorted(C.median_order(n)) == list(range(n)) and sorted(tree.walk()) == list(range(n + 1))
    steps = []
    for i in range(n):
        here, k = tree.down[0], 1
        while tree.token[here] != i:
            here, k = (tree.less if i < tree.token[here] else tree.more)[here], k + 1
        steps.append(k)
    assert max(steps) == 10


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(C.op13_conversation_trie(spark, SMALL)) == brute(rows)
