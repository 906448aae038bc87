"""Suffix sort against brute force."""

import hashlib
import random

import numpy as np
import pytest

from recordcheck.llm import suffix_sort as S
from tests.llm.conftest import docs_frame


def brute(rows, width=S.WINDOW):
    """Every window of every text, one by one."""
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    first: dict[bytes, int] = {}
    for i, raw in texts:
        if i is not None:
            for k in range(len(raw) - width + 1):
                w = raw[k:k + width]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, raw in texts:
        gone, own = np.zeros(len(raw), dtype=bool), {}
        for k in range(len(raw) - width + 1):
            w = raw[k:k + width]
            if w in own or (i is not None and first[w] < i):
                gone[k:k + width] = True
            own.setdefault(w, k)
        edges = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        out.append((str(i), len(raw), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def corpus(seed, n=70):
    rng = random.Random(seed)
    letters = "abcdefgh é日\n"
    text = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [text(k) for k in (60, 99, 100, 101, 140, 300, 900)]
    line = text(240)
    rows = []
    for i in range(100, 100 + n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else text(rng.randint(1, 200)) for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.4:
            parts.insert(rng.randint(0, len(parts)), line)            # one very common line, other text around it
        rows.append((i, "".join(parts), "en", "a"))
    rows += [(300 + i, rows[-1 - i][1], "en", "b") for i in range(4)]   # copies
    near = rows[3][1] + rows[5][1] + line
    rows += [(400 + i, near[:7 * i] + "#" + near[7 * i + 1:], "en", "b") for i in range(25)]
    rows += [(500, "ab" * 400, "en", "c"), (501, "ba" * 300, "en", "c"), (502, "x" * 99, "en", "c"), (503, "x" * 100, "en", "c"),
             (504, "x" * 250, "en", "c"), (505, rows[2][1] * 3, "en", "c"), (505, rows[4][1] + line, "en", "c"),
             (506, "\0" * 120 + line, "en", "c"), (507, line + "\0" * 130, "en", "c")]
    return rows


def test_against_brute_force(spark, odd_docs):
    rows = [r for r in odd_docs if r[0] not in (4, 5)] + corpus(3)
    assert result(S.remove_repeats(docs_frame(spark, rows, extra=("anchor", "row", "packed", "size")))) == brute(rows)


def test_frequent_anchors_crowded_groups_and_small_blocks(spark, monkeypatch):
    """Every path on: salts, parts of a group, windows of crowded anchors, blocks."""
    for name, value in (("SHARE", 0.0), ("SALTS", 3), ("GROUP", 6), ("BLOCK", 700), ("PORTION", 2000), ("OPEN", 40)):
        monkeypatch.setattr(S, name, value)
    monkeypatch.setattr(S, "_frequent", lambda docs: spark.createDataFrame(
        docs.mapInArrow(S._occurrences, "anchor long, around long, doc_id long").groupBy("anchor").count().filter("count > 8")
        .select("anchor").collect(), "f_anchor long"))
    rows = corpus(8, 60) + [(600, "".join(chr(97 + (i * i) % 23) for i in range(6000)) + corpus(8, 60)[7][1], "en", "c"), (None, "y" * 300, "en", "c")]
    assert result(S.remove_repeats(docs_frame(spark, rows))) == brute(rows)


def test_whole_table(spark, small_docs):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    from tests.conftest import SMALL

    assert result(S.op11_suffix_sort(spark, SMALL)) == brute(rows)


def test_empty_table(spark):
    df = S.remove_repeats(docs_frame(spark, [(1, "a", "en", "s")]).limit(0))
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and df.count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_radix_order(seed):
    rng = np.random.default_rng(seed)
    n = 300
    group = rng.integers(0, 9, n)
    strings = rng.integers(0, 2, (n, 72)).astype(np.uint8)
    strings[:, :40] = strings[rng.integers(0, 12, n), :40]
    strings[100:140] = strings[7]
    order, common = S.radix_order(group, strings)
    keys = [(int(group[i]), strings[i].tobytes()) for i in order]
    assert keys == sorted(keys)
    for a, b, c in zip(keys, keys[1:], common[1:].tolist()):
        assert c == (-1 if a[0] != b[0] else next((k for k in range(72) if a[1][k] != b[1][k]), 72))
