"""Substring deduplication against brute force."""

import hashlib
import random

import pytest

from recordcheck.llm import skew
from recordcheck.llm import substring_dedup as S
from tests.llm.conftest import docs_frame


def brute(rows, level=S.LEVEL):
    first = {}
    words = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - level + 1):
                key = tuple(w[k:k + level])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - level + 1):
            if i is not None and first[tuple(w[k:k + level])] < i:
                gone[k:k + level] = [True] * level
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [None, 4])
def test_against_brute_force(spark, odd_docs, monkeypatch, hot):
    """With shuffled keys only, and with keys of 4 or more rows broadcast."""
    if hot:
        monkeypatch.setattr(skew, "HOT_ROWS", hot)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["é ü", "日本"]
    passages = [[rng.choice(words) for _ in range(n)] for n in (49, 50, 51, 75, 120, 260)]
    rows = [r for r in odd_docs if r[0] != 4 and r[0] != 5]
    for i in range(100, 160):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 60))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(parts), "en", "a"))
    rows += [(200 + i, rows[-1 - i][1], "en", "b") for i in range(3)]            # copies
    rows += [(300, "a b " * 200, "en", "b"), (301, "a b " * 150, "en", "b"), (301, "b a " * 150, "en", "b")]
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"])
                 for r in S.remove_repeats(docs_frame(spark, rows, extra=("place", "sha", "row"))).collect())
    assert got == sorted((str(a), b, c, d) for a, b, c, d in brute(rows))


def test_levels_double_until_nothing_repeats(spark):
    rng = random.Random(1)
    text = [f"x{rng.randrange(10**6)}" for _ in range(1000)]
    rows = [(1, " ".join(text), "en", "a"), (2, " ".join(["start", *text[100:600], "end"]), "en", "a"),
            (3, " ".join(f"y{i}" for i in range(300)), "en", "a")]
    got = {r["doc_id"]: r["longest_repeat"] for r in S.remove_repeats(docs_frame(spark, rows)).collect()}
    assert got == {1: 400, 2: 400, 3: 0}


def test_empty_table(spark):
    assert S.remove_repeats(docs_frame(spark, [(1, "a", "en", "s")]).limit(0)).count() == 0


@pytest.mark.parametrize("n,w", [(0, 3), (2, 3), (3, 3), (200, 26)])
def test_minimizers(n, w):
    import numpy as np

    from recordcheck.llm.words import minimizer_of_each

    h = np.random.default_rng(n).integers(0, 40, n).astype(np.uint64)
    want = [i + int(np.argmin(h[i:i + w])) for i in range(n - w + 1)]
    assert minimizer_of_each(h, w).tolist() == want
