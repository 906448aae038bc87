"""Packing: ids, cuts, plans and places."""

import random
import zlib

import numpy as np
import pytest

from recordcheck.llm import packing as P
from tests.conftest import MEDIUM
from tests.llm.conftest import docs_frame

PATH = P.tokenizer_path()


def test_ids_equal_the_json_tokenizer(spark, small_docs):
    ids = P.TokenIds(PATH)
    texts = [r["text"] for r in small_docs.collect()]
    texts += ["", "\n", "  \n\n x", "a\n\nB", "don't we'll 'tis <|endoftext|> yes", "A" * 20_000, " " * 20_000 + "x", "ﬁ é  x\u0000\x1c\x1dz",
              "日本語 テスト 123４５", "\r\n\t\x0b\x0cq", "👍🏽 a", "    x", "a<|endoftext|>b <|endoftext|>"]
    for t in texts:
        assert ids(t) == ids.exact(t), t[:60]


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 2048, 5000])
def test_cuts(n):
    got = P.cut(n, 1024)
    assert sum(k for _, k in got) == n and [s for s, _ in got] == list(np.cumsum([0] + [k for _, k in got[:-1]]))
    assert all(k == 1024 for _, k in got[1:]) and len(got) == max(1, -(-n // 1024))


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_length_and_are_tight(seed):
    rng = random.Random(seed)
    cap = rng.choice([64, 1024])
    hist = {}
    for _ in range(rng.randint(0, 120)):
        hist[rng.randint(1, cap)] = rng.choice([1, 2, 7, 300, 5000])
    plan = P.configurations(hist, cap, rounds=200)
    held, used = {}, 0
    for config, times in plan:
        assert sum(n * c for n, c in config.items()) <= cap
        used += times
        for n, c in config.items():
            held[n] = held.get(n, 0) + c * times
    assert held == hist
    plain = sum(n for _, n in P.best_fit(hist, cap))
    bound = -(-sum(n * c for n, c in hist.items()) // cap)
    assert bound <= used <= plain


def test_configurations_beat_greedy_where_it_is_weak():
    # Longest first packs 6 + 3 and leaves the 4s and 3s badly matched.
    hist = {6: 1200, 4: 1200, 3: 2000, 7: 2000, 5: 4}
    used = sum(n for _, n in P.configurations(hist, 10))
    assert used <= -(-sum(n * c for n, c in hist.items()) // 10) + 4


def test_pack_places_every_piece(spark, odd_docs):
    df = docs_frame(spark, odd_docs + [(50 + i, "same length text", "en", "x") for i in range(900)], extra=("bucket", "length", "per"))
    rows = P.pack(df, PATH, keep=("source",)).collect()
    ids = P.TokenIds(PATH)
    want = []
    for r in df.collect():
        raw = ids.exact(r["text"] or "") + np.array([P.END_ID], "<u4").tobytes()
        for k, (s, n) in enumerate(P.cut(len(raw) // 4, P.CAPACITY)):
            want.append((str(r["doc_id"]), k, s, n, zlib.crc32(raw[4 * s:4 * (s + n)])))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= P.CAPACITY
    assert len(by_sequence) <= sum(n for *_, n, _ in want) / P.CAPACITY * 1.05 + 2
    assert P.pack(df.limit(0), PATH).count() == 0


def test_query_is_near_the_bound(spark):
    rows = P.op10_best_fit_packing(spark, MEDIUM).collect()
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= total / P.CAPACITY * 1.01


def test_priced_configurations_place_a_full_histogram():
    """About 1,000 lengths, as of documents: the linear program, not best fit, packs them."""
    rng = np.random.default_rng(3)
    drawn = np.concatenate([rng.integers(1, 1024, 6000), rng.normal(360, 110, 14_000).astype(int)])
    values, counts = np.unique(drawn[(drawn > 0) & (drawn < 1024)], return_counts=True)
    hist = dict(zip(values.tolist(), counts.tolist()))
    assert len(hist) > 1000
    used = sum(n for _, n in P.configurations(hist))
    assert used < sum(n for _, n in P.best_fit(hist))
    plan, share = P.solve(hist)
    assert share >= 0.99 and sum(n for _, n in plan) == used


def test_rounding_uses_the_whole_parts_of_the_average():
    counts = {600: 7, 400: 7, 500: 8}
    covers = [[({600: 1, 400: 1}, 7), ({500: 2}, 4)], [({600: 1, 400: 1}, 4), ({600: 1}, 3), ({400: 2}, 1), ({400: 1, 500: 1}, 1),
                                                      ({500: 2}, 3), ({500: 1}, 1)]]
    plan = P._rounded(covers, counts, {n: n / 1024 for n in counts}, 1024)
    assert plan[:2] == [({400: 1, 600: 1}, 5), ({500: 2}, 3)]           # 11 / 2 and 7 / 2; 600 alone: 3 / 2
    held = {}
    for config, times in plan:
        for n, k in config.items():
            held[n] = held.get(n, 0) + k * times
    assert held == counts


def test_a_plan_grows_with_its_lengths_not_its_rows():
    """Counts a thousand times as large: the same number of slots, near the bound."""
    rng = np.random.default_rng(3)
    values, counts = np.unique(rng.integers(1, 1024, 6000), return_counts=True)
    hist = {n: c * 1000 for n, c in zip(values.tolist(), counts.tolist())}
    plan, share = P.solve(hist)
    bound = -(-sum(n * c for n, c in hist.items()) // P.CAPACITY)
    assert share >= 0.99 and sum(n for _, n in plan) <= bound * 1.005
    assert len(P.slot_table(plan)) <= P.SLOT_ROWS // 10


def test_keep_named_like_an_output(spark, small_docs):
    with pytest.raises(ValueError, match="piece"):
        P.pack(small_docs.withColumnRenamed("source", "piece"), PATH, keep=("piece",))
