"""Byte convolutional language identification."""

import zlib

import numpy as np

from recordcheck.llm import language as L
from tests.conftest import MEDIUM
from tests.llm.conftest import docs_frame


def test_gradients_match_finite_differences():
    net = L.ByteConvNet(["a", "b", "c"], seed=1)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, L.CLASSES, (4, L.WINDOW)), np.array([0, 1, 2, 1])

    def loss():
        net._tables = {w: np.einsum("ce,wef->wcf", net.params["embed"], net.params[f"filter{w}"]) for w in L.WIDTHS}
        return -net.log_probabilities(x)[np.arange(4), y].mean()

    loss()
    grads = net.gradients(x, y)
    for name in ("out", "out_bias", "filter3", "bias2"):
        at = tuple(0 for _ in net.params[name].shape)
        eps, before = 1e-5, net.params[name][at]
        net.params[name][at] = before + eps
        up = loss()
        net.params[name][at] = before - eps
        down = loss()
        net.params[name][at] = before
        assert abs((up - down) / (2 * eps) - grads[name][at]) < 1e-5, name


def test_windows_cover_the_whole_text():
    raw = ("abc " * 500).encode()
    x = L.windows_of(raw)
    assert x.shape == (-(-len(raw) // L.WINDOW), L.WINDOW)
    assert (x.ravel()[:len(raw)] == L._CLASS[np.frombuffer(raw, np.uint8)]).all()


def test_held_out_accuracy(spark):
    out = L.op1_language_id(spark, MEDIUM).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    assert len(out) == len(truth)
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def plain_score(net, raw):
    """The network one window, filter and position at a time."""
    data = [int(L._CLASS[b]) for b in raw] or [0]
    data += [0] * (-len(data) % L.WINDOW)
    p = net.params
    total, weight = np.zeros(len(net.languages)), 0
    for at in range(0, len(data), L.WINDOW):
        window, pooled = data[at:at + L.WINDOW], []
        for w in L.WIDTHS:
            for f in range(L.FILTERS):
                best = max(sum(float(p["embed"][window[i + k]] @ p[f"filter{w}"][k][:, f]) for k in range(w)) for i in range(L.WINDOW - w + 1))
                pooled.append(np.tanh(best + p[f"bias{w}"][f]))
        z = np.array(pooled) @ p["out"] + p["out_bias"]
        z -= np.log(np.exp(z - z.max()).sum()) + z.max()
        letters = sum(c >= 2 for c in window)
        total += letters * z
        weight += letters
    q = np.exp(total / max(weight, 1))
    return int(q.argmax()), float(q.max() / q.sum())


def test_against_a_plain_network(spark, small_docs, monkeypatch):
    """lang_pred and score of whole texts, whatever the stretches they are read in."""
    net = L.fit(small_docs)
    rows = [r for r in L.predict(small_docs, net).collect() if len(r["text"]) < 900][:25]
    assert len(rows) == 25
    monkeypatch.setattr(L, "STRETCH", 2 * L.WINDOW)
    for r in rows:
        best, p = plain_score(net, r["text"].encode())
        assert net.languages[best] == r["lang_pred"] and abs(p - r["score"]) < 1e-4
        assert abs(net.score_text(r["text"].encode())[1] - r["score"]) < 1e-9


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} " * 30, f"l{i % 60:02d}", "a") for i in range(600)]
    assert L.fit(docs_frame(spark, rows), per_language=3).languages == [f"l{i:02d}" for i in range(60)]


def test_odd_rows(spark, odd_docs):
    net = L.ByteConvNet(["de", "en"])
    df = docs_frame(spark, odd_docs, extra=("score",))
    rows = L.predict(df, net).collect()
    assert len(rows) == len(odd_docs)
    for r in rows:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und" and r["score"] == 0) != letters
    assert L.predict(df.limit(0), net).count() == 0
    assert L.fit(df.limit(0)) is None
    assert {r["lang_pred"] for r in L.predict(df, None).collect()} == {"und"}
