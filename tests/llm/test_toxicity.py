"""Weak supervision: label model, classifier, held-out quality."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from recordcheck.llm import toxicity as X
from tests.conftest import SMALL
from tests.llm.conftest import docs_frame


def corpus(n=900):
    rng = random.Random(5)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    bad = ["vilework", "vilemonger", "foulbeast", "foulness", "grimthing"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(30, 120))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), "en", "a"))
        labels.append((i, None, int(toxic) if i % 2 == 0 else None))
    return docs, labels


def test_held_out_quality(spark):
    docs, labels = corpus()
    df = docs_frame(spark, docs)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    classifier, voters, model = X.fit(df, lab, per_class=300)
    assert any(n.startswith("vile") for n in voters.names) and model.accuracy.shape[0] == 2
    rows = X.score(df.withColumn("held", X.held_out()), classifier).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    unseen = [r for r in rows if r["held"] or r["doc_id"] % 2]
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 7 == 0) for r in unseen]
    assert np.mean(right) > 0.98


def test_label_model_discounts_voters_that_repeat_each_other():
    rng = np.random.default_rng(0)
    y = (rng.random(4000) < 0.3).astype(int)
    single = [np.where(rng.random(4000) < 0.8, y, 1 - y) for _ in range(3)]
    copied = np.where(rng.random(4000) < 0.65, y, 1 - y)
    votes = np.stack([*single, *[copied] * 6], axis=1).astype(np.int8)
    model = X.LabelModel()
    posterior = model.fit(votes, np.where(rng.random(4000) < 0.9, y, 1 - y))
    assert abs(model.weights[3:].sum()) < model.weights[:3].sum()
    assert model.correlation[4, 5] > 0.9 and abs(model.correlation[0, 1]) < 0.2
    assert ((posterior >= 0.5) == y).mean() > 0.9


def test_scores_against_a_plain_loop(spark):
    """Every row of the small table: words and beginnings counted one by one."""
    classifier = X.LinearClassifier()
    classifier.weights = np.random.default_rng(8).normal(size=1 << X.BITS) / 8
    classifier.bias = -0.4
    letter = [bool(X._IN_WORD[X._LOWER[b]]) for b in range(256)]

    def number(piece, more):
        at = np.array([0]), np.array([len(piece)])
        return (int(X._HASHER.ranges_of(np.frombuffer(piece, dtype=np.uint8))(*at)[0]) + more) % 2 ** 64

    def plain(text):
        raw = bytes(int(X._LOWER[b]) for b in (text or "").encode())
        words, now = [], b""
        for b in raw + b" ":
            if letter[b]:
                now += bytes([b])
            elif now:
                words.append(now)
                now = b""
        times = Counter()
        for w in words:
            times[number(w, 0)] += 1
            for n in range(4, 9):
                if len(w) > n:
                    times[number(w[:n], n)] += 1
        marked = {(h + m) % 2 ** 64 for h, c in times.items() for m, least in ((0, 1), (101, 2), (102, 4)) if c >= least}
        places = {int(X.WD.mix(np.array([h], dtype=np.uint64))[0]) >> (64 - X.BITS) for h in marked}
        return 1 / (1 + math.exp(-(sum(classifier.weights[i] for i in places) + classifier.bias)))

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = X.score(docs, classifier).collect()
    assert len(rows) == docs.count()
    assert all(r["score"] == pytest.approx(plain(r["text"]), abs=1e-9) for r in rows)
    assert len({round(r["score"], 6) for r in rows}) > len(rows) / 2


def test_odd_rows(spark, odd_docs):
    df = docs_frame(spark, odd_docs, extra=("toxic",))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    classifier, share, _ = X.fit(df, none)
    assert classifier is None and share == 0.0
    assert {r["score"] for r in X.score(df, None, 0.25).collect()} == {0.25}
    model = X.LinearClassifier()
    rows = X.score(df, model).collect()
    assert len(rows) == len(odd_docs) and {r["score"] for r in rows} == {0.5}
    assert X.score(df.limit(0), model).count() == 0
    one = spark.createDataFrame([(6, 1, 1), (6, 1, 1), (None, 0, 1), (77, 0, 0)], "doc_id long, quality int, toxic int")
    assert X.fit(df, one)[0] is None                     # only one class among known documents
