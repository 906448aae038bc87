"""Toxicity by weak supervision.

1. *Voters.*  Words and word beginnings that mark labelled toxic texts become
   lexicon voters (present: a vote for toxic); patterns over them (several
   different entries, dense entries, none at all, shouting) are voters too.
2. *Label model.*  A generative model of the votes given the hidden class:
   every voter's mean vote per class (its accuracy) and the covariance of all
   voters within a class (their correlations), estimated by expectation
   maximization together with the noise of the given labels.  Voters that repeat
   each other share their weight instead of adding up.
3. *Classifier.*  Logistic regression on hashed words and word beginnings,
   trained on the model's posterior labels, scores every whole text.

Learning uses a bounded sample of labelled rows (``PER_CLASS`` of each class,
those with the smallest digests, from rows that are not held out); scoring is one
map over all texts.  Labels, lang, source and doc_id are no inputs of a score.

Defined cases: a null or empty text gets the score of a text without features;
labels that are null, or of unknown documents, are not learned from; without
both classes among the labels every score is the share of toxic labels (0
without labels); repeated rows are scored row by row; an empty table gives an
empty result; extra columns pass through ``score``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordcheck.llm import words as WD
from recordcheck.sources.tables import read_table

FOLD, HELD_OUT = 5, 0         # crc32(doc_id as text) mod FOLD = HELD_OUT is held out
PER_CLASS = 2_500             # labelled rows learned from, per class
LEXICON = 240                 # lexicon voters
MIN_TEXTS = 5                 # toxic texts an entry occurs in
PREFIXES = (4, 5, 6, 7)       # lengths of word beginnings
LABEL_NOISE = 0.02            # first guess of the share of wrong labels
VOTES_LIMIT = 4.0             # log odds that the votes together may add
EM_ROUNDS = 15
BITS = 18                     # hashed features of the classifier
FEATURE_TEXTS = 8             # sample texts a classifier feature occurs in (fewer in small samples)
FEATURE_ODDS = 1.5            # least log odds between the classes of a classifier feature
EPOCHS = 20
L2 = 1e-2

_LETTERS = re.compile(r"[^\W\d_]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("a"):ord("z") + 1] = True
_IN_WORD[128:] = True
_HASHER = WD.Hasher(17)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLD == HELD_OUT, F.lit(False))


# Features of the classifier ------------------------------------------------------

def features(raw: bytes) -> np.ndarray:
    """Distinct hashed features of a text: words (letters, lower case) and the
    first 4 to 8 bytes of longer ones, each also marked when it occurs at least
    two and four times."""
    data = _LOWER[np.frombuffer(raw, dtype=np.uint8)]
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    inside = np.concatenate(([False], _IN_WORD[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    hashes = _HASHER.ranges_of(data)
    found = [hashes(starts, ends)]
    for n in range(4, 9):
        long = starts[ends - starts > n]
        found.append(hashes(long, long + n) + np.uint64(n))
    once, times = np.unique(np.concatenate(found), return_counts=True)
    every = np.concatenate([once, once[times >= 2] + np.uint64(101), once[times >= 4] + np.uint64(102)])
    return np.unique((WD.mix(every) >> np.uint64(64 - BITS)).astype(np.int64))


# Voters ----------------------------------------------------------------------------

def entries(text: str) -> set[str]:
    """Words of a text and, marked ``*``, beginnings of longer words; marked
    ``2`` in front as well if they occur at least twice."""
    words = Counter(_LETTERS.findall(text.lower()))
    found = Counter(words)
    for w, c in words.items():
        for n in PREFIXES:
            if len(w) > n:
                found[w[:n] + "*"] += c
    return set(found) | {"2" + e for e, c in found.items() if c >= 2}


def _entry_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        found = [sorted(entries(t)) for t in batch.column("text").to_pylist()]
        flat = [e for f in found for e in f]
        label = [y for f, y in zip(found, toxic) for _ in f]
        yield pa.RecordBatch.from_arrays([pa.array(flat, pa.string()), pa.array(label, pa.int32())], names=["entry", "toxic"])


class Voters:
    """Votes of a text: 1 toxic, 0 none, -1 not toxic."""

    def __init__(self, lexicon: list[str]):
        self.place = {e: i for i, e in enumerate(lexicon)}
        self.names = [*lexicon, "two entries", "four entries", "dense entries", "no entry", "shouting"]

    def votes(self, text: str) -> np.ndarray:
        out = np.zeros(len(self.names), dtype=np.int8)
        hits = [self.place[e] for e in entries(text) if e in self.place]
        out[hits] = 1
        words = max(1, text.count(" ") + 1)
        letters = sum(c.isalpha() for c in text)
        out[-5:] = (len(hits) >= 2, len(hits) >= 4, len(hits) >= 0.02 * words, -(not hits),
                    letters > 20 and sum(c.isupper() for c in text) > 0.5 * letters)
        return out


# Label model -----------------------------------------------------------------------

class LabelModel:
    """Posterior of the hidden class from votes with correlated voters."""

    def fit(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        v = votes.astype(np.float64)
        prior_votes = np.where(labels == 1, 1 - LABEL_NOISE, LABEL_NOISE)
        q, noise = prior_votes.copy(), LABEL_NOISE
        for _ in range(EM_ROUNDS):
            total = np.array([(1 - q).sum(), q.sum()]) + 1e-9
            mean = np.stack([((1 - q)[:, None] * v).sum(0) / total[0], (q[:, None] * v).sum(0) / total[1]])
            centred = v - (1 - q)[:, None] * mean[0] - q[:, None] * mean[1]
            cov = centred.T @ centred / len(v)
            scale = np.trace(cov) / len(cov)
            self.weights = np.linalg.solve(cov + (0.05 * scale + 1e-3) * np.eye(len(cov)), mean[1] - mean[0])
            self.bias = -0.5 * self.weights @ (mean[0] + mean[1])
            share = np.clip(total[1] / total.sum(), 1e-3, 1 - 1e-3)
            given = np.where(labels == 1, np.log((1 - noise) / noise), np.log(noise / (1 - noise)))
            z = np.clip(v @ self.weights + self.bias, -VOTES_LIMIT, VOTES_LIMIT) + np.log(share / (1 - share)) + given
            q = 1 / (1 + np.exp(-z))
            noise = float(np.clip(np.where(labels == 1, 1 - q, q).mean(), 0.01, 0.3))
        self.accuracy = np.stack([mean[0], mean[1]])
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        self.correlation = cov / spread[:, None] / spread[None, :]
        return q


# Classifier ------------------------------------------------------------------------

class LinearClassifier:
    """Logistic regression on binary hashed features (AdaGrad).  Only features
    that set the classes apart in enough texts get a weight."""

    def __init__(self):
        self.weights = np.zeros(1 << BITS)
        self.bias = 0.0

    def fit(self, rows: list[np.ndarray], targets: np.ndarray, importance: np.ndarray, seed: int = 3) -> None:
        toxic, clean = np.zeros(1 << BITS), np.zeros(1 << BITS)
        for x, t in zip(rows, targets):
            toxic[x] += t
            clean[x] += 1 - t
        odds = np.log((toxic + 0.5) / (targets.sum() + 1)) - np.log((clean + 0.5) / ((1 - targets).sum() + 1))
        texts = np.clip(targets.sum() / 20, 3, FEATURE_TEXTS)
        used = (toxic + clean >= texts) & (np.abs(odds) >= FEATURE_ODDS)
        rows = [x[used[x]] for x in rows]
        rng = np.random.default_rng(seed)
        grad2, bias2 = np.full(1 << BITS, 1e-2), 1e-2
        order = np.arange(len(rows))
        for _ in range(EPOCHS):
            rng.shuffle(order)
            for i in order:
                x = rows[i]
                g = importance[i] * (self.probability(x) - targets[i])
                grad2[x] += g * g
                self.weights[x] -= 0.1 * (g + L2 * self.weights[x]) / np.sqrt(grad2[x])
                bias2 += g * g
                self.bias -= 0.1 * g / np.sqrt(bias2)

    def probability(self, x: np.ndarray) -> float:
        z = self.weights[x].sum() + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


# The operator ------------------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(digest, toxic, text) of about ``per_class`` labelled rows of each class,
    those whose digest lies below a bound set by the class counts."""
    known = (labels.select(F.col("doc_id").alias("l_doc"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & ~held_out("l_doc"))
             .withColumn("digest", F.xxhash64("l_doc", "toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = [min(1.0, per_class / max(1, counts.get(y, 0))) for y in (0, 1)]
    unit = F.col("digest") / F.lit(float(2 ** 64)) + F.lit(0.5)
    few = known.filter(unit <= F.when(F.col("toxic") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))).distinct()
    return (docs.filter(~held_out()).select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("l_doc"))
            .select("doc_id", "digest", "toxic", F.coalesce(F.col("text"), F.lit("")).alias("text")))


def _lexicon(sample: DataFrame, size: int) -> list[str]:
    """The entries that mark toxic texts best: a top-k of an aggregation."""
    counts = sample.mapInArrow(_entry_rows, "entry string, toxic int").groupBy("entry").agg(
        F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    texts = sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r["toxic"]: r["n"] for r in texts}
    odds = F.log(((F.col("pos") + 0.5) / (n.get(1, 0) + 1)) / ((F.col("neg") + 0.5) / (n.get(0, 0) + 1)))
    # Of entries that occur in the same number of texts (a word and its
    # beginnings, mostly) the shortest stands for all.
    counts = counts.groupBy("pos", "neg", F.substring("entry", 1, 4).alias("_start")).agg(
        F.min_by("entry", F.struct(F.length("entry"), F.col("entry"))).alias("entry"))
    best = (counts.filter(F.col("pos") >= MIN_TEXTS).withColumn("odds", odds).filter(F.col("odds") > 1.5)
            .orderBy(F.desc(F.col("pos") * F.col("odds")), "entry").limit(size))
    return [r["entry"] for r in best.collect()]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, lexicon: int = LEXICON):
    """(classifier, voters, label model), or (None, share of toxic, None)
    without both classes."""
    from recordcheck.sources.storage import scratch_table

    sample = scratch_table(docs.sparkSession, _sample(docs, labels, per_class), "toxicity-sample")
    voters = Voters(_lexicon(sample, lexicon))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), batch.column("toxic"),
                 pa.array([voters.votes(t).tobytes() for t in texts], pa.binary()),
                 pa.array([features(t.encode()).astype(np.int32).tobytes() for t in texts], pa.binary())],
                names=["doc_id", "digest", "toxic", "votes", "features"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = (sample.mapInArrow(gather, f"doc_id {kind}, digest long, toxic int, votes binary, features binary")
            .dropDuplicates(["digest"]).toPandas().sort_values("digest", kind="stable"))
    labels_ = rows["toxic"].to_numpy()
    if len(set(labels_)) < 2:
        return None, float(labels_.mean()) if len(labels_) else 0.0, None
    votes = np.stack([np.frombuffer(x, dtype=np.int8) for x in rows["votes"]])
    model = LabelModel()
    posterior = model.fit(votes, labels_)
    classifier = LinearClassifier()
    weight = np.where(labels_ == 1, 0.5 / max(labels_.mean(), 1e-9), 0.5 / max(1 - labels_.mean(), 1e-9))
    classifier.fit([np.frombuffer(x, dtype=np.int32) for x in rows["features"]], posterior, weight)
    return classifier, voters, model


def score(docs: DataFrame, classifier: LinearClassifier | None, share: float = 0.0) -> DataFrame:
    """``docs`` (needs ``text``) plus score, map-side."""
    kept = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType(kept + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [share if classifier is None else
                      classifier.probability(features(t.as_buffer().to_pybytes() if t.is_valid else b""))
                      for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(scores, pa.float64())],
                                             names=[*(f.name for f in kept), "score"])

    return docs.select(*[f.name for f in kept]).mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, score, predicted."""
    docs = read_table(spark, sf_dir, "documents")
    classifier, share, _ = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text", held_out().alias("held_out")), classifier,
                   share if classifier is None else 0.0)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
