"""Language identification by a byte convolutional network.

The network reads fixed-length windows of bytes: embeddings of the byte at
every position are convolved with filters of several widths, the largest
response of every filter over the window is kept (max pooling) and a softmax
layer gives the probability of each language.  Because an embedding followed
by a convolution is one table per (filter, offset), a trained network is
applied by adding rows of tables indexed by bytes.

It is trained in numpy (Adam on cross-entropy) on windows of a bounded sample
of labelled rows: of every language the ``PER_LANGUAGE`` rows with the smallest
digest of id and text, ``WINDOWS_PER_TEXT`` windows each.  Prediction covers every
window of every whole text in batches; a document's score is the softmax of
its mean window log-probabilities, weighted by letters in the window.

Defined cases: null text or text without a letter gives ``und`` with score 0;
text with letters but no labelled row anywhere gives ``und`` with score 0 too;
null lang rows are never learned from; null or repeated ids are predicted row
by row; equal texts get equal predictions; ties between languages go to the
first by name; a very long text is read ``STRETCH`` bytes at a time; an empty table
gives an empty result; extra columns pass through ``predict`` (clashing names are
replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordcheck.sources.tables import read_table

WINDOW = 192                  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 8                   # per width
EMBED = 8
PER_LANGUAGE = 300            # labelled texts learned from, per language
WINDOWS_PER_TEXT = 8
EPOCHS = 12
BATCH = 128
RATE = 0.01
FOLD, HELD_OUT = 4, 2         # crc32(doc_id as text) mod FOLD = HELD_OUT is held out
UNKNOWN = "und"
CHUNK = 256                   # windows scored at once
STRETCH = CHUNK * WINDOW      # bytes of a text that are turned into windows at once

# Byte classes: upper and lower case ASCII letters together, digits and other
# control or punctuation bytes together, bytes of multi-byte characters apart.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[ord("a"):ord("z") + 1] = np.arange(2, 28)
_CLASS[ord("A"):ord("Z") + 1] = np.arange(2, 28)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[128:] = np.arange(28, 156)
CLASSES = 156
_LETTER = (_CLASS >= 2).astype(np.float32)


def windows_of(raw: bytes) -> np.ndarray:
    """All windows of a text (rows x WINDOW of byte classes), the last padded."""
    data = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    rows = max(1, -(-len(data) // WINDOW))
    out = np.zeros(rows * WINDOW, dtype=np.int64)
    out[:len(data)] = data
    return out.reshape(rows, WINDOW)


class ByteConvNet:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = list(languages)
        self.params = {"embed": rng.normal(0, 0.5, (CLASSES, EMBED))}
        for w in WIDTHS:
            self.params[f"filter{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS))
            self.params[f"bias{w}"] = np.zeros(FILTERS)
        self.params["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
        self.params["out_bias"] = np.zeros(len(languages))
        self._tables: dict[int, np.ndarray] | None = None

    def tables(self) -> dict[int, np.ndarray]:
        """Per width: (offset, byte class, filter) responses."""
        if self._tables is None:
            self._tables = {w: np.ascontiguousarray(
                np.einsum("ce,wef->wcf", self.params["embed"], self.params[f"filter{w}"]).astype(np.float32))
                for w in WIDTHS}
        return self._tables

    def _responses(self, x: np.ndarray, w: int) -> np.ndarray:
        table, n = self.tables()[w], x.shape[1] - w + 1
        total = table[0][x[:, :n]]
        for k in range(1, w):
            total += table[k][x[:, k:k + n]]
        return total

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        values, places = [], []
        for w in WIDTHS:
            r = self._responses(x, w)
            at = r.argmax(axis=1)
            values.append(np.take_along_axis(r, at[:, None, :], axis=1)[:, 0, :] + self.params[f"bias{w}"])
            places.append(at)
        return np.tanh(np.concatenate(values, axis=1)), places

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        values = [self._responses(x, w).max(axis=1) + self.params[f"bias{w}"] for w in WIDTHS]
        z = np.tanh(np.concatenate(values, axis=1)) @ self.params["out"] + self.params["out_bias"]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, places = self.pooled(x)
        z = h @ self.params["out"] + self.params["out_bias"]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        grads = {"out": h.T @ p, "out_bias": p.sum(axis=0), "embed": np.zeros_like(self.params["embed"])}
        dh = (p @ self.params["out"].T) * (1 - h * h)
        for i, w in enumerate(WIDTHS):
            d = dh[:, i * FILTERS:(i + 1) * FILTERS]
            grads[f"bias{w}"] = d.sum(axis=0)
            g = np.zeros_like(self.params[f"filter{w}"])
            for k in range(w):
                # byte under offset k of the winning position of every (row, filter)
                bytes_at = np.take_along_axis(x, places[i] + k, axis=1)
                e = self.params["embed"][bytes_at]
                g[k] = np.einsum("nfe,nf->ef", e, d)
                np.add.at(grads["embed"], bytes_at,
                          d[:, :, None] * self.params[f"filter{w}"][k].T[None, :, :])
            grads[f"filter{w}"] = g
        return grads

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                rows = order[at:at + BATCH]
                step += 1
                for k, g in self.gradients(x[rows], y[rows]).items():
                    m[k] += 0.1 * (g - m[k])
                    v2[k] += 0.001 * (g * g - v2[k])
                    self.params[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
                self._tables = None

    def score_text(self, raw: bytes) -> tuple[int, float]:
        """(language index, probability) of a whole text."""
        total, weight = np.zeros(len(self.languages)), 0.0
        for at in range(0, max(1, len(raw)), STRETCH):
            part = windows_of(raw[at:at + STRETCH])
            letters = (part >= 2).sum(axis=1).astype(np.float64)
            total += letters @ self.log_probabilities(part)
            weight += letters.sum()
        mean = total / max(weight, 1.0)
        p = np.exp(mean - mean.max())
        p /= p.sum()
        best = int(p.argmax())
        return best, float(p[best])


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLD == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, digest, text) of about twice ``per_language`` texts of every
    language, from rows that are not held out: those whose digest of id and text
    lies below a bound set by the counts."""
    rows = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.xxhash64(F.col("doc_id"), F.col("text")).alias("digest"), "text")
    counts = rows.groupBy(F.col("lang").alias("c_lang")).agg(F.count(F.lit(1)).alias("n"))
    unit = (F.col("digest") / F.lit(float(2 ** 64))) + F.lit(0.5)
    # One row per language, as many as the network has outputs.
    share = F.broadcast(counts.select("c_lang", F.least(F.lit(1.0), F.lit(2.0 * per_language) / F.col("n")).alias("share")))
    return rows.join(share, F.col("lang") == F.col("c_lang")).filter(unit <= F.col("share")).select("lang", "digest", "text")


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column("text"):
            x = windows_of(text.as_buffer().to_pybytes())
            pick = np.unique(np.linspace(0, len(x) - 1, WINDOWS_PER_TEXT).astype(int))
            found.append(b"".join(row.astype(np.uint8).tobytes() for row in x[pick] if (row >= 2).sum() >= 8))
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("digest"), pa.array(found, pa.binary())],
                                         names=["lang", "digest", "windows"])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> ByteConvNet | None:
    """Train on the sample: the ``per_language`` smallest digests per language,
    at most WINDOWS_PER_TEXT windows of WINDOW bytes of each text."""
    sample = (training_rows(docs, per_language)
              .mapInArrow(_sample_windows, "lang string, digest long, windows binary")
              .dropDuplicates(["lang", "digest"]).toPandas())
    sample = sample.sort_values(["lang", "digest"], kind="stable").groupby("lang", sort=True).head(per_language)
    sample = sample[sample["windows"].str.len() > 0]
    if sample.empty:
        return None
    languages = sorted(sample["lang"].unique())
    x = np.frombuffer(b"".join(sample["windows"]), dtype=np.uint8).reshape(-1, WINDOW).astype(np.int64)
    y = np.repeat(np.searchsorted(languages, sample["lang"].to_numpy().astype(str)),
                  sample["windows"].str.len().to_numpy() // WINDOW)
    net = ByteConvNet(languages)
    net.train(x, y)
    return net


def predict(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """``docs`` (needs ``text``) plus lang_pred and score, map-side."""
    own = ("lang_pred", "score", "_has_letter")
    fields = [f for f in docs.schema.fields if f.name not in own]
    schema = T.StructType(fields + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text, letter in zip(batch.column("text"), batch.column("_has_letter").to_pylist()):
                if letter and net is not None:
                    best, p = net.score_text(text.as_buffer().to_pybytes())
                    langs.append(net.languages[best])
                    scores.append(p)
                else:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
            kept = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    marked = docs.select(*[f.name for f in fields]).withColumn(
        "_has_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return marked.mapInArrow(run, schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, lang_pred, score."""
    docs = read_table(spark, sf_dir, "documents")
    net = fit(docs)
    return (predict(docs.select("doc_id", "text", held_out().alias("held_out")), net)
            .select("doc_id", "held_out", "lang_pred", "score"))
