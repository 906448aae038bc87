"""Substring deduplication by level-wise doubling.

Windows of ``LEVEL / 2`` words are looked at first.  Only where such a window
occurs in several documents is it extended to ``LEVEL`` words, the length that
counts for removal; what repeats at that length is extended to twice the length,
and so on until no candidate survives.

* The first level needs one window per place that any longer window could hang
  on: of the ``LEVEL / 2``-word windows inside a ``LEVEL``-word window, the one
  with the smallest hash (two equal long windows choose the same one).  Those
  anchors, about one in thirteen words, are counted over all documents by
  partial aggregation (smallest and largest doc_id).
* At ``LEVEL``, every window hanging on a repeated anchor is counted, and a word
  is removed if a window over it starts in a document with a smaller doc_id.
* Above, windows that start at an anchor are followed; the longest level at which
  a document still repeats another is reported.

Documents with equal word sequences are folded first: all but the smallest
doc_id lose every word, and only that one is compared further.  Texts travel
once, to the documents with a repeated anchor; a passage in a third of all
documents is one row per task after partial aggregation.

Defined cases: null text has no words; a null doc_id has no order, so such rows
lose nothing and remove nothing; rows with one doc_id do not remove each
other's words (their doc_id is not smaller); an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordcheck.llm import words as WD
from recordcheck.llm.skew import join_counted
from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

LEVEL = 50                    # words of a window that is removed
_FIRST, _SECOND = WD.Hasher(23), WD.Hasher(29)


def _word_hashes(raw: bytes, hasher: WD.Hasher) -> np.ndarray:
    data, starts, ends = WD.spans(raw)
    return hasher.words(data, starts, ends)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _raw(text) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _anchors(level: int):
    """doc_id, n_words, sha of the words, anchor hashes of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = level // 2
        for batch in batches:
            n, sha, anchors = [], [], []
            for text in batch.column("text"):
                raw = _raw(text)
                words = raw.split()
                n.append(len(words))
                sha.append(_sha(words))
                found = None
                if len(words) >= level:
                    h = _FIRST.windows(_word_hashes(raw, _FIRST), half)
                    found = np.unique(h[WD.minimizers(h, level - half + 1)]).view(np.int64)
                anchors.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(anchors, pa.list_(pa.int64()))], names=["doc_id", "n_words", "sha", "anchors"])
    return run


def _candidates(level: int):
    """Of a document with its repeated anchors: the windows of ``level`` words
    hanging on one, and for every repeated anchor the hashes of the windows of
    level, 2 level, 4 level, ... words that start there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = level // 2
        for batch in batches:
            places, one, two, tall, shas = [], [], [], [], []
            for text, repeated in zip(batch.column("text"), batch.column("repeated").to_pylist()):
                raw = _raw(text)
                shas.append(_sha(raw.split()))
                a, b = _word_hashes(raw, _FIRST), _word_hashes(raw, _SECOND)
                if len(a) < level:
                    places.append([]), one.append([]), two.append([]), tall.append([])
                    continue
                h = _FIRST.windows(a, half)
                known = np.array(repeated, dtype=np.int64).view(np.uint64)
                of_each = WD.minimizer_of_each(h, level - half + 1)
                at = np.flatnonzero(np.isin(h[of_each], known))
                places.append(at.astype(np.int32))
                one.append(_FIRST.windows(a, level)[at].view(np.int64))
                two.append((_SECOND.windows(b, level)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                starts, size, levels = np.unique(of_each[at]), level, []
                while len(starts := starts[starts + size <= len(a)]):
                    levels.append(_FIRST.windows(a, size)[starts].view(np.int64))
                    size *= 2
                tall.append([[int(x[i]) for x in levels if i < len(x)] for i in range(len(levels[0]))] if levels else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(shas, pa.string()),
                 pa.array(places, pa.list_(pa.int32())), pa.array(one, pa.list_(pa.int64())),
                 pa.array(two, pa.list_(pa.int32())), pa.array(tall, pa.list_(pa.list_(pa.int64())))],
                names=["doc_id", "text", "sha", "place", "h1", "h2", "tall"])
    return run


def _removed(level: int):
    """sha, number of removed words and kept words of documents with the places
    of windows to remove."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, kept = [], []
            for text, places in zip(batch.column("text"), batch.column("places")):
                words = _raw(text).split()
                at = places.values.to_numpy()
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + level, -1)
                cover = np.cumsum(edge[:-1]) > 0
                gone.append(int(cover.sum()))
                kept.append(b" ".join(w for w, c in zip(words, cover.tolist()) if not c))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("sha"), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "sha", "n_removed", "kept"])
    return run


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, least, n), stored: keys that occur with several doc_ids, the smallest
    one, how many rows have the key."""
    found = rows.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
                                    F.count(F.lit(1)).alias("n")).filter("least < most").drop("most")
    return scratch_table(rows.sparkSession, found, "substring-repeated")


def _longest(spark: SparkSession, tall: DataFrame, level: int) -> DataFrame:
    """(row, longest): follow the windows at anchors from level to level."""
    alive = scratch_table(spark, tall.filter(F.size("tall") > 0), "substring-level")
    found = None
    step, size = 0, level
    while alive.limit(1).count():
        here = alive.withColumn("hash", F.col("tall")[step])
        again = _repeated(here, ["hash"]).select("hash", "n")
        alive = scratch_table(spark, join_counted(here, again, ["hash"], "n").select("row", "doc_id", "tall"), "substring-level")
        reached = alive.select("row", F.lit(size).alias("longest")).distinct()
        found = reached if found is None else found.unionByName(reached)
        step, size = step + 1, size * 2
        alive = alive.filter(F.size("tall") > step)
    if found is None:
        return spark.createDataFrame([], "row long, longest int")
    return found.groupBy("row").agg(F.max("longest").alias("longest"))


def remove_repeats(docs: DataFrame, level: int = LEVEL) -> DataFrame:
    """doc_id, n_words, n_removed, kept (null where nothing is removed: the
    text's own words), kept_sha256 and longest_repeat of every row of docs
    (doc_id, text)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    first = scratch_table(spark, docs.mapInArrow(
        _anchors(level), f"doc_id {kind}, n_words long, sha string, anchors array<long>"), "substring-first")

    long = first.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= level))
    heads = scratch_table(spark, long.groupBy("sha").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("times")),
                          "substring-heads")
    # Documents that are compared: the first of every set of equal ones.
    compared = long.join(heads, (long["sha"] == heads["sha"]) & (F.col("doc_id") == F.col("head"))).select("doc_id", "anchors")
    anchors = compared.select("doc_id", F.explode("anchors").alias("anchor"))
    marks = (join_counted(anchors, _repeated(anchors, ["anchor"]), ["anchor"], "n").groupBy(F.col("doc_id").alias("m_doc"))
             .agg(F.collect_set("anchor").alias("repeated")))
    cand = scratch_table(spark, docs.join(marks, F.col("doc_id") == F.col("m_doc")).select("doc_id", "text", "repeated")
                         .mapInArrow(_candidates(level), f"doc_id {kind}, text string, sha string, place array<int>, "
                                     "h1 array<long>, h2 array<int>, tall array<array<long>>")
                         .withColumn("row", F.monotonically_increasing_id()), "substring-candidates")
    windows = cand.select("doc_id", "row", F.explode(F.arrays_zip("place", "h1", "h2")).alias("w")).select(
        "doc_id", "row", "w.place", "w.h1", "w.h2")
    # A window that a large share of all documents has stays out of the shuffle.
    later = join_counted(windows, _repeated(windows, ["h1", "h2"]), ["h1", "h2"], "n").filter(F.col("doc_id") > F.col("least"))
    places = later.groupBy(F.col("row").alias("p_row")).agg(F.collect_list("place").alias("places"))
    cut = (cand.select("row", "doc_id", "sha", "text").join(places, F.col("row") == F.col("p_row"))
           .select("doc_id", "sha", "text", "places")
           .mapInArrow(_removed(level), f"doc_id {kind}, sha string, n_removed long, kept string"))
    reach = _longest(spark, cand.select("row", "doc_id", F.explode("tall").alias("tall")), level)
    reach = cand.select("row", "doc_id", "sha").join(reach, "row").select(
        F.col("doc_id").alias("r_doc"), F.col("sha").alias("r_sha"), "longest").distinct()

    rows = first.join(heads.withColumnRenamed("sha", "h_sha"), F.col("sha") == F.col("h_sha"), "left")
    copy = F.col("doc_id") > F.col("head")
    rows = rows.withColumn("copy", F.coalesce(copy, F.lit(False)) & (F.col("n_words") >= level))
    cut = cut.select(F.col("doc_id").alias("c_doc"), F.col("sha").alias("c_sha"), "n_removed", "kept").dropDuplicates(["c_doc", "c_sha"])
    rows = rows.join(cut, (F.col("doc_id") == F.col("c_doc")) & (F.col("sha") == F.col("c_sha")), "left")
    rows = rows.join(reach, (F.col("doc_id") == F.col("r_doc")) & (F.col("sha") == F.col("r_sha")), "left")
    whole = F.lit(level) * F.pow(F.lit(2), F.floor(F.log2(F.col("n_words") / level)))
    copied = F.coalesce(F.col("times") > 1, F.lit(False)) & F.col("doc_id").isNotNull()
    kept = F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept"))
    return rows.select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        kept.alias("kept"),
        F.when(kept.isNotNull(), F.sha2(kept, 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.greatest(F.when(copied, whole), F.col("longest"), F.lit(0)).cast("long").alias("longest_repeat"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_words, n_removed, kept_sha256, longest_repeat."""
    return remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "longest_repeat")
