"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets, per tree, a long hash string: the signs of ``BITS`` random
projections.  A tree is the array of its strings in order; the vectors that
share a prefix with a query are one stretch of it.  A search descends to the
longest match and ascends, in all trees at once, to shorter prefixes until
enough candidates are met:

1. In a few trees the longest matches (at least ``FIRST`` vectors each) give a
   lower bound on the score of the query's last neighbour.
2. A vector with that score shares a prefix of d signs with the query with
   probability (1 - angle / pi) ** d per tree.  All trees ascend to the depth
   at which such a vector is missed by all of them with probability ``MISS`` at
   most, and every vector under these prefixes is scored.

So well-separated data is searched deep and narrow, and data without near
neighbours as broadly as the recall asks.  For inner products, vectors get one
more coordinate that makes all norms equal (the largest norm).

Arrays are cut into segments by prefix and segments into chunks of bounded size
(a hot prefix makes more chunks); queries go to the segments they need and are
streamed past the chunk, so a task holds one chunk however many queries come.
Equal vectors are searched and indexed once; of their ids the smallest ``k`` + 1
are kept, which is all a result can show.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different lengths are never compared;
repeated ids are rows of their own; fewer candidates than ``k`` give shorter
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

TREES = 24
BITS = 62                     # signs in a hash string
FIRST_TREES = 4
FIRST = 200                   # vectors scored at least per first tree
MISS = 0.04                   # chance to miss a neighbour at the bound
CHUNK = 4_000                 # vectors a task holds at once
K = 20
QUERY_EVERY = 20
SEED = 97

_ROW = ("dim int, tree int, seg long, chunk int, is_query int, code long, rep long, vec binary, "
        "bound double, depth int")


def _planes(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(dim + 1, TREES * BITS))


def hash_strings(vectors: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """(rows, trees) hash strings as integers, the first sign the highest bit."""
    dim = vectors.shape[1]
    signs = (np.column_stack([vectors, extra]) @ _planes(dim) > 0).reshape(len(vectors), TREES, BITS)
    powers = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return signs @ powers


def depth_for(score: np.ndarray) -> np.ndarray:
    """Prefix length to ascend to, given the cosine of the last neighbour."""
    near = 1 - np.arccos(np.clip(score, -1, 1)) / math.pi
    wanted = 1 - MISS ** (1 / TREES)
    with np.errstate(divide="ignore"):
        depth = np.floor(np.log(wanted) / np.log(np.clip(near, 1e-6, 1 - 1e-9)))
    return np.clip(depth, 0, BITS).astype(np.int32)


def _classes(table: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """rep, ids (the k + 1 smallest), vec (bytes of doubles), dim: one row per
    distinct usable vector."""
    v = F.col("v")
    usable = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(
        v.isNotNull() & F.col("id").isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0))
    # The filter on the rank also acts before the shuffle, so of a vector that a
    # third of all rows share a task sends k + 1 ids at most.
    rank = F.row_number().over(W.partitionBy("v").orderBy("id"))
    return (usable.withColumn("n", rank).filter(F.col("n") <= k + 1)
            .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
            .select(F.col("ids")[0].alias("rep"), "ids", "v"))


def _coded(batches: Iterator[pa.RecordBatch], largest: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vecs = [np.array(x, dtype=np.float64) for x in batch.column("v").to_pylist()]
        codes: list = [None] * len(vecs)
        query_codes: list = [None] * len(vecs)
        for dim in {len(x) for x in vecs}:
            at = [i for i, x in enumerate(vecs) if len(x) == dim]
            x = np.stack([vecs[i] for i in at])
            norms = np.sqrt((x * x).sum(axis=1))
            # index: norms made equal; query: its direction
            indexed = hash_strings(x / largest, np.sqrt(np.maximum(0.0, 1 - (norms / largest) ** 2)))
            asked = hash_strings(x / norms[:, None], np.zeros(len(x)))
            for i, c, d in zip(at, indexed, asked):
                codes[i], query_codes[i] = c.tolist(), d.tolist()
        packed = [(x.astype(np.float32) if (x.astype(np.float32) == x).all() else x).tobytes() for x in vecs]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("ids"), pa.array([len(x) for x in vecs], pa.int32()),
             pa.array(packed, pa.binary()), pa.array(codes, pa.list_(pa.int64())),
             pa.array(query_codes, pa.list_(pa.int64()))],
            names=["rep", "ids", "dim", "vec", "codes", "query_codes"])


def _unpack(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(b, dtype=np.float32 if len(b) == 4 * dim else np.float64) for b in blobs]
                    ).astype(np.float64)


class _Chunk:
    """One chunk of one segment: a sorted array of hash strings."""

    def __init__(self, dim: int, codes: np.ndarray, reps: np.ndarray, blobs: list[bytes]):
        order = np.argsort(codes, kind="stable")
        self.codes, self.reps = codes[order], reps[order]
        self.vectors = _unpack([blobs[i] for i in order], dim) if len(blobs) else np.zeros((0, dim))

    def stretch(self, code: int, depth: int) -> tuple[int, int]:
        """Rows that share the first ``depth`` signs with ``code``."""
        shift = BITS - depth
        low = (code >> shift) << shift
        return (int(np.searchsorted(self.codes, low, side="left")),
                int(np.searchsorted(self.codes, low + (1 << shift) - 1, side="right")))

    def longest(self, code: int, wanted: int) -> tuple[int, int]:
        """Descend to the longest match, ascend until ``wanted`` rows are met."""
        if len(self.codes) <= wanted:
            return 0, len(self.codes)
        at = int(np.searchsorted(self.codes, code))
        beside = [int(self.codes[i]) ^ code for i in (at - 1, at) if 0 <= i < len(self.codes)]
        depth = max(BITS - x.bit_length() for x in beside)
        low, high = self.stretch(code, depth)
        while high - low < wanted and depth > 0:
            depth -= 1
            low, high = self.stretch(code, depth)
        return low, high


def _search(batches: Iterator[pa.RecordBatch], wanted: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (segment, chunk, is_query): the chunk's vectors are
    gathered, then its queries pass.  ``wanted`` > 0: longest matches; else all
    rows under the query's prefix.  Gives (query, rep, score), at most k a query."""
    key, chunk, gathered = None, None, []
    for batch in batches:
        frame = batch.to_pandas()
        groups = frame.groupby(["dim", "tree", "seg", "chunk"], sort=False)
        for now, rows in groups:
            if now != key:
                key, chunk, gathered = now, None, []
            index = rows[rows["is_query"] == 0]
            if len(index):
                gathered.append(index[["code", "rep", "vec"]])
            queries = rows[rows["is_query"] == 1]
            if not len(queries) or not gathered:
                continue
            dim = int(now[0])
            if chunk is None:
                parts = [np.concatenate([g[c].to_numpy() for g in gathered]) for c in ("code", "rep")]
                chunk = _Chunk(dim, parts[0], parts[1], [b for g in gathered for b in g["vec"]])
            asked = _unpack(list(queries["vec"]), dim)
            stretches: dict[tuple[int, int], list[int]] = {}
            for i, (code, depth) in enumerate(zip(queries["code"], queries["depth"])):
                s = chunk.longest(int(code), wanted) if wanted else chunk.stretch(int(code), int(depth))
                stretches.setdefault(s, []).append(i)
            reps, bounds = queries["rep"].to_numpy(), queries["bound"].to_numpy()
            out_q, out_r, out_s = [], [], []
            for (low, high), members in stretches.items():
                if high <= low:
                    continue
                for at in range(0, len(members), 256):
                    some = members[at:at + 256]
                    scores = asked[some] @ chunk.vectors[low:high].T
                    for i, row in zip(some, scores):
                        hit = np.flatnonzero(row >= bounds[i] - 1e-9)
                        if len(hit) > k:
                            hit = hit[row[hit] >= np.partition(row[hit], len(hit) - k)[len(hit) - k]]
                        out_q.append(np.full(len(hit), reps[i]))
                        out_r.append(chunk.reps[low + hit])
                        out_s.append(row[hit])
            if out_q:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_r)), pa.array(np.concatenate(out_s))],
                    names=["query", "rep", "score"])


def _meet(index: DataFrame, queries: DataFrame, wanted: int, k: int) -> DataFrame:
    keys = ["dim", "tree", "seg", "chunk"]
    return (index.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys, "is_query")
            .mapInArrow(lambda b: _search(b, wanted, k), "query long, rep long, score double"))


def search(table: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = K) -> DataFrame:
    """For every row of ``queries`` (rows of ``table``) its k nearest other rows
    of ``table`` by inner product: query_id, rank, id_col, score."""
    spark = table.sparkSession
    classes = _classes(table, id_col, vec_col, k)
    norm = F.sqrt(F.aggregate(F.col("v"), F.lit(0.0), lambda a, x: a + x * x))
    stored = scratch_table(spark, classes, "ann-classes")
    n, largest = stored.agg(F.count(F.lit(1)), F.max(norm)).first()
    result = f"query_id long, rank int, {id_col} long, score double"
    if not n:
        return spark.createDataFrame([], result)
    schema = ("rep long, ids array<long>, dim int, vec binary, codes array<long>, query_codes array<long>")
    coded = scratch_table(spark, stored.mapInArrow(lambda b: _coded(b, float(largest)), schema), "ann-codes")

    bits = max(0, math.ceil(math.log2(n / CHUNK))) if n > CHUNK else 0
    seg = F.shiftright(F.col("code"), BITS - bits)
    none = {"bound": F.lit(None).cast("double"), "depth": F.lit(None).cast("int")}
    arrays = coded.select("dim", "rep", "vec", F.posexplode("codes").alias("tree", "code")).withColumn("seg", seg)
    counts = arrays.groupBy("dim", "tree", "seg").agg(F.count(F.lit(1)).alias("rows"))
    chunks = scratch_table(spark, counts.select("dim", "tree", "seg", F.ceil(F.col("rows") / CHUNK).cast("int").alias("chunks")),
                           "ann-segments")
    on = ["dim", "tree", "seg"]
    columns = [c.split()[0] for c in _ROW.split(", ")]
    index = (arrays.join(chunks, on).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
             .withColumn("is_query", F.lit(0)).withColumns(none).select(*columns))

    # Which vectors are asked for, each once.
    rows = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = scratch_table(spark, rows.join(stored.select("rep", "v"), "v").select("query_id", "rep"), "ann-queries")
    distinct = asked.select("rep").distinct().join(coded, "rep").select(
        "dim", "rep", "vec", F.posexplode("query_codes").alias("tree", "code"))

    def to_chunks(q: DataFrame) -> DataFrame:
        return (q.join(chunks, on).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                .withColumn("is_query", F.lit(1)).select(*columns))

    first = to_chunks(distinct.filter(F.col("tree") < FIRST_TREES).withColumn("seg", seg)
                      .withColumn("bound", F.lit(float("-inf"))).withColumn("depth", F.lit(0)))
    best = _meet(index.filter(F.col("tree") < FIRST_TREES), first, FIRST, k + 1).groupBy("query", "rep").agg(
        F.min("score").alias("score"))
    best = scratch_table(spark, best, "ann-first")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "rep"))
    bounds = (best.withColumn("place", rank).filter(F.col("place") == k + 1)
              .select(F.col("query").alias("b_query"), F.col("score").alias("bound")))
    bounds = scratch_table(spark, bounds, "ann-bounds")

    def with_depth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.to_pandas()
            norms = np.array([np.sqrt((_unpack([b], d) ** 2).sum()) for b, d in zip(f["vec"], f["dim"])])
            bound = f["bound"].fillna(-np.inf).to_numpy()
            f["depth"] = depth_for(np.where(np.isfinite(bound), bound, -norms * largest) / (norms * largest))
            f["bound"] = bound
            yield pa.RecordBatch.from_pandas(f, preserve_index=False)

    deep = (distinct.join(bounds, F.col("rep") == F.col("b_query"), "left").drop("b_query")
            .select("dim", "rep", "vec", "tree", "code", "bound", F.lit(0).alias("depth"))
            .mapInArrow(with_depth, "dim int, rep long, vec binary, tree int, code long, bound double, depth int"))
    # A prefix shorter than a segment's covers several segments.
    start = F.expr(f"shiftleft(shiftright(code, {BITS} - least(depth, {bits})), greatest({bits} - depth, 0))")
    spread = deep.withColumn("seg", F.explode(F.sequence(start, start + F.expr(f"shiftleft(1L, greatest({bits} - depth, 0)) - 1L"))))
    met = _meet(index, to_chunks(spread), 0, k + 1)
    # One row per (query, rep): trees meet the same vector; then the smallest ids.
    pairs = met.unionByName(best).groupBy("query", "rep").agg(F.max("score").alias("near"))
    pairs = pairs.withColumn("place", F.row_number().over(W.partitionBy("query").orderBy(F.desc("near"), "rep")))
    return _ranked(spark, pairs.filter(F.col("place") <= 2 * (k + 1)), coded, asked, id_col, k)


def _ranked(spark: SparkSession, pairs: DataFrame, coded: DataFrame, asked: DataFrame, id_col: str, k: int) -> DataFrame:
    """Exact scores of the last candidates and the k best rows of every query."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.to_pandas()
            score = [float((_unpack([a], d)[0] * _unpack([b], d)[0]).sum())
                     for a, b, d in zip(f["vec"], f["q_vec"], f["dim"])]
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("ids"), pa.array(score, pa.float64())],
                                             names=["query", "ids", "score"])

    vectors = coded.select("rep", "ids", "vec", "dim")
    with_both = (pairs.select("query", "rep").join(vectors, "rep")
                 .join(vectors.select(F.col("rep").alias("query"), F.col("vec").alias("q_vec")), "query"))
    scored = with_both.select("query", "ids", "vec", "q_vec", "dim").mapInArrow(
        exact, "query long, ids array<long>, score double")
    rows = scored.select("query", "score", F.explode("ids").alias(id_col))
    best = W.partitionBy("query").orderBy(F.desc("score"), id_col)
    top = rows.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    own = asked.join(top, F.col("rep") == F.col("query")).filter(F.col(id_col) != F.col("query_id"))
    final = W.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return (own.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), id_col, "score"))


def op8_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    table = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(table, table.filter(F.col("vec_id") % QUERY_EVERY == 0))
