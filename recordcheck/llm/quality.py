"""Quality rules by robust multivariate outliers.

Every text gives exact base counts and a vector of transformed statistics.
For each (lang, source) the centre and scatter of the vectors are estimated
by the minimum-covariance-determinant method: concentration steps that keep,
each time, the ``H_SHARE`` of the rows with the smallest Mahalanobis distance
and re-estimate from them, until the group's determinant no longer falls by
``TOLERANCE``; a group that is done takes no part in the steps of the others.
(With the same number of rows kept, a step cannot raise the determinant; rows
of one distance step are kept together, so near the end it may.  Then the former,
lower one stays.)  A group still falling after ``MAX_STEPS`` is an error.  The start
is the coordinate-wise median and median absolute deviation, so reruns agree;
statistics are fixed-point integers and moments are sums of longs, so the
result does not depend on the order of rows either.  A document whose
distance is beyond ``CUTOFF`` is rejected.

All rows take part in every estimate.  A step is one job: every task scores its
rows against the models and adds up counts and moments per (model, step of the
distance); these are summed per step, and per model the steps are added up
to the one that holds the ``H_SHARE``.  Steps far from the last limit are lumped
(and the step is repeated without lumps should the limit fall among them), so a
task sends a few hundred short rows per model however many rows it has.  Models
go to tasks ``MODELS`` at a time, which bounds what a task or the driver holds.

Groups under ``MIN_GROUP`` rows use the estimate of their language, languages
under it that of the whole table; with fewer rows in all, only the base rules
decide.  Defined cases: a null text is an empty text (no words, base rules fail
it); null lang or source are values of their own; null and repeated ids are
judged row by row; a very long text is one text held in a task; an empty table
gives an empty result; extra columns pass through ``quality_filter`` untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordcheck.llm import words as WD
from recordcheck.llm.columns import aside
from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
H_SHARE = 0.75                # rows kept by a concentration step
MIN_GROUP = 100               # rows a group needs for an estimate of its own
TOLERANCE = 1e-3              # change of a log determinant that ends a group's steps
MAX_STEPS = 100               # far above what groups need (an error names those that reach it)
MODELS = 10_000               # models that are estimated at once
NEAR = 64                     # distance steps around the last limit that are told apart
CUTOFF = 12.0                 # Mahalanobis distance (median scaled to that of a normal vector)
UNIT = 1024                   # fixed-point steps of a statistic

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# name -> smallest standard deviation assumed (many statistics are 0 in most texts)
VECTOR = {"log_words": 0.5, "word_length": 0.15, "length_spread": 0.3, "symbols": 0.5, "capitals": 0.15,
          "marks": 0.3, "repeats": 0.6, "dup_lines": 1.2, "variety": 0.05}
DIM = len(VECTOR)

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(SYMBOLS)] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[list(b".,;:!?")] = 3
_HASHER = WD.Hasher(3)


def text_stats(raw: bytes) -> tuple[list[int], list[float]]:
    """(base counts, statistic vector) of one text."""
    data, starts, ends = WD.spans(raw)
    n = len(starts)
    if not n:
        return [0, 0, int(sum(raw.count(c) for c in SYMBOLS)), 0, 0], [0.0] * DIM
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    lengths = (heads[ends] - heads[starts]).astype(np.float64)
    chars = int(lengths.sum())
    kinds = np.bincount(_KIND[data], minlength=4)
    seen: set[bytes] = set()
    dup = lines = 0
    for line in raw.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            lines += 1
            dup += line in seen
            seen.add(line)
    hashes = _HASHER.words(data, starts, ends)
    repeated = 0
    if n >= 3:
        _, where, times = np.unique(_HASHER.windows(hashes, 3), return_inverse=True, return_counts=True)
        hits = np.concatenate((times[where] > 1, [False, False]))
        repeated = int((hits | np.roll(hits, 1) | np.roll(hits, 2)).sum())
    counts = [n, chars, int(kinds[1]), dup, repeated]
    vector = [np.log(n), chars / n, np.log1p(lengths.std()), np.arcsinh(50 * kinds[1] / chars),
              np.arcsinh(10 * kinds[2] / chars), np.arcsinh(5 * kinds[3] / n),
              np.arcsinh(10 * repeated / n), np.arcsinh(10 * dup / lines),
              np.log(len(np.unique(hashes))) / np.log(n) if n > 1 else 1.0]
    return counts, [float(x) for x in vector]


def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, vectors = [], []
        for text in batch.column("text"):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            c, v = text_stats(raw)
            counts.append(c)
            vectors.append([int(round(x * UNIT)) for x in v])
        kept = [name for name in batch.schema.names if name not in OWN]
        columns = [batch.column(name) for name in kept]
        table = np.array(counts, dtype=np.int64).reshape(-1, len(COUNTS))
        columns += [pa.array(table[:, i]) for i in range(len(COUNTS))]
        columns.append(pa.array(vectors, type=pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(columns, names=[*kept, *COUNTS, "vector"])


OWN = (*COUNTS, "vector", "base_failed", "kept", "distance")


def with_stats(docs: DataFrame) -> DataFrame:
    """``docs`` (needs ``text``) plus the base counts, base_failed and vector."""
    fields = [f for f in docs.schema.fields if f.name not in OWN]
    schema = T.StructType(fields + [T.StructField(c, T.LongType()) for c in COUNTS]
                          + [T.StructField("vector", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(_stats_batches, schema).withColumn("base_failed", base_failed())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


# Estimates ---------------------------------------------------------------------

_PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
_FLOOR = np.array(list(VECTOR.values()))
_CHI2_MEDIAN = DIM * (1 - 2 / (9 * DIM)) ** 3
_LOG_STEPS = 256              # histogram steps of a squared distance, per factor e
_FAR = 1 << 30                # beyond every step
_I, _J = (np.array(x) for x in zip(*_PAIRS))


class _Models:
    """Models of a chunk: names, centres, precision matrices, log determinants."""

    def __init__(self, names: list[str], center: np.ndarray, cov: np.ndarray):
        self.names = names
        self.center = center
        full = cov + np.diag(_FLOOR ** 2)
        self.precision = np.linalg.inv(full)
        self.logdet = np.linalg.slogdet(full)[1]

    def only(self, at: np.ndarray) -> "_Models":
        """The chosen ones (numbers or flags)."""
        out = _Models.__new__(_Models)
        out.names = np.array(self.names, dtype=object)[at].tolist() if self.names else []
        out.center, out.precision, out.logdet = self.center[at], self.precision[at], self.logdet[at]
        return out

    def put(self, at: np.ndarray, other: "_Models") -> None:
        for column in ("center", "precision", "logdet"):
            getattr(self, column)[at] = getattr(other, column)

    def terms(self, m: int) -> list[float]:
        """Precision terms of x_i x_j for i <= j."""
        return [float(self.precision[m, i, j] * (1 if i == j else 2)) for i, j in _PAIRS]


def _model_numbers(batch: pa.RecordBatch, number: dict[str, int]) -> np.ndarray:
    encoded = batch.column("model").dictionary_encode()
    known = np.array([number.get(x, -1) for x in encoded.dictionary.to_pylist()], dtype=np.int64)
    return known[encoded.indices.to_numpy()]


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy().reshape(-1, DIM)


def _steps_of(x: np.ndarray, center: np.ndarray, precision: np.ndarray) -> np.ndarray:
    z = x / UNIT - center
    return np.round(_LOG_STEPS * np.log1p(np.maximum(np.einsum("ni,nij,nj->n", z, precision, z), 0.0))).astype(np.int64)


_PART = "model int, step int, n long, moments array<long>"


def _rows(keys: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    """Rows (model, step, n, moments) of keys model << 32 | step."""
    return pa.RecordBatch.from_arrays(
        [pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(table[:, 0]),
         pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * (table.shape[1] - 1)),
                                  pa.array(table[:, 1:].ravel()))], names=["model", "step", "n", "moments"])


def _added(held: dict[int, np.ndarray], keys: np.ndarray, table: np.ndarray) -> None:
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    for key, row in zip(keys[order][starts].tolist(), np.add.reduceat(table[order], starts, axis=0)):
        held[key] = held[key] + row if key in held else row


def _partial(models: _Models, low: np.ndarray, high: np.ndarray, moments: bool):
    """Counts (and moments) of a task's rows per model and step; steps under
    ``low`` are lumped with it, rows beyond ``high`` only counted."""
    number = {n: i for i, n in enumerate(models.names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            of = _model_numbers(batch, number)
            rows = np.flatnonzero(of >= 0)
            if not len(rows):
                continue
            of, x = of[rows], _vectors(batch)[rows]
            step = np.clip(_steps_of(x, models.center[of], models.precision[of]), low[of], None)
            beyond = step > high[of]
            step[beyond] = _FAR
            table = np.ones((len(x), 1), dtype=np.int64)
            if moments:
                inside = np.where(beyond[:, None], 0, x)
                table = np.hstack([table, inside, inside[:, _I] * inside[:, _J]])
            _added(held, of << 32 | step, table)
        if held:
            keys = np.array(sorted(held), dtype=np.int64)
            yield _rows(keys, np.stack([held[k] for k in keys.tolist()]))
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        if batch.num_rows:
            keys = batch.column("model").to_numpy().astype(np.int64) << 32 | batch.column("step").to_numpy().astype(np.int64)
            n = batch.column("n").to_numpy()
            _added(held, keys, np.hstack([n[:, None], batch.column("moments").flatten().to_numpy().reshape(len(n), -1)]))
    if held:
        keys = np.array(sorted(held), dtype=np.int64)
        yield _rows(keys, np.stack([held[k] for k in keys.tolist()]))


_LIMITS = "model int, total long, low int, limit int, upper int, n long, moments array<long>"


def _limits(share: float):
    """Per model (rows in a row): the steps of the rows around the ``share`` of
    all, and count and moments up to the lower one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.concat_tables(tables)
        model, step, n = (t.column(c).to_numpy().astype(np.int64) for c in ("model", "step", "n"))
        moments = t.column("moments").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
        out = []
        for m in np.unique(model).tolist():
            at = np.flatnonzero(model == m)
            at = at[np.argsort(step[at])]
            counts = np.cumsum(n[at])
            place = (counts[-1] - 1) * share
            lower, upper = (int(np.searchsorted(counts, k, side="right")) for k in (int(np.floor(place)), int(np.ceil(place))))
            inside = at[:lower + 1]
            out.append((m, int(counts[-1]), int(step[at][0]), int(step[at][lower]), int(step[at][upper]), int(n[inside].sum()),
                        moments[inside].sum(axis=0).tolist()))
        columns = list(zip(*out))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in _LIMITS.split(", ")])
    return run


def _pass(fit: DataFrame, models: _Models, low: np.ndarray, high: np.ndarray, share: float, moments: bool) -> list:
    """One job over all rows: a row per model (see ``_limits``)."""
    parts = fit.select("model", "vector").mapInArrow(_partial(models, low, high, moments), _PART)
    # A step of a model is one row per task, then one; a model at most some
    # thousand steps.
    return (parts.repartition("model", "step").mapInArrow(_summed, _PART).repartition("model")
            .mapInArrow(_limits(share), _LIMITS).collect())


def _concentrated(fit: DataFrame, models: _Models) -> None:
    """Concentration steps until every determinant is stable."""
    count = len(models.names)
    moving = np.ones(count, dtype=bool)
    low, high = np.zeros(count, dtype=np.int64), np.full(count, _FAR - 1)
    for k in range(MAX_STEPS):
        at = np.flatnonzero(moving)
        some = models.only(at)
        found = _pass(fit, some, low[at], high[at], H_SHARE, True)
        again = [r["model"] for r in found if r["limit"] == _FAR or (r["limit"] == r["low"] == low[at[r["model"]]] > 0)]
        if again:                                                  # the limit is among lumped steps
            low[at[again]], high[at[again]] = 0, _FAR - 1
            found = _pass(fit, some, low[at], high[at], H_SHARE, True)
        which = np.array([at[r["model"]] for r in found], dtype=np.int64)
        n = np.array([r["n"] for r in found], dtype=float)[:, None]
        sums = np.array([r["moments"] for r in found], dtype=float)
        mean = sums[:, :DIM] / n
        cov = np.zeros((len(found), DIM, DIM))
        cov[:, _I, _J] = cov[:, _J, _I] = sums[:, DIM:] / n - mean[:, _I] * mean[:, _J]
        better = _Models([], mean / UNIT, cov / UNIT ** 2)
        fall = models.logdet[which] - better.logdet
        # The start is no estimate from kept rows: its determinant tells nothing.
        moving = np.zeros(count, dtype=bool)
        moving[which] = (fall >= TOLERANCE) | (k == 0)
        taken = (fall > -TOLERANCE) | (k == 0)
        models.put(which[taken], better.only(taken))
        limit = np.array([r["limit"] for r in found], dtype=np.int64)
        low[which], high[which] = np.maximum(limit - NEAR, 0), limit + NEAR
        if not moving.any():
            return
    raise RuntimeError(f"quality models still move after {MAX_STEPS} steps: {[models.names[i] for i in np.flatnonzero(moving)][:5]}")


def _squared_distance() -> Column:
    """Sum of precision[k] z_i z_j over the pairs i <= j, as array functions: one
    short expression instead of a long generated one."""
    return F.expr(f"""aggregate(zip_with(precision, zip_with(transform({_array(0)}, i -> vector[i] / {UNIT}D - center[i]),
        transform({_array(1)}, j -> vector[j] / {UNIT}D - center[j]), (a, b) -> a * b), (p, q) -> p * q), 0D, (x, y) -> x + y)""")


def _array(place: int) -> str:
    return "array(" + ", ".join(str(pair[place]) for pair in _PAIRS) + ")"


def _assignments(rows: DataFrame) -> DataFrame:
    """(lang, source) -> model that judges it, models its rows are used for."""
    groups = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    per_lang = groups.groupBy(F.col("lang").alias("l_lang")).agg(F.sum("n").alias("n_lang"),
                                                               F.min("n").alias("least"))
    n_all, least_lang = per_lang.agg(F.coalesce(F.sum("n_lang"), F.lit(0)), F.coalesce(F.min("n_lang"), F.lit(0))).first()
    enough = n_all >= MIN_GROUP
    name = {"source": F.to_json(F.struct(F.lit("source").alias("level"), "lang", "source")),
            "lang": F.to_json(F.struct(F.lit("lang").alias("level"), "lang")),
            "all": F.lit('{"level":"all"}')}
    big, big_lang = F.col("n") >= MIN_GROUP, F.col("n_lang") >= MIN_GROUP
    none = F.lit(None).cast("string")
    return (groups.join(per_lang, F.col("lang").eqNullSafe(F.col("l_lang")))
            .select("lang", "source",
                    F.when(big, name["source"]).when(big_lang, name["lang"]).when(F.lit(enough), name["all"]).alias("judge"),
                    F.array_compact(F.array(
                        F.when(big, name["source"]).otherwise(none),
                        F.when(big_lang & (F.col("least") < MIN_GROUP), name["lang"]).otherwise(none),
                        F.when(F.lit(enough and least_lang < MIN_GROUP), name["all"])
                        .otherwise(none))).alias("fits")))


def estimate(stats: DataFrame) -> DataFrame:
    """stats (lang, source, base_failed, vector; a stored table) -> one row per
    (lang, source): center, precision, scale (null without an estimate)."""
    spark = stats.sparkSession
    rows = stats.filter(~F.col("base_failed")).select("lang", "source", "vector")
    assigned = scratch_table(spark, _assignments(rows), "quality-groups")
    fit = (rows.join(assigned.withColumnsRenamed({"lang": "a_lang", "source": "a_source"}),
                     F.col("lang").eqNullSafe(F.col("a_lang")) & F.col("source").eqNullSafe(F.col("a_source")))
           .select(F.explode("fits").alias("model"), "vector"))
    fit = scratch_table(spark, fit, "quality-fit")          # every step reads it: small plans
    names = fit.select("model").distinct()
    chunks = max(1, -(-names.count() // MODELS))
    chunk = F.pmod(F.xxhash64("model"), F.lit(chunks))
    done = None
    for c in range(chunks):
        part = fit if chunks == 1 else fit.filter(chunk == c)
        models = _start(part)
        if not models.names:
            continue
        _concentrated(part, models)
        full = np.zeros(len(models.names), dtype=np.int64), np.full(len(models.names), _FAR - 1)
        half = {r["model"]: (r["limit"] + r["upper"]) / 2 for r in _pass(part, models, *full, 0.5, False)}
        rows = [(name, [float(x) for x in models.center[m]], models.terms(m), _CHI2_MEDIAN / max(float(np.expm1(half[m] / _LOG_STEPS)), 1e-9))
                for m, name in enumerate(models.names)]
        local = spark.createDataFrame(rows, _ESTIMATE)
        done = local if done is None else done.unionByName(local)
    done = spark.createDataFrame([], _ESTIMATE) if done is None else done
    out = (assigned.join(done, F.col("judge") == F.col("model"), "left")
           .select(F.col("lang").alias("m_lang"), F.col("source").alias("m_source"), "center", "precision", "scale"))
    return scratch_table(spark, out, "quality-estimate")


_ESTIMATE = "model string, center array<double>, precision array<double>, scale double"


def _start(fit: DataFrame) -> _Models:
    """Median and squared median deviation per coordinate -> diagonal models."""
    def medians(of: list[Column]) -> Column:
        return F.array(*[F.percentile(c, F.lit(0.5)) for c in of])

    middle = fit.groupBy("model").agg(medians([F.col("vector")[i] for i in range(DIM)]).alias("median")).collect()
    if not middle:
        return _Models([], np.zeros((0, DIM)), np.zeros((0, DIM, DIM)))
    local = fit.sparkSession.createDataFrame([(r["model"], [int(np.round(x)) for x in r["median"]]) for r in middle],
                                             "model string, centre array<long>")
    spread = {r["model"]: r["mad"] for r in fit.join(F.broadcast(local), "model").groupBy("model").agg(
        medians([F.abs(F.col("vector")[i] - F.col("centre")[i]) for i in range(DIM)]).alias("mad")).collect()}
    names = sorted(spread)
    center = {r["model"]: r["median"] for r in middle}
    mad = 1.4826 * np.array([spread[n] for n in names]) / UNIT
    return _Models(names, np.array([center[n] for n in names]) / UNIT, mad[:, :, None] ** 2 * np.eye(DIM))


def judged(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    """``stats`` plus distance (null without an estimate) and kept."""
    with_model = stats.join(estimates, F.col("lang").eqNullSafe(F.col("m_lang"))
                            & F.col("source").eqNullSafe(F.col("m_source")), "left")
    distance = F.sqrt(F.greatest(_squared_distance() * F.col("scale"), F.lit(0.0)))
    return (with_model.withColumn("distance", F.when(~F.col("base_failed"), distance))
            .drop("m_lang", "m_source", "center", "precision", "scale")
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUTOFF)))


def _narrow(docs: DataFrame, columns: list[str]) -> DataFrame:
    return with_stats(docs.select(*columns, "lang", "source", "text")).drop("text")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and are no outliers.  The
    text is read twice (statistics, then the filter) rather than stored with its
    statistics, and never shuffled unless the table of estimates is too large to
    broadcast."""
    inner, carried, _ = aside(docs, "lang", "source", "text")
    # The operator's own three columns travel once, under their own names.
    own = {c: n for n, c in zip(docs.columns, carried) if n in ("lang", "source", "text")}
    inner = inner.drop(*own)
    stats = scratch_table(docs.sparkSession, _narrow(inner, []), "quality-stats")
    kept = judged(with_stats(inner), estimate(stats)).filter("kept")
    return kept.select(*[F.col(own.get(c, c)).alias(n) for n, c in zip(docs.columns, carried)])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, the base counts, base_failed, kept, distance."""
    docs = read_table(spark, sf_dir, "documents")
    stats = scratch_table(spark, _narrow(docs, ["doc_id"]), "quality-stats")
    return judged(stats, estimate(stats)).select("doc_id", *COUNTS, "base_failed", "kept", "distance")
