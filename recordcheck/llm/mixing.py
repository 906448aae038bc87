"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key ``-ln(u) / w`` (``u`` uniform, drawn
from a digest of its id and text; ``w`` its quality weight).  Within a source
the documents in ascending key order are a weighted sample without
replacement.  A source's target is a number of words: the whole epochs that
fit come first (every document once per epoch), then the documents in key
order whose prefix sum reaches the rest.

The selected documents of a source are all those up to one *cutoff* key, so
no row-level sort or join is needed: the cutoff is found by a histogram over
a fixed logarithmic grid of keys, then over equal parts of the one cell that
crosses the budget, then exactly among the rows of the one part that crosses
it.  A source with a third of all rows costs the same few small aggregations.
Only DataFrame functions are used.

Defined cases: a null text has size 0 and weight ``MIN_WEIGHT``; size 0 takes
0 words; a null source is a source of its own, ordered last; a null doc_id is
drawn from the text alone; rows equal in doc_id and text have one key and are
taken together or not at all (apart from whole epochs); an empty table gives an
empty result; extra columns pass through ``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordcheck.llm.columns import aside
from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

SOURCE_WEIGHTS = (5, 2, 1)     # repeated over the sources in code point order, null last
SHARE = 1.5                    # of all words
MAX_EPOCHS = 2                 # a source is taken at most so often
SEED = "mix-1"
MIN_WEIGHT = 0.1               # quality weight of the worst text
GRID = 64                      # cells per factor e of the key
PART_ROWS = 20_000             # rows aimed at in one part of a crossing cell

_WORD = r"[^\\x20\\x09-\\x0D]+"
_SYMBOLS = "#*$%&|<>!@"


def word_count(text: str = "text") -> Column:
    return F.expr(f"CAST(coalesce(regexp_count({text}, '{_WORD}'), 0) AS BIGINT)")


def quality_weight(text: str = "text") -> Column:
    """1 for text without symbols, less the more of its characters are symbols."""
    return F.expr(
        f"greatest({MIN_WEIGHT}D, coalesce(1D - CAST(4 * (length({text}) - length(translate({text}, '{_SYMBOLS}', '')))"
        f" AS DOUBLE) / nullif(CAST(length({text}) AS DOUBLE), 0D), {MIN_WEIGHT}D))")


def sample_key(weight: Column, doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> Column:
    """Exponential key: -ln(u) / weight, u from 52 bits of a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                               F.md5(F.coalesce(F.col(text), F.lit("")))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2 ** 52))) / weight


def source_targets(sizes: DataFrame, share: float = SHARE, weights=SOURCE_WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same plus target: ``share`` of all words by
    weight; a target stops at ``max_epochs`` times its source, the excess goes
    to the others by weight until none is above.  One row per source."""
    listed = sizes.withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    cap = F.lit(max_epochs) * F.col("source_size")
    by_ratio = W.orderBy("ratio", "place")
    level = ((F.lit(share) * F.sum("source_size").over(W.partitionBy())
              - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
             / F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
    levels = (listed.withColumn("weight", weight.cast("long")).withColumn("cap", cap)
              .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
              .withColumn("level", level))
    water = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(W.partitionBy())
    return (levels.withColumn("water", water["level"])
            .select("source", "source_size",
                    F.when(F.col("water").isNull() | (F.col("ratio") < F.col("water")), F.col("cap").cast("double"))
                    .otherwise(F.col("weight") * F.col("water")).alias("target")))


def _running(value: str, order: list[str]) -> Column:
    before = W.partitionBy("source").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def cutoffs(items: DataFrame, targets: DataFrame) -> DataFrame:
    """items (source, size, key), targets (source, source_size, target) ->
    targets plus epochs (whole epochs) and cutoff (documents with key <= cutoff
    are taken once more; null: none)."""
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = (targets.withColumn("epochs", epochs.cast("long"))
             .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))

    grid = F.log(F.greatest(F.col("key"), F.lit(1e-300))) * GRID
    items = items.withColumn("cell", F.floor(grid)).withColumn("within", grid - F.col("cell"))
    cells = items.groupBy("source", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    cells = cells.withColumn("before", _running("words", ["cell"]))
    goal = goals.select(F.col("source").alias("g_source"), "rest")
    crossing = (cells.join(goal, F.col("source").eqNullSafe(F.col("g_source")))
                .filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
                .groupBy("source").agg(F.max_by(F.struct("cell", "n", "before", "rest"), F.col("cell")).alias("c"))
                .select(F.col("source").alias("c_source"), "c.*"))
    # The rows of the one crossing cell of every source, cut into equal parts.
    inside = (items.join(crossing.withColumnRenamed("cell", "c_cell"),
                         F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell")))
              .withColumn("part", F.floor(F.col("within") * F.ceil(F.col("n") / PART_ROWS)))
              .select("source", "key", "size", "part", "before", "rest"))
    parts = inside.groupBy("source", "part", "before", "rest").agg(F.sum("size").alias("words"))
    parts = parts.withColumn("before", F.col("before") + _running("words", ["part"]))
    last = (parts.filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
            .groupBy("source").agg(F.max_by(F.struct("part", "before"), F.col("part")).alias("p"))
            .select(F.col("source").alias("p_source"), F.col("p.part").alias("p_part"), F.col("p.before").alias("p_before")))
    rows = (inside.join(last, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part")))
            .groupBy("source", "key", "p_before", "rest").agg(F.sum("size").alias("size")))
    # Whichever end of the document at the boundary lies nearer to the target.
    here = F.col("p_before") + _running("size", ["key"])
    taken = (rows.withColumn("here", here).filter(2 * F.col("here") + F.col("size") <= 2 * F.col("rest"))
             .groupBy("source").agg(F.max("key").alias("exact")))
    # If not even the first row of the part is taken, everything below the part is.
    floor = rows.groupBy("source").agg(F.min("key").alias("part_start"))
    cut = (floor.join(taken, _same_source(floor, taken), "left")
           .select(floor["source"].alias("k_source"),
                   F.coalesce(F.col("exact"), F.col("part_start") - F.lit(0.0)).alias("cutoff"),
                   F.col("exact").isNotNull().alias("inclusive")))
    return (goals.join(cut, F.col("source").eqNullSafe(F.col("k_source")), "left")
            .select("source", "source_size", "target", "epochs", "cutoff", "inclusive"))


def copies(key: Column) -> Column:
    """How often a row is taken, given the columns of ``cutoffs`` beside it."""
    once = F.when(F.col("inclusive"), key <= F.col("cutoff")).otherwise(key < F.col("cutoff"))
    return F.col("epochs") + F.coalesce(once, F.lit(False)).cast("long")


def plan(docs: DataFrame, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(items, source plan): items is the narrow table (doc_id, source, size,
    key) of all rows, written once; the plan has one row per source."""
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "source", word_count().alias("size"),
                         sample_key(quality_weight(), seed=seed).alias("key"))
    items = scratch_table(spark, narrow, "mix-items")
    sizes = items.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_source = scratch_table(spark, cutoffs(items, source_targets(sizes)), "mix-plan")
    return items, by_source


def _with_plan(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    p = by_source.withColumnRenamed("source", "plan_source")
    return rows.join(p, F.col("source").eqNullSafe(F.col("plan_source")), "left").drop("plan_source")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every input row as often as it is taken (0, 1 or 2
    times), with the input's columns."""
    inner, _, restore = aside(docs, "doc_id", "source", "text")
    _, by_source = plan(inner, seed)
    keyed = inner.withColumn("_mix_key", sample_key(quality_weight(), seed=seed)).drop("doc_id", "text")
    often = _with_plan(keyed, by_source).withColumn("_mix_copies", copies(F.col("_mix_key")))
    return restore(often.filter(F.col("_mix_copies") > 0)
                   .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: doc_id, size, source_size, target, taken (words)."""
    items, by_source = plan(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return (_with_plan(items, by_source)
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * copies(F.col("key"))).alias("taken")))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         greatest({MIN_WEIGHT}::DOUBLE, coalesce(1::DOUBLE - (4 * (length(text) - length(translate(text, '{_SYMBOLS}', ''))))::DOUBLE
                  / nullif(length(text), 0)::DOUBLE, {MIN_WEIGHT}::DOUBLE)) AS w
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE
            + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / w AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM k GROUP BY source),
r AS (
  SELECT *, [5, 2, 1][(place % 3 + 1)::INT]::BIGINT AS weight, (2 * source_size)::DOUBLE / [5, 2, 1][(place % 3 + 1)::INT] AS ratio FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
             - coalesce(sum(2 * source_size) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM r),
v AS (SELECT arg_min(level, (ratio, place)) FILTER (level <= ratio) AS water FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN water IS NULL OR ratio < water THEN (2 * source_size)::DOUBLE ELSE weight * water END AS target
  FROM l, v),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
