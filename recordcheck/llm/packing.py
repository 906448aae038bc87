"""Best-fit packing of token sequences by a configuration linear program.

Texts become token ids (plus an end id); texts longer than a sequence are cut
into full pieces, the first of which may be shorter.  How pieces go together
depends on their lengths alone, so the packing is planned on the histogram of
lengths, which has at most ``capacity`` entries however large the corpus is:

* a *configuration* is a multiset of lengths that fits one sequence; the linear
  program covers every length's count with as few configurations as possible;
* it is solved by multiplicative weights: every length carries a weight (its
  dual price), an unbounded knapsack by dynamic programming prices the best
  configurations around the lengths still open until every length is covered,
  and after each round the weights are multiplied towards what the lengths came
  to cost.  The average of the covers of the later half of the rounds (the first
  prices are far off) is the fractional solution;
* it is rounded: every configuration is used the whole part of its times, and
  what these leave open is covered by configurations at the last prices.  The
  last uses of a rounding are packed best fit instead, longest first, where that
  is shorter.  After every round the solution so far is rounded, and the
  shortest plan is taken.

The plan (configurations, how often each is used, lengths) is a small table.
Pieces of one length are then numbered 0, 1, 2, ... in a distributed way
(counts per bucket of ids, offsets, numbers within a bucket) and number i takes
the i-th slot of that length; no sequence is ever assembled in one task.

Defined cases: a null or empty text is the end id alone; null ids and repeated
rows are packed like any other row (equal pieces take their numbers in any
order, which changes no output row); a very long text is one text held in a task
while it is cut; an empty table gives an empty result; extra columns are not
carried by ``pack`` unless named in ``keep``, and a ``keep`` column named like an
output is an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
EPOCHS = 6                    # price updates at most
GAP = 0.0005                  # distance from the volume bound at which prices are good enough
START = 1.2                   # starting price of a length: its share of a sequence to this power
TAILS = (0.01, 0.02, 0.05, 0.1)    # last shares of the tokens that are also tried best fit
RATE = 0.1                    # strength of a price update
SLOT_ROWS = 500_000           # rows of 48 bytes of a plan that are broadcast
BUCKET_ROWS = 200             # pieces of one length aimed at in one numbering bucket


OUTPUT = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# Tokens --------------------------------------------------------------------------

def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TokenIds:
    """Ids of a text as little-endian uint32 bytes.

    ``path`` names the public tokenizer (json).  Beside it lies the same
    vocabulary as ranks (same name, .tiktoken), whose library gives the same ids
    several times faster; texts that hold the end-of-text marker, which only the
    json makes a special token, and texts it refuses go to the json tokenizer."""

    def __init__(self, path: str):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.path, self._tokenizer = path, None
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def tokenizer(self):
        """The json tokenizer, made when a text needs it."""
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.exact(text)
        try:
            return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
        except BaseException as e:                         # noqa: B036  a panic of the Rust code is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                raise
            return self.exact(text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: one, or full ones after a first
    that may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, piece, start, length, ids_crc32 of every piece of every text."""
    kept = ["doc_id", *keep]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TokenIds(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = (ids_of(text.as_py()) if text.is_valid else b"") + end
                for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append(i)
                    number.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * s:4 * (s + n)]))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in kept), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[*kept, "piece", "start", "length", "ids_crc32"])

    return docs.select(*kept, "text").mapInArrow(
        run, f"{fields}, piece int, start long, length long, ids_crc32 long")


# The linear program ----------------------------------------------------------------

def _choices(lengths: list[int], prices: dict[int, float], capacity: int) -> list[int]:
    """The length to take first from every room, for the configuration of
    largest price (unbounded knapsack by dynamic programming); 0: leave one free."""
    worth = np.full(capacity + 1, -np.inf)
    worth[lengths] = [prices[n] for n in lengths]
    best = np.zeros(capacity + 1)
    choice = [0] * (capacity + 1)
    for c in range(lengths[0], capacity + 1):
        values = worth[1:c + 1] + best[c - 1::-1]
        k = int(values.argmax())
        best[c] = best[c - 1]
        if values[k] > best[c]:
            best[c], choice[c] = values[k], k + 1
    return choice


def _cover(counts: dict[int, int], prices: dict[int, float], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole uses of configurations that cover all counts at given prices.  One
    knapsack over the open lengths prices a best configuration around each of
    them; it is used until one of its lengths is covered.  Configurations that
    need more of a length than is left wait for the next knapsack; the first of
    each is always used, so all lengths get covered."""
    rest = dict(counts)
    uses = []
    while rest:
        choice = _choices(sorted(rest), prices, capacity)
        for i, seed in enumerate(sorted(rest, reverse=True)):
            config, room, whole = {seed: 1}, capacity - seed, seed in rest
            while whole and room > 0:
                n = choice[room]
                if n and config.get(n, 0) >= rest.get(n, 0):
                    whole = False
                elif n:
                    config[n] = config.get(n, 0) + 1
                room -= n or 1
            if not whole and i:
                continue
            if not whole:                                   # too few are left: fill up with what there is
                room = capacity - sum(n * k for n, k in config.items())
                for n in sorted(rest, reverse=True):
                    k = min(room // n, rest[n] - config.get(n, 0))
                    if k > 0:
                        config[n] = config.get(n, 0) + k
                        room -= k * n
            times = min(rest[n] // k for n, k in config.items())
            uses.append((config, times))
            for n, k in config.items():
                rest[n] -= k * times
                if not rest[n]:
                    del rest[n]
    return uses


_Plan = list[tuple[dict[int, int], int]]


def _with_tail(uses: _Plan, capacity: int) -> tuple[_Plan, float]:
    """The uses, their last ones packed best fit where that is shorter (the last
    lengths open match badly), and the share of the tokens in priced uses."""
    tokens = [times * sum(n * k for n, k in config.items()) for config, times in uses]
    total, upto = sum(tokens), np.cumsum(tokens)
    best, share = uses, 1.0
    for part in TAILS:
        cut_at = int(np.searchsorted(upto, (1 - part) * total))
        rest: dict[int, int] = {}
        for config, times in uses[cut_at:]:
            for n, k in config.items():
                rest[n] = rest.get(n, 0) + k * times
        plan = uses[:cut_at] + best_fit(rest, capacity)
        if sum(t for _, t in plan) < sum(t for _, t in best):
            best, share = plan, float(sum(tokens[:cut_at]) / total)
    return best, share


def _rounded(covers: list[_Plan], counts: dict[int, int], prices: dict[int, float], capacity: int) -> _Plan:
    """Whole uses that cover all counts: of the fractional solution (the average
    of the covers) the whole parts, then configurations at ``prices`` for what is
    left open."""
    total: dict[tuple, int] = {}                        # configuration -> times, over the covers
    for config, times in (use for cover in covers for use in cover):
        key = tuple(sorted(config.items()))
        total[key] = total.get(key, 0) + times
    whole = [(dict(config), times // len(covers)) for config, times in total.items() if times >= len(covers)]
    rest = dict(counts)
    for config, times in whole:
        for n, k in config.items():
            rest[n] -= k * times            # never under 0: every cover holds each length as often as it occurs
    return whole + _cover({n: c for n, c in rest.items() if c}, prices, capacity)


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = EPOCHS) -> tuple[_Plan, float]:
    """[(configuration, times)] that holds every length of the histogram as
    often as it occurs, and the share of the tokens (full pieces apart) in uses
    of priced configurations.  Prices start a little steeper than the length; after each
    round a length's price is multiplied towards the share of a sequence it came
    to cost, so lengths that end up in poorly filled sequences are placed
    earlier.  Prices are updated at least once, then until a rounding is within
    ``GAP`` of the volume bound, ``rounds`` times at most."""
    full: _Plan = []
    left = {int(n): int(c) for n, c in histogram.items() if c > 0}
    if left.get(capacity):
        full.append(({capacity: 1}, left.pop(capacity)))
    if not left:
        return full, 0.0
    bound = -(-sum(n * c for n, c in left.items()) // capacity)
    best, share = None, 0.0
    prices = {n: (n / capacity) ** START for n in left}
    covers: list[_Plan] = []
    for epoch in range(max(2, min(rounds, EPOCHS))):
        uses = _cover(left, prices, capacity)
        covers.append(uses)
        plan, of_plan = _with_tail(_rounded(covers[(epoch + 1) // 2:], left, prices, capacity), capacity)
        if best is None or (sum(n for _, n in plan), -of_plan) < (sum(n for _, n in best), -share):
            best, share = plan, of_plan
        if epoch and sum(n for _, n in best) <= bound * (1 + GAP):
            break
        cost = dict.fromkeys(left, 0.0)
        for config, times in uses:
            worth = sum(prices[n] * c for n, c in config.items())
            for n, c in config.items():
                cost[n] += times * c * prices[n] / worth
        prices = {n: p * (max(cost[n] / left[n], 1e-9) / p) ** RATE for n, p in prices.items()}
    return full + best, share


def configurations(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = EPOCHS) -> _Plan:
    """The plan of ``solve``; ``rounds`` bounds the price updates."""
    return solve(histogram, capacity, rounds)[0]


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, on a histogram: open sequences with equal
    contents are one group; a length fills the groups with least room first."""
    by_room: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]      # room -> contents -> sequences

    def put(room: int, contents: tuple, sequences: int) -> None:
        if sequences:
            by_room[room][contents] = by_room[room].get(contents, 0) + sequences

    for length in sorted(histogram, reverse=True):
        need = histogram[length]
        for room in range(length, capacity):
            if not need:
                break
            each = room // length
            for contents in list(by_room[room]):
                if not need:
                    break
                have = by_room[room].pop(contents)
                full = min(have, need // each)
                part = need - full * each if full < have else 0             # under ``each``: one sequence more
                put(room - each * length, contents + ((length, each),), full)
                if part:
                    put(room - part * length, contents + ((length, part),), 1)
                put(room, contents, have - full - (1 if part else 0))
                need -= full * each + part
        each = capacity // length
        put(capacity - each * length, ((length, each),), need // each)
        if need % each:
            put(capacity - need % each * length, ((length, need % each),), 1)
    return [(dict(g), n) for groups in by_room for g, n in groups.items()]


def slot_table(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, number per sequence, numbers, first sequence,
    offset) for every (configuration, length): pieces of that length with these
    numbers go to these sequences."""
    rows, sequence, used = [], 0, {}
    for config, times in plan:
        offset = 0
        for length, per in sorted(config.items(), reverse=True):
            first = used.get(length, 0)
            rows.append((length, first, per, per * times, sequence, offset))
            used[length] = first + per * times
            offset += length * per
        sequence += times
    return rows


# The operator ------------------------------------------------------------------------

def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         keep: tuple[str, ...] = ()) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    spark = docs.sparkSession
    if taken := set(keep) & set(OUTPUT):
        raise ValueError(f"keep: columns named like an output: {sorted(taken)}")
    cut_up = pieces(docs, path, capacity, end_id, keep)
    stored = scratch_table(spark, cut_up.withColumn("spread", F.xxhash64("doc_id", "piece", "ids_crc32")), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in                       # at most ``capacity`` rows
                 stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = configurations(histogram, capacity)
    table = slot_table(plan)
    slots = spark.createDataFrame(table, "slot_length long, first long, per long, numbers long, "
                                         "first_sequence long, slot_offset long")
    if len(table) <= SLOT_ROWS:                 # else by shuffle
        slots = F.broadcast(slots)
    # Number the pieces of one length: bucket counts, bucket offsets, then
    # numbers within a bucket.  A length gets buckets by its own count, so a
    # length that a third of all pieces share is spread like any other.
    buckets = spark.createDataFrame([(n, -(-c // BUCKET_ROWS)) for n, c in histogram.items()],
                                    "length long, buckets long")     # at most ``capacity`` rows
    placed = stored.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod("spread", F.col("buckets")))
    sizes = placed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = W.partitionBy("length", "bucket").orderBy("spread", "doc_id", "piece", "start")
    numbered = (placed.join(starts, ["length", "bucket"])
                .withColumn("number", F.col("before") + F.row_number().over(order) - 1))
    at = F.col("number") - F.col("first")
    return (numbered.join(slots, (F.col("length") == F.col("slot_length")) & (F.col("number") >= F.col("first"))
                          & (F.col("number") < F.col("first") + F.col("numbers")))
            .select("doc_id", *keep, "piece", "start", "length", "ids_crc32",
                    (F.col("first_sequence") + F.floor(at / F.col("per"))).cast("long").alias("sequence_id"),
                    (F.col("slot_offset") + at % F.col("per") * F.col("length")).cast("long").alias("offset")))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
