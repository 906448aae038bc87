"""Jaccard join of documents on word n-grams, by several global token orders.

A document is the set of its distinct 5-word shingles.  Under any total order
of all shingles, two sets with Jaccard similarity ``t`` or more must share a
shingle among the first ``n - ceil(t n) + 1`` of each (its prefix), and among a
prefix longer by ``c - 1`` they must share ``c``.  Candidates have to pass this
under different orders, intersected, before any pair is verified:

1. *Hash order.*  Prefixes longer by a tenth of the set are counted over the
   whole corpus: a document stays only if enough of its prefix shingles occur in
   the prefix of a different set.  Shingles travel in packed blocks, one block
   per batch of documents and range of hashes; a shingle common within a batch
   is sent once for the batch, so no key grows with its frequency.
2. *Copies.*  Equal sets are one class.  Classes that share the smallest shingle
   of a random order are compared with one leader each and linked if the pair
   verifies; the components found are then closed groups: only pairs between
   different components still matter.  A few orders fold large groups of near
   copies into single components with comparisons linear in their size.
3. *Whole sets*, counting only shingles shared with another component: a partner
   outside must share ``t n`` of them.
4. *Two rare-first orders* (document frequency, ties by two different hashes)
   give candidate pairs between components.  A parity bitmap per set, whose
   distance never exceeds the difference of the sets, drops pairs that cannot
   reach the threshold while they are joined, so a large family of texts that
   share much but not enough makes few rows; the intersection is verified.  A
   pass over some of the shingles closes most groups before the complete one.

Every pair that links two different components passes all filters, so the
components are exact; pairs inside a component are not enumerated.

Defined cases: null or wordless text has no shingles and links with nothing;
fewer than 5 words are one shingle of the whole sequence; rows with a null
doc_id get their n_shingles, link nothing and have a null component_id; rows
with a repeated doc_id are judged by their own text; an empty table gives an
empty result; extra columns pass through ``keep_one``.  A set is held whole in a
task, also that of a very long text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordcheck.llm import words as WD
from recordcheck.llm.columns import aside
from recordcheck.llm.graph import components
from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

WORDS = 5
THRESHOLD = 75                # percent
BATCH_TOKENS = 500_000        # shingles of one packed batch
DOCS_PER_PART = 20_000        # documents whose prefixes fill one range of hashes
PARITY_BITS = 2048            # bits of the bitmap that bounds the difference of two sets
ORDERS = 4                    # random orders that give leaders
FIRST_PASS = 8                # one in so many shingles is looked at before the complete pass
LEADER_ROWS = 128             # rows compared with a leader in one group
BROADCAST_ROWS = 100_000      # keys sent to every task instead of shuffling sets

_HASHER = WD.Hasher(5)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def shingles(raw: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    data, starts, ends = WD.spans(raw)
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    hashes = _HASHER.words(_LOWER[data], starts, ends)
    if n < WORDS:
        return _HASHER.windows(hashes, n) ^ np.uint64(n)
    return np.unique(_HASHER.windows(hashes, WORDS))


def set_key(tokens: np.ndarray) -> str:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest()


def owner_of(key: str) -> int:
    """60-bit id of a set inside packed blocks (never 0)."""
    return int(key[:15], 16) or 1


def overlap_needed(n: int) -> int:
    """Least overlap of a set of n with any set at the threshold."""
    return -(-THRESHOLD * n // 100)


def extra(n: int) -> int:
    """How many shared shingles the extended prefix is laid out for."""
    return max(1, n // 10)


def prefix_length(n: int) -> int:
    return n - overlap_needed(n) + extra(n)


def shared_needed(n: int) -> int:
    """Prefix shingles a set must share with a partner.  (With sizes m <= n,
    the shorter prefix holds at least extra(m) + overlap_needed(n) -
    overlap_needed(m) common ones, which is never under extra(n) - 1.)"""
    return max(1, extra(n) - 1)


# Packed blocks --------------------------------------------------------------------

# A block holds the shingles of one range of hashes from one batch: 48-bit
# shingles (a collision counts a shingle as shared, which only keeps more
# candidates), and runs of (owner, unit, length).
_BLOCK = "part int, tokens binary, owners binary, units binary, lengths binary, owner long, shared long, doc string"
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def _blocks(tokens: list[np.ndarray], owners: list[int], units: list[int], parts: int) -> tuple[list[tuple], dict[int, int]]:
    """Blocks (part, tokens, owners, units, lengths) of a batch and the shingles
    of each owner already known to be shared.  A shingle that two units of the
    batch hold is sent once, with owner and unit 0."""
    sizes = [len(t) for t in tokens]
    token = np.concatenate(tokens) >> np.uint64(16) if tokens else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.array(owners, dtype=np.int64), sizes)
    unit = np.repeat(np.array(units, dtype=np.int64), sizes)
    order = np.lexsort((unit, token))
    token, owner, unit = token[order], owner[order], unit[order]
    starts, lasts = _runs(token)
    several = unit[starts] != unit[lasts]
    known = np.repeat(several, lasts - starts + 1)
    who, times = np.unique(owner[known], return_counts=True)
    none = np.zeros(int(several.sum()), dtype=np.int64)
    token = np.concatenate((token[~known], token[starts][several]))
    owner = np.concatenate((owner[~known], none))
    unit = np.concatenate((unit[~known], none))
    part = ((token >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((owner, part))
    token, owner, unit, part = token[order], owner[order], unit[order], part[order]
    out = []
    for a, last in zip(*_runs(part)):
        b = last + 1
        at, ends = _runs(owner[a:b])
        out.append((int(part[a]), token[a:b].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), owner[a:b][at].tobytes(),
                    unit[a:b][at].tobytes(), (ends - at + 1).astype(np.uint32).tobytes()))
    return out, dict(zip(who.tolist(), times.tolist()))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of runs of equal values."""
    if not len(values):
        none = np.zeros(0, dtype=np.int64)
        return none, none
    cuts = np.flatnonzero(values[1:] != values[:-1])
    return np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(values) - 1]))


def _block_batch(blocks: list[tuple], local: dict[int, int], docs: list[str]) -> pa.RecordBatch:
    """Blocks, then known counts, then document rows (these two with negative
    parts, spread out: they only pass)."""
    n, m, d = len(blocks), len(local), len(docs)
    columns = [[b[0] for b in blocks] + [-1 - o % 100_003 for o in local] + [-1 - i for i in range(d)],
               *([b[i] for b in blocks] + [None] * (m + d) for i in (1, 2, 3, 4)),
               [None] * n + list(local) + [None] * d, [None] * n + list(local.values()) + [None] * d,
               [None] * (n + m) + docs]
    types = [pa.int32(), *[pa.binary()] * 4, pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def _count_part(held: list[tuple[bytes, bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Per owner, how many of its shingles of a part two units hold."""
    packed = np.frombuffer(b"".join(h[0] for h in held), dtype=np.uint8).reshape(-1, 6)
    token = np.zeros((len(packed), 8), dtype=np.uint8)
    token[:, :6] = packed
    token = token.view(np.uint64).ravel()
    owners, units, lengths = (np.frombuffer(b"".join(h[i] for h in held), dtype=t)
                              for i, t in ((1, np.int64), (2, np.int64), (3, np.uint32)))
    owner, unit = np.repeat(owners, lengths), np.repeat(units, lengths)
    order = np.lexsort((unit, token))
    token, owner, unit = token[order], owner[order], unit[order]
    starts, lasts = _runs(token)
    # unit 0 comes first: it stands for two units of some batch
    several = (unit[starts] != unit[lasts]) | (unit[starts] == 0)
    known = np.repeat(several, lasts - starts + 1) & (owner != 0)
    # one owner may come from several batches (copies): count a shingle once
    pair = np.unique(np.stack([token[known].astype(np.int64), owner[known]], axis=1), axis=0)
    return np.unique(pair[:, 1], return_counts=True)


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part -> (owner, shared) counts; other rows pass."""
    def out(held) -> pa.RecordBatch:
        who, times = _count_part(held)
        return pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(times, pa.int64()),
                                           pa.nulls(len(who), pa.string())], names=["owner", "shared", "doc"])

    part, held = None, []
    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        passing = batch.filter(pa.array(parts < 0))
        if passing.num_rows:
            yield pa.RecordBatch.from_arrays([passing.column(c) for c in ("owner", "shared", "doc")],
                                             names=["owner", "shared", "doc"])
        blobs = [batch.column(c) for c in _NAMES[1:5]]
        for i in np.flatnonzero(parts >= 0):
            if parts[i] != part:
                if held:
                    yield out(held)
                part, held = parts[i], []
            held.append(tuple(b[int(i)].as_py() for b in blobs))
    if held:
        yield out(held)


def _shared_counts(packed: DataFrame) -> DataFrame:
    """Packed blocks -> (owner, shared) partial counts and passed doc rows."""
    return (packed.repartition("part").sortWithinPartitions("part")
            .mapInArrow(_count_shared, "owner long, shared long, doc string"))


def _parts(spark: SparkSession, n_docs: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_docs // DOCS_PER_PART)


def _small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


# Stage 1: all documents -------------------------------------------------------------

def _prepare(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        tokens, owners, docs, size = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                t = shingles(text.as_buffer().to_pybytes()) if text.is_valid else np.zeros(0, dtype=np.uint64)
                key = set_key(t)
                least = ",".join(str(int(_leader_hash(t, r).min())) for r in range(ORDERS)) if len(t) else ""
                # the id comes last, as it is; "-" stands for none
                docs.append(f"{len(t)}|{key}|{least}|{'-' if doc_id is None else f'+{doc_id}'}")
                if len(t) and doc_id is not None and key not in seen:
                    seen.add(key)
                    tokens.append(t[:prefix_length(len(t))])
                    owners.append(owner_of(key))
                    size += len(tokens[-1])
                if size >= BATCH_TOKENS or len(docs) >= 20_000:
                    yield _block_batch(*_blocks(tokens, owners, owners, parts), docs)
                    seen, tokens, owners, docs, size = set(), [], [], [], 0
        if docs:
            yield _block_batch(*_blocks(tokens, owners, owners, parts), docs)
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, groups) whose text has that key -> its shingles."""
    for batch in batches:
        found = [shingles(text.as_buffer().to_pybytes()) for text in batch.column("text")]
        right = pa.array([set_key(t) == k for t, k in zip(found, batch.column("key").to_pylist())], pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").filter(right), pa.array([len(t) for t in found], pa.int64()).filter(right),
             pa.array([t.tobytes() for t in found], pa.binary()).filter(right), batch.column("groups").filter(right)],
            names=["key", "n", "tokens", "groups"])


def _leader_hash(tokens: np.ndarray, r: int) -> np.ndarray:
    return WD.mix(tokens ^ np.uint64(0x5851F42D4C957F2D * (r + 1) % 2 ** 64)).view(np.int64)


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are at the threshold."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < THRESHOLD * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= THRESHOLD * (len(a) + len(b) - common)


def _tokens(blob) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), dtype=np.uint64)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mask = pa.array([_similar(_tokens(x), _tokens(y)) for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b"))],
                        pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])


def _with_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, the leader first: links of the others to it."""
    group, leader, head = None, None, None
    for batch in batches:
        a, b = [], []
        for now, key, blob in zip(zip(*(batch.column(c).to_pylist() for c in ("round", "hash", "salt"))),
                                  batch.column("key").to_pylist(), batch.column("tokens")):
            if now != group:
                group, leader, head = now, np.array(_tokens(blob)), key
            elif key != head and _similar(leader, _tokens(blob)):
                a.append(key)
                b.append(head)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])


def _leader_groups(alive: DataFrame) -> DataFrame:
    """key -> groups: for every order in which others share its smallest shingle,
    (round, hash, salts, lead).  The leader of a group is the set that shares the
    largest part of its prefix (of copies with changes of their own, the one they
    were made from), then the smallest key; a large group is cut by salt and the
    leader goes to every cut."""
    n = F.col("n")
    prefix = n - F.ceil(n * F.lit(THRESHOLD / 100)) + F.greatest(F.lit(1), F.floor(n / 10))
    rows = alive.select("key", (-F.col("in_prefix") / prefix).alias("alone"), F.posexplode("minima").alias("round", "hash"))
    groups = rows.groupBy("round", "hash").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("alone", "key"))["key"].alias("leader")).filter("rows > 1")
    cuts = F.ceil(F.col("rows") / LEADER_ROWS).cast("int")
    lead = F.col("key") == F.col("leader")
    salts = F.when(lead, F.sequence(F.lit(0), cuts - 1)).otherwise(F.array(F.pmod(F.hash("key"), cuts)))
    return rows.join(groups, ["round", "hash"]).groupBy("key").agg(
        F.collect_list(F.struct("round", "hash", salts.alias("salts"), lead.alias("lead"))).alias("groups"))


def _star_links(sets: DataFrame) -> DataFrame:
    rows = (sets.select("key", "tokens", F.explode("groups").alias("g"))
            .select("key", "tokens", "g.round", "g.hash", "g.lead", F.explode("g.salts").alias("salt")))
    return (rows.repartition("round", "hash", "salt").sortWithinPartitions("round", "hash", "salt", F.desc("lead"), "key")
            .mapInArrow(_with_leader, "a string, b string"))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose sets are at the threshold."""
    near = ((100 * F.col("n_a") >= THRESHOLD * F.col("n_b")) & (100 * F.col("n_b") >= THRESHOLD * F.col("n_a")))
    a, b = (sets.select(F.col("key").alias(x), F.col("tokens").alias(f"tokens_{x}"), F.col("n").alias(f"n_{x}"))
            for x in ("a", "b"))
    return (pairs.join(a, "a").join(b, "b").filter(near).select("a", "b", "tokens_a", "tokens_b")
            .mapInArrow(_verified, "a string, b string"))


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (key, comp) after joining the components of linked keys."""
    spark = labels.sparkSession
    la, lb = (labels.select(F.col("key").alias(x), F.col("comp").alias(f"comp_{x}")) for x in ("a", "b"))
    between = links.join(la, "a").join(lb, "b").filter("comp_a <> comp_b").select(
        F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    between = scratch_table(spark, between.distinct(), "ngram-links")
    if not between.limit(1).count():
        return labels
    joined = components(between).withColumnRenamed("comp", "new")
    return scratch_table(spark, labels.join(joined, F.col("comp") == F.col("node"), "left").select(
        "key", F.coalesce("new", "comp").alias("comp")), "ngram-labels")


def _open_blocks(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, units, size = [], [], [], 0
        for batch in batches:
            for key, comp, blob in zip(*(batch.column(c).to_pylist() for c in ("key", "comp", "tokens"))):
                t = np.frombuffer(blob, dtype=np.uint64)
                tokens.append(t)
                owners.append(owner_of(key))
                units.append(owner_of(comp))
                size += len(tokens[-1])
                if size >= BATCH_TOKENS:
                    yield _block_batch(*_blocks(tokens, owners, units, parts), [])
                    tokens, owners, units, size = [], [], [], 0
        if tokens:
            yield _block_batch(*_blocks(tokens, owners, units, parts), [])
    return run


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of PARITY_BITS bits: every shingle flips one.  Two bitmaps differ in
    at most as many bits as the sets differ in shingles."""
    bit = (WD.mix(tokens ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(PARITY_BITS)).astype(np.int64)
    odd = np.bincount(bit, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, blob in zip(*(batch.column(c).to_pylist() for c in ("key", "tokens"))):
            t = np.frombuffer(blob, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(t), pa.string()), pa.array(t)], names=["key", "token"])


def _with_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [parity_bits(_tokens(t)).tolist() for t in batch.column("tokens")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "n")),
                                          pa.array(bits, pa.list_(pa.int64()))], names=["key", "n", "bits"])


def _prefix_table(open_sets: DataFrame) -> DataFrame:
    """key, n, bitmap and prefixes under two rare-first orders of the open sets."""
    spark = open_sets.sparkSession
    rows = scratch_table(spark, open_sets.mapInArrow(_token_rows, "key string, token long"), "ngram-open")
    ranked = rows.join(rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "token")
    def length(least: float):
        return F.size("all") - F.ceil(F.size("all") * F.lit(least)).cast("int") + 1

    def prefix(n, *order: str):
        """The first n shingles in an order; those of one document only pair with none."""
        first = F.slice(F.array_sort(F.transform("all", lambda x: F.struct(
            x["df"], *(F.xxhash64(x["token"]).alias("tie") for _ in order), x["token"]))), F.lit(1), n)
        return F.transform(F.filter(first, lambda x: x["df"] > 1), lambda x: x["token"])

    # Of a pair the larger set needs its prefix for overlap t n, the smaller one
    # only that for 2 t n / (1 + t), which is its least overlap with a larger set.
    t = THRESHOLD / 100
    small = 2 * t / (1 + t) - 1e-9
    prefixes = ranked.groupBy("key").agg(F.collect_list(F.struct("df", "token")).alias("all")).select(
        "key", prefix(length(t)).alias("one"), prefix(length(small)).alias("short"), prefix(length(t), "tie").alias("two"))
    sketch = open_sets.mapInArrow(_with_bits, "key string, n long, bits array<long>")
    return scratch_table(spark, sketch.join(prefixes, "key"), "ngram-prefixes")


def _rare_first_pairs(table: DataFrame, labels: DataFrame, every: int) -> DataFrame:
    """Candidate pairs (a, b) between components: they share a prefix shingle
    (one in ``every`` of them is looked at) under two rare-first orders, and their
    bitmaps allow the threshold."""
    table = table.join(_small(table.select("key").join(labels, "key")), "key")

    def side(which: str) -> DataFrame:
        return table.select(F.explode(which).alias("token"), "key", F.xxhash64("comp").alias("comp"), "n", "bits").filter(
            F.pmod("token", F.lit(every)) == 0)

    differ = " + ".join(f"bit_count(x.bits[{i}] ^ y.bits[{i}])" for i in range(PARITY_BITS // 64))
    # |A| + |B| bounds the difference of sets at the threshold t by (1 - t) / (1 + t).
    allowed = f"{100 + THRESHOLD} * ({differ}) <= {100 - THRESHOLD} * (x.n + y.n)"
    sizes = f"100 * y.n >= {THRESHOLD} * x.n AND (x.n > y.n OR (x.n = y.n AND x.key > y.key))"
    pairs = (side("one").alias("x").join(side("short").alias("y"), F.expr(
        f"x.token = y.token AND x.comp <> y.comp AND {sizes} AND {allowed}"))
        .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct())
    a, b = (table.select(F.col("key").alias(k), F.col("two").alias(f"two_{k}")) for k in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").filter(F.arrays_overlap("two_a", "two_b")).select("a", "b")


def join_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text)."""
    return _members(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _members(docs: DataFrame) -> DataFrame:
    """doc_id, n, key (of the set), comp (null without shingles or id),
    component_id of every row of docs."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    docs = docs.select("doc_id", "text")
    parts = _parts(spark, docs.count())
    first = scratch_table(spark, _shared_counts(docs.mapInArrow(_prepare(parts), _BLOCK)), "ngram-first")
    fields = F.split("doc", r"\|", 4)
    minima = F.when(fields[2] != "", F.split(fields[2], ",").cast("array<long>"))
    rows = first.filter(F.col("doc").isNotNull()).select(
        F.when(fields[3] != "-", F.substring(fields[3], 2, 2 ** 31 - 1)).cast(kind).alias("doc_id"),
        fields[0].cast("long").alias("n"), fields[1].alias("key"), minima.alias("minima"))
    classes = scratch_table(spark, rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("minima").alias("minima")), "ngram-classes")
    counts = first.filter(F.col("owner").isNotNull()).groupBy("owner").agg(F.sum("shared").alias("shared"))

    bits = F.conv(F.substring("key", 1, 15), 16, 10).cast("long")
    owner = F.when(bits == 0, F.lit(1)).otherwise(bits)
    enough = F.greatest(F.lit(1), F.greatest(F.lit(1), F.floor(F.col("n") / 10)) - 1)
    alive = scratch_table(spark, classes.withColumn("owner", owner).join(counts, "owner")
                          .filter(F.col("shared") >= enough).select("key", "least", "n", "minima", "owner", F.col("shared").alias("in_prefix")), "ngram-alive")
    wanted = alive.select("key", "least").join(_leader_groups(alive), "key", "left")
    wanted = scratch_table(spark, wanted, "ngram-wanted")
    texts = docs.join(_small(wanted), F.col("doc_id") == F.col("least")).select("key", "text", "groups")
    sets = scratch_table(spark, texts.mapInArrow(
        _sets, "key string, n long, tokens binary, "
        "groups array<struct<round:int,hash:bigint,salts:array<int>,lead:boolean>>"), "ngram-sets")

    labels = scratch_table(spark, alive.select("key", F.col("key").alias("comp")), "ngram-labels")
    labels = _merge(labels, _star_links(sets))

    moved = _small(labels.filter("key <> comp"))
    packed = sets.join(moved, "key", "left").select("key", F.coalesce("comp", "key").alias("comp"), "tokens").mapInArrow(
        _open_blocks(parts), _BLOCK)
    again = _shared_counts(packed).groupBy("owner").agg(F.sum("shared").alias("shared"))
    needed = F.ceil(F.col("n") * THRESHOLD / 100)
    open_keys = scratch_table(spark, alive.join(again, "owner").filter(F.col("shared") >= needed).select("key")
                              .join(labels, "key"), "ngram-open-keys")
    open_sets = scratch_table(spark, sets.join(_small(open_keys), "key").select("key", "comp", "n", "tokens")
                              .dropDuplicates(["key"]), "ngram-open-sets")
    # A few of the shingles first: pairs they link are closed groups afterwards,
    # so the complete pass meets fewer pairs between components.
    table = _prefix_table(open_sets)
    for every in (FIRST_PASS, 1):
        labels = _merge(labels, verify(_rare_first_pairs(table, labels, every), open_sets))

    groups = classes.join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    least = groups.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_key = groups.join(least, "comp").select(F.col("key").alias("c_key"), "comp", "component_id")
    member = (F.col("key") == F.col("c_key")) & F.col("doc_id").isNotNull()
    return (rows.join(of_key, member, "left")
            .select("doc_id", "n", "key", "comp", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def _own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [set_key(shingles(t.as_buffer().to_pybytes()) if t.is_valid else np.zeros(0, dtype=np.uint64)) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.string())], names=[*batch.schema.names, "key"])


def keep_one(docs: DataFrame) -> DataFrame:
    """Of every component the rows of ``docs`` with its smallest doc_id; of several
    such rows the one with the smallest set key and text.  Rows that link with
    nothing stay even if other rows have their doc_id (equal ones once); rows
    with a null doc_id all stay."""
    spark = docs.sparkSession
    inner, carried, restore = aside(docs, "doc_id", "text")
    members = scratch_table(spark, _members(inner).filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("m_id"), "key", F.coalesce("comp", "key").alias("comp"), (F.col("doc_id") == F.col("component_id")).alias("head")),
        "ngram-members")
    ids = members.groupBy("m_id").agg(F.count(F.lit(1)).alias("times"), F.max("head").alias("head")).filter("head")
    once = ids.filter("times = 1").select("m_id")
    kept = inner.join(once, F.col("doc_id") == F.col("m_id"), "left_semi").select(*carried)
    # Rows that share their doc_id are told apart by their own sets.
    several = ids.filter("times > 1").select("m_id")
    heads = (members.filter("head").join(several, "m_id", "left_semi").groupBy("m_id", "comp").agg(F.min("key").alias("h_key"))
             .select(F.col("m_id").alias("h_id"), "h_key"))
    fields = [f for f in inner.schema.fields]
    rows = inner.join(several, F.col("doc_id") == F.col("m_id"), "left_semi").mapInArrow(
        _own_keys, T.StructType([*fields, T.StructField("key", T.StringType())]))
    rows = rows.join(heads, (F.col("doc_id") == F.col("h_id")) & (F.col("key") == F.col("h_key")))
    order = W.partitionBy("doc_id", "key").orderBy("text")
    again = rows.withColumn("_place", F.row_number().over(order)).filter("_place = 1").select(*carried)
    return restore(kept.unionByName(again).unionByName(inner.filter(F.col("doc_id").isNull()).select(*carried)))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_shingles, component_id."""
    return join_components(read_table(spark, sf_dir, "documents"))
