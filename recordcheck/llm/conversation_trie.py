"""Prefix trie of conversations by ternary search trees per range shard.

A node is a sequence of first turns that some conversation starts with; what
conversations share need be computed (or stored) only once.

1. A turn is the 128-bit digest of role and text (texts never travel); a
   conversation is the row of its turns' digests, 20 bytes a turn.  Equal
   conversations are folded to one sequence with its members, and the digest of
   their ids is taken over id ranges, in id order, one block of ids a row.
2. Sequences are dealt in ranges of their first ``KEY`` turns to shards of about
   ``SHARD``.  A shard numbers its turns by a dictionary of its own, in order, and
   puts its sequences into a ternary search tree, the median first, so that every
   level's tree of siblings is balanced.  One walk over the tree (a stack, no
   recursion) lists the nodes, and backwards along it members, leaves and savings
   add up.
3. Only nodes on a shard's first and last sequence can be in other shards too
   (and what lies below them, if they share ``KEY`` turns).  These boundary nodes
   are added up over shards, then along their paths, one first turn at a time.
   All other nodes are final in their shard.

Defined cases: rows without conv_id belong to no conversation; null roles and
texts are empty; turns of one number stand in the order of their digests (nulls
first); a repeated row is a turn of its own; a turnless sequence is a member of
the root alone; an empty table gives no node; other columns are not read.  A
conversation is one row of digests however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

KEY = 24                      # turns that decide the range
SHARD = 20_000                # sequences of a shard
IDS = 4_000                   # ids in one row of a list of members
SHARED_EVERY = 20             # the query's conversations start like every 20th

_TURN = 16                    # bytes of a digest
_NONE = hashlib.sha256(b"").hexdigest()
_NODE = ("shard binary, boundary boolean, path binary, parent binary, branch binary, depth long, conv_id long, "
         "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends string")


# Sequences --------------------------------------------------------------------------

def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, turns (array of digest and number of words) in order of ``turn``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "words"))).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["key"].alias("key"), x["words"].alias("words"))).alias("turns"))


def shared_starts(found: DataFrame, every: int = SHARED_EVERY) -> DataFrame:
    """conv_id, turns: a conversation c starts with the first h turns of c - c % every
    and goes on with its own turns after its first h; h = crc32(c) % 4."""
    conv, h = F.col("conv_id"), F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)).cast("int")
    heads = found.filter(conv % every == 0).select(conv.alias("base"), F.slice("turns", 1, 3).alias("head"))
    rows = found.select("conv_id", "turns", h.alias("h"), (conv - conv % every).alias("base")).join(heads, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return rows.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(
        F.concat(F.slice("head", F.lit(1), F.col("h")), own)).alias("turns"))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by sequence and conv_id: blocks of members as text."""
    for batch in batches:
        keys = batch.column("id").to_pylist()
        ids = batch.column("conv_id").to_numpy()
        change = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        cuts = [(a, min(a + IDS, b)) for x, b in zip(change, change[1:]) for a in range(x, b, IDS)] if keys else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[a] for a, _ in cuts], pa.binary()), pa.array([int(ids[a]) for a, _ in cuts], pa.int64()),
             pa.array([b - a for a, b in cuts], pa.int64()),
             pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in cuts], pa.string())], names=["id", "least", "n", "members"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted by sequence and first member: one digest per sequence,
    however many blocks pass."""
    key, least, n, sha = None, 0, 0, hashlib.sha256()
    for batch in batches:
        out = []
        for k, first, count, members in zip(*[batch.column(c).to_pylist() for c in ("id", "least", "n", "members")]):
            if k != key:
                if key is not None:
                    out.append((key, least, n, sha.hexdigest()))
                key, least, n, sha = k, first, 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(members.encode())
            n += count
        if out:
            yield _records(out)
    if key is not None:
        yield _records([(key, least, n, sha.hexdigest())])


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
                                      names=["id", "least", "n", "ends"])


def _folded(found: DataFrame) -> DataFrame:
    """id, path, words, least, n, ends: one row per distinct sequence."""
    spark = found.sparkSession
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    members = scratch_table(spark, found.select(
        "conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")).withColumn(
            "id", F.unhex(F.md5("path"))), "trie-members")
    digests = (members.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
               .mapInArrow(_listed, "id binary, least long, n long, members string")
               .repartition("id").sortWithinPartitions("id", "least")
               .mapInArrow(_digested, "id binary, least long, n long, ends string"))
    distinct = members.groupBy("id").agg(F.any_value("path").alias("path"), F.any_value("words").alias("words"))
    return scratch_table(spark, distinct.join(digests, "id"), "trie-sequences")


# Ternary search tree -----------------------------------------------------------------

class TernaryTree:
    """Sequences of small integers.  Node 0 is the empty sequence; every other node
    is one more token: ``less`` and ``more`` lead to siblings, ``down`` to its
    children's tree."""

    def __init__(self):
        self.token, self.less, self.more, self.down = [-1], [0], [0], [0]
        self.parent, self.depth, self.first = [0], [0], [0]

    def _new(self, token: int, parent: int, depth: int, sequence: int) -> int:
        for column, value in ((self.token, token), (self.less, 0), (self.more, 0), (self.down, 0), (self.parent, parent),
                              (self.depth, depth), (self.first, sequence)):
            column.append(value)
        return len(self.token) - 1

    def insert(self, tokens: list[int], sequence: int) -> list[int]:
        """The nodes of a sequence's prefixes, new ones where they are missing."""
        nodes, at = [0], 0
        for depth, token in enumerate(tokens, 1):
            here = self.down[at]
            if not here:
                here = self.down[at] = self._new(token, at, depth, sequence)
            while self.token[here] != token:
                side = self.less if token < self.token[here] else self.more
                if not side[here]:
                    side[here] = self._new(token, at, depth, sequence)
                here = side[here]
            at = here
            nodes.append(at)
        return nodes

    def walk(self) -> list[int]:
        """All nodes, parents before children."""
        order, stack = [0], [self.down[0]] if self.down[0] else []
        while stack:
            node = stack.pop()
            order.append(node)
            stack += [x for x in (self.more[node], self.less[node], self.down[node]) if x]
        return order


def median_order(n: int) -> list[int]:
    """0 .. n - 1, the middle of every range before its halves."""
    out, stack = [], [(0, n)]
    while stack:
        low, high = stack.pop()
        if low < high:
            middle = (low + high) // 2
            out.append(middle)
            stack += [(middle + 1, high), (low, middle)]
    return out


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard; its sequences come in order of their path."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    paths = table.column("path").to_pylist()
    lengths = np.array([len(p) // _TURN for p in paths])
    data = np.frombuffer(b"".join(paths), dtype=np.uint8).reshape(-1, _TURN)
    # Bytes as two big-endian numbers sort like the bytes.
    halves = np.ascontiguousarray(data).view(">u8").astype(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (halves[order][1:] != halves[order][:-1]).any(axis=1)
    numbers = np.empty(len(order), dtype=np.int64)
    numbers[order] = np.cumsum(new) - 1
    begins = np.concatenate(([0], np.cumsum(lengths))).tolist()
    words, least, n, ends = (table.column(c).to_pylist() for c in ("words", "least", "n", "ends"))

    tree, last_node, nodes_of = TernaryTree(), {}, {}
    for i in median_order(len(paths)):
        nodes = tree.insert(numbers[begins[i]:begins[i + 1]].tolist(), i)
        last_node[nodes[-1]] = i
        if i in (0, len(paths) - 1):
            nodes_of[i] = nodes
    walk, size = tree.walk(), len(tree.token)
    boundary = [False] * size
    boundary[0] = True
    for i in {0, len(paths) - 1}:
        for node in nodes_of[i][:KEY + 1]:
            boundary[node] = True
    digest: dict[int, bytes] = {0: b""}
    branch: dict[int, bytes | None] = {0: None}
    for node in walk[1:]:
        up, depth = tree.parent[node], tree.depth[node]
        boundary[node] = boundary[node] or (depth > KEY and boundary[up])
        if boundary[node]:
            at = begins[tree.first[node]] + depth - 1
            digest[node] = hashlib.md5(digest[up] + data[at].tobytes()).digest()
            branch[node] = digest[node] if depth == 1 else branch[up]
    count, smallest = [0] * size, [None] * size
    children, leaves, saved, last_words = [0] * size, [0] * size, [0] * size, [0] * size
    for node, i in last_node.items():
        count[node], smallest[node] = n[i], least[i]
    for node in reversed(walk):
        up, depth = tree.parent[node], tree.depth[node]
        last_words[node] = words[tree.first[node]][depth - 1] if depth else 0
        if not boundary[node]:
            leaves[node] = leaves[node] if children[node] else 1
            saved[node] += (count[node] - 1) * last_words[node]
        if node:
            count[up] += count[node]
            smallest[up] = smallest[node] if smallest[up] is None else min(smallest[up], smallest[node])
            if not boundary[node]:
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
    shard = table.column("id")[0].as_py()
    for a in range(0, size, 10_000):
        some = walk[a:a + 10_000]
        columns = [[shard] * len(some), [boundary[x] for x in some], [digest.get(x) for x in some],
                   [digest[tree.parent[x]] if x and boundary[tree.parent[x]] else None for x in some], [branch.get(x) for x in some],
                   [tree.depth[x] for x in some], [smallest[x] for x in some],
                   [smallest[tree.parent[x]] if x and not boundary[tree.parent[x]] else None for x in some],
                   *[[c[x] for x in some] for c in (count, children, leaves, saved, last_words)],
                   [ends[last_node[x]] if x in last_node else None for x in some]]
        kinds = [pa.binary(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=[x.split()[0] for x in _NODE.split(", ")])


# Boundary nodes ------------------------------------------------------------------------

def _rolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged boundary nodes come sorted by first turn, deepest first: each gets
    what the boundary nodes below it add, held only until their parent passes."""
    held: dict[bytes, list[int]] = {}
    names = ["path", "parent", "branch", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        for i in range(batch.num_rows):
            below = held.pop(columns["path"][i], (0, 0, 0))
            children = columns["n_children"][i] + below[0]
            leaves = columns["n_leaves"][i] + below[1] if children else 1
            saved = columns["saved_tokens"][i] + below[2] + (columns["n_convs"][i] - 1) * columns["words"][i]
            columns["n_children"][i], columns["n_leaves"][i], columns["saved_tokens"][i] = children, leaves, saved
            if columns["depth"][i] > 1:
                up = held.setdefault(columns["parent"][i], [0, 0, 0])
                up[0] += 1
                up[1] += leaves
                up[2] += saved
        yield pa.RecordBatch.from_arrays([pa.array(columns[c], batch.schema.field(c).type) for c in names], names=names)


def prefix_trie(found: DataFrame) -> DataFrame:
    """Of conv_id, turns (array of digest and number of words): one row per node."""
    spark = found.sparkSession
    folded = _folded(found)
    shards = max(1, -(-folded.count() // SHARD))
    key = F.substring("path", 1, KEY * _TURN)
    nodes = scratch_table(spark, folded.withColumn("key", key).repartitionByRange(shards, "key", "id").sortWithinPartitions("path")
                          .drop("key").mapInArrow(_grown, _NODE), "trie-nodes")
    edge = nodes.filter("boundary")
    merged = scratch_table(spark, edge.groupBy("path").agg(
        F.min("parent").alias("parent"), F.min("branch").alias("branch"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("words").alias("words"),
        F.max("ends").alias("ends")), "trie-boundary")
    rolled = scratch_table(spark, merged.filter("depth > 0").repartition("branch").sortWithinPartitions("branch", F.desc("depth"))
                           .mapInArrow(_rolled, "path binary, parent binary, branch binary, depth long, conv_id long, n_convs long, "
                                       "n_children long, n_leaves long, saved_tokens long, ends string"), "trie-rolled")

    # The root: what final nodes below it add in every shard, and boundary nodes.
    parts = merged.filter("depth = 0").select("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends").unionByName(
        rolled.filter("depth = 1").select(F.lit(None).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("n_convs"),
                                          F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                                          F.lit(None).cast("string").alias("ends")))
    root = parts.agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
                     F.max("ends").alias("ends")).filter("conv_id IS NOT NULL")
    root = root.withColumn("n_leaves", F.greatest("n_leaves", F.lit(1))).withColumn("depth", F.lit(0).cast("long")).withColumn(
        "parent_conv_id", F.lit(None).cast("long"))

    up = merged.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shared = rolled.join(up, "parent")
    # Per shard, so that the children of the root do not meet in one task.
    ups = edge.select("shard", F.col("path").alias("parent")).join(up, "parent")
    inner = nodes.filter("NOT boundary")
    below = inner.filter("parent IS NOT NULL").drop("parent_conv_id").join(ups, ["shard", "parent"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               F.coalesce("ends", F.lit(_NONE)).alias("ends_sha256")]
    parts = [x.select(*columns) for x in (root, shared, below, inner.filter("parent IS NULL"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the rebuilt conversations."""
    return prefix_trie(shared_starts(sequences(read_table(spark, sf_dir, "conversations"))))


ORACLE = """
WITH own AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
counted AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda x: ascii(x)::BIGINT)), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, z: xor(c >> 1, 3988292384::BIGINT * (c & 1)))), 4294967295::BIGINT) % 4 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM counted c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
member AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
node AS (
  SELECT list_slice(turns, 1, depth) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE
           len(list_filter(regexp_split_to_array(any_value(turns[depth][2]), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) END AS saved
  FROM member GROUP BY 1, 2),
child AS (
  SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
flagged AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM node n LEFT JOIN child c ON c.path = n.path),
above AS (
  SELECT list_slice(path, 1, up) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM flagged) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, a.n_leaves,
       CAST(a.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM flagged f JOIN above a ON a.path = f.path
LEFT JOIN node p ON f.depth > 0 AND p.path = list_slice(f.path, 1, f.depth - 1)
"""
