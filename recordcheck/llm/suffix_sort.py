"""Repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes if a ``WINDOW``-byte string over it also starts earlier (in a document
with a smaller doc_id, or earlier in the same one).  To find such strings,
suffixes are put in order by their first ``WINDOW`` bytes only, digit by digit
from the most significant one; a group that holds one document is never looked
at again, and what is equal after the last digit is a repeated window.

* First digit: ``ANCHOR`` bytes at a place that the window's own content chooses
  (the smallest hash among its ``ANCHOR``-byte pieces), so equal windows meet
  under one anchor and one place in about 35 bytes stands for all windows that
  hang on it.  One shuffle brings the occurrences of an anchor together.  An
  anchor of one document is done.  Of occurrences whose whole surroundings
  (every byte of every window on them) are equal, all but the smallest doc_id
  lose all these windows at once; the smallest one goes on if its anchor has
  other surroundings too.
* Further digits: the surroundings of one anchor are sorted by their bytes to the
  right and, read backwards, to the left, eight bytes a pass, most significant
  first, until every group is single or the depth is reached.  Two windows at
  the same distance from the anchor are equal if both of their parts are.
* An anchor with more than ``GROUP`` different surroundings (the edge of a line
  that very many documents share) is not sorted in one task: its windows are
  spread by their whole content and counted with partial aggregation.

Repeats inside a document are sorted in the same way when it is read.  Anchors
that a sample of ``SAMPLE`` documents shows to be frequent are salted; this
changes where rows are processed and nothing else.  Texts travel twice, packed:
all of them to their marks, then those with undecided windows to the outcome.

Defined cases: a null text is empty; texts shorter than ``WINDOW`` keep
everything; a null doc_id has no order, so such rows only lose what repeats
inside them; rows with one doc_id do not remove each other's bytes; a copy of an
earlier text loses every byte (if it has ``WINDOW``); very long texts are read
in blocks; an empty table gives an empty result; other columns are not read.
doc_id is an integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordcheck.llm import words as WD
from recordcheck.llm.skew import join_counted
from recordcheck.sources.storage import scratch_path
from recordcheck.sources.tables import read_table

WINDOW = 100                  # bytes of a string that is removed
ANCHOR = 32                   # bytes of the first digit
SIDE = WINDOW - ANCHOR        # most bytes of a window on one side of its anchor
BLOCK = 1 << 18               # bytes looked at at once (a place in them has 20 bits)
PORTION = 2 << 20             # bytes of the texts a task holds at once, or one text
GROUP = 4_000                 # surroundings of an anchor that one task sorts
OPEN = 400_000                # occurrences of an anchor that are held before they are judged
SAMPLE = 4_000                # documents that show which anchors are frequent
SHARE = 0.01                  # of these documents: from here on an anchor is salted
SALTS = 64

_PIECE, _AROUND, _OTHER = WD.Hasher(31), WD.Hasher(37), WD.Hasher(41)
_U = np.uint64
_PLACE = _U((1 << 20) - 1)
_WHOLE, _CHECK, _FREQUENT = 0, 1, 2


# Anchors ------------------------------------------------------------------------

def _sums(data: np.ndarray, hasher: WD.Hasher) -> tuple[np.ndarray, np.ndarray]:
    up, down = hasher._powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(hasher.codes[data] * up[:-1], out=sums[1:])
    return sums, down


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts that follow each other in ``data`` and end at ``ends``: (place of
    the anchor, first and last window on it, anchor, surroundings), the last two
    as hashes, in order of place."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < WINDOW:
        return none, none, none, none.astype(_U), none.astype(_U)
    sums, down = _sums(data, _PIECE)
    n = len(data) - ANCHOR + 1
    pieces = WD.mix((sums[ANCHOR:] - sums[:n]) * down[:n])
    # Per window the smallest hash (its upper 44 bits, then the first place).
    chosen = (pieces & ~_PLACE) | np.arange(n, dtype=_U)
    size = 1
    while size <= SIDE:
        step = min(size, SIDE + 1 - size)
        chosen = np.minimum(chosen[:-step], chosen[step:])
        size += step
    chosen = (chosen & _PLACE).astype(np.int64)
    whole = np.ones(len(chosen), dtype=bool)
    for end in ends[:-1].tolist():
        whole[max(0, end - WINDOW + 1):end] = False
    start = np.flatnonzero(whole)
    if not len(start):
        return none, none, none, none.astype(_U), none.astype(_U)
    chosen = chosen[start]
    head = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    place, first = chosen[head], start[head]
    last = start[np.concatenate((head[1:], [len(start)])) - 1]
    sums, down = _sums(data, _AROUND)
    around = WD.mix((sums[last + WINDOW] - sums[first]) * down[first]
                    + (place - first).astype(_U) * _U(0x9E3779B97F4A7C15))
    anchor = pieces[place]
    return place, first, last, anchor, WD.mix(anchor * _U(0xBF58476D1CE4E5B9) + around)


def _raw(value) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _places(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``anchors`` of many texts, preceded by the number of the text, in order of
    (text, place); several short texts or one stretch of a long one at a time."""
    found: list[tuple[np.ndarray, ...]] = []

    def take(part: list[tuple[int, int, bytes]]) -> None:
        ends = np.cumsum([len(p[2]) for p in part])
        place, first, last, anchor, around = anchors(np.frombuffer(b"".join(p[2] for p in part), dtype=np.uint8), ends)
        own = np.searchsorted(ends, place, side="right")
        shift = (np.array([p[1] for p in part]) - np.concatenate(([0], ends[:-1])))[own]
        found.append((np.array([p[0] for p in part])[own], place + shift, first + shift, last + shift, anchor, around))

    part, size = [], 0
    for i, text in enumerate(texts):
        # Windows of a long text: every start lies in one stretch.
        for at in range(0, len(text) - WINDOW + 1, BLOCK):
            piece = text[at:at + BLOCK + WINDOW - 1]
            if part and size + len(piece) > BLOCK:
                take(part)
                part, size = [], 0
            part.append((i, at, piece))
            size += len(piece)
    if part:
        take(part)
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none.astype(_U), none.astype(_U)
    return tuple(np.concatenate(x) for x in zip(*found))


def _portions(batches: Iterator[pa.RecordBatch], size) -> Iterator[pa.RecordBatch]:
    """The same rows, ``PORTION`` bytes at a time; ``size``: bytes of the rows of a batch."""
    for batch in batches:
        ends = np.cumsum(size(batch))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + PORTION, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _text_bytes(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)


def _packed_bytes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("size").to_numpy(zero_copy_only=False)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """anchor, surroundings and doc_id, each once per document and portion."""
    for batch in _portions(batches, _text_bytes):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        text_no, _, _, _, anchor, around = _places([_raw(t) for t in batch.column("text")])
        doc = ids[text_no].astype(np.int64)
        order = np.lexsort((around, doc))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (around[order][1:] != around[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        keep = order[new]
        yield pa.RecordBatch.from_arrays([pa.array(x[keep].view(np.int64)) for x in (anchor, around, doc)],
                                         names=["anchor", "around", "doc_id"])


# First digit ---------------------------------------------------------------------

def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor, salt, surroundings, doc_id.  Gives the
    occurrences that lose all their windows (a smaller doc_id has the same
    surroundings), and the first ones of all surroundings of an anchor that
    several have, to be checked or, of a salted part, compared over the salts."""
    def judge(t: pa.Table, cut: bool, goes_on: bool):
        anchor, salt, around, doc = (t.column(c).to_numpy() for c in ("anchor", "salt", "around", "doc_id"))
        group = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])))
        kind = group | np.concatenate(([True], around[1:] != around[:-1]))
        at = np.flatnonzero(group)
        of = np.cumsum(group) - 1
        first = doc[np.maximum.accumulate(np.where(kind, np.arange(len(doc)), 0))]
        several = (np.add.reduceat(kind.astype(np.int64), at) > 1) & (np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at))
        # A group that is judged in parts: all its first ones are checked.
        several[0] |= cut
        several[-1] |= goes_on
        code = np.where(doc > first, _WHOLE, np.where(kind & (salt >= 0), _FREQUENT, np.where(kind & several[of], _CHECK, -1)))
        keep = np.flatnonzero(code >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[keep]), pa.array(anchor[keep]), pa.array(around[keep]), pa.array(code[keep].astype(np.int8))],
            names=["doc_id", "anchor", "around", "kind"])

    held, cut = None, False
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        if held.num_rows == 0:
            continue
        anchor, salt = held.column("anchor").to_numpy(), held.column("salt").to_numpy()
        same = (anchor == anchor[-1]) & (salt == salt[-1])
        done = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if done:
            yield judge(held.slice(0, done), cut, False)
            held, cut = held.slice(done), False
        if held.num_rows > OPEN:
            yield judge(held, cut, True)
            held, cut = None, True
    if held is not None and held.num_rows:
        yield judge(held, cut, False)


def _frequent(docs: DataFrame) -> DataFrame | None:
    """Anchors of a sample that many of its documents have (None: not one).  At
    most (anchors of SAMPLE documents) / (SAMPLE * SHARE) of them."""
    n = docs.count()
    if not n:
        return None
    few = docs.sample(min(1.0, SAMPLE / n), seed=11).mapInArrow(_occurrences, "anchor long, around long, doc_id long")
    least = max(20, int(SAMPLE * SHARE))
    keys = [r["anchor"] for r in few.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
            .select("anchor").collect()]
    return docs.sparkSession.createDataFrame([(k,) for k in keys], "f_anchor long") if keys else None


def _marks(docs: DataFrame) -> DataFrame:
    """doc_id, whole, check: surroundings in it that go as a whole or are checked."""
    rows = docs.mapInArrow(_occurrences, "anchor long, around long, doc_id long")
    frequent = _frequent(docs)
    salt = F.lit(-1)
    if frequent is not None:
        rows = rows.join(F.broadcast(frequent), F.col("anchor") == F.col("f_anchor"), "left")
        salt = F.when(F.col("f_anchor").isNull(), -1).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    judged = (rows.select("anchor", salt.cast("int").alias("salt"), "around", "doc_id").repartition("anchor", "salt")
              .sortWithinPartitions("anchor", "salt", "around", "doc_id")
              .mapInArrow(_judged, "doc_id long, anchor long, around long, kind byte"))
    if frequent is not None:
        judged = _stored(judged, "suffix-judged")
        salted = judged.filter(F.col("kind") == _FREQUENT)
        # At most SALTS rows of one key.
        least = salted.groupBy("anchor", "around").agg(F.min("doc_id").alias("least"))
        salted = salted.join(least, ["anchor", "around"]).select(
            "doc_id", "around", F.when(F.col("doc_id") > F.col("least"), _WHOLE).otherwise(_CHECK).alias("kind"))
        judged = judged.filter(F.col("kind") != _FREQUENT).select("doc_id", "around", F.col("kind").cast("int").alias("kind")).unionByName(salted)
    return judged.groupBy(F.col("doc_id").alias("m_doc")).agg(
        F.collect_list(F.when(F.col("kind") == _WHOLE, F.col("around"))).alias("whole"),
        F.collect_list(F.when(F.col("kind") == _CHECK, F.col("around"))).alias("check"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Further digits -------------------------------------------------------------------

def _strings(parts: list[bytes], width: int) -> np.ndarray:
    """One row of ``width`` bytes each, zeros behind short ones."""
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8).reshape(len(parts), width)


def radix_order(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows sorted by group and string, and how many leading
    bytes a row shares with the one before it (-1: another group).  Most
    significant digit first, eight bytes a pass; only rows that still share
    everything with another row take part in the next pass."""
    n, width = strings.shape
    digits = np.ascontiguousarray(strings).view(">u8").astype(_U)
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    label = np.maximum.accumulate(np.where(np.concatenate(([True], sorted_group[1:] != sorted_group[:-1])), np.arange(n), 0))
    left = np.arange(n)
    for d in range(digits.shape[1]):
        labels = label[left]
        twin = np.concatenate((labels[1:] == labels[:-1], [False]))
        left = left[twin | np.concatenate(([False], twin[:-1]))]
        if not len(left):
            break
        labels, rows = label[left], order[left]
        digit = digits[rows, d]
        by = np.lexsort((digit, labels))
        order[left] = rows[by]
        digit = digit[by]
        new = np.concatenate(([True], (labels[1:] != labels[:-1]) | (digit[1:] != digit[:-1])))
        label[left] = left[np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))]
    lined = strings[order]
    differ = lined[1:] != lined[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.where(group[order][1:] != group[order][:-1], -1, common)
    return order, np.concatenate(([-1], common))


def later(group: np.ndarray, rank: np.ndarray, low: np.ndarray, high: np.ndarray,
          before: list[bytes], behind: list[bytes]) -> np.ndarray:
    """Surroundings of anchors (``group``) with ``low`` to ``high`` bytes of a window
    before the anchor: (rows, SIDE + 1) whether the window with d bytes before it
    is also one of a row of the group with a smaller ``rank``.  ``before`` is read
    backwards from the anchor."""
    width = -(-SIDE // 8) * 8
    n = len(group)
    out = np.zeros((n, SIDE + 1), dtype=bool)
    sides = [radix_order(group, _strings(x, width)) for x in (before, behind)]

    def classes(side: int, length: int) -> np.ndarray:
        order, common = sides[side]
        found = np.empty(n, dtype=np.int64)
        found[order] = np.cumsum(common < length)
        return found

    for d in range(int(low.min()), int(high.max()) + 1):
        rows = np.flatnonzero((low <= d) & (d <= high))
        if len(rows) < 2:
            continue
        pair = classes(0, d)[rows] * (n + 1) + classes(1, SIDE - d)[rows]
        by = np.lexsort((rank[rows], pair))
        new = np.concatenate(([True], pair[by][1:] != pair[by][:-1]))
        first = rank[rows][by][np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        out[rows[by], d] = rank[rows][by] > first
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


_AROUND_TYPE = pa.list_(pa.struct([("anchor", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
                                   ("before", pa.binary()), ("behind", pa.binary()), ("at", pa.list_(pa.int32()))]))
_AROUND_SQL = "array<struct<anchor: long, low: int, high: int, before: binary, behind: binary, at: array<int>>>"
_OUT = ("n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _outcome(text: bytes, cuts: list[tuple[int, int]]) -> tuple[int, int, int, str]:
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    if cuts:
        where = np.array(cuts, dtype=np.int64)
        np.add.at(edge, where[:, 0], 1)
        np.add.at(edge, where[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = _runs(gone)
    kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes() if runs else text
    return len(text), int(gone.sum()), len(runs), hashlib.sha256(kept).hexdigest()


def _merged(cuts: list[tuple[int, int]]) -> list[int]:
    flat: list[int] = []
    for a, b in sorted(cuts):
        if flat and a <= flat[-1]:
            flat[-1] = max(flat[-1], b)
        else:
            flat += [a, b]
    return flat


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The outcome of every text whose windows are all decided, and text, cuts
    and surroundings to check of the others."""
    for batch in _portions(batches, _packed_bytes):
        texts = [pa.decompress(z, n, codec="zstd", asbytes=True) if n else b"" for z, n in
                 zip(batch.column("packed").to_pylist(), batch.column("size").to_pylist())]
        whole, check = (batch.column(c) for c in ("whole", "check"))
        cuts: list[list[tuple[int, int]]] = [[] for _ in texts]
        around_of: list[list[dict]] = [[] for _ in texts]
        text_no, place, first, last, anchor, around = _places(texts)
        _own_repeats(texts, text_no, place, first, last, anchor, around, cuts)
        bounds = np.searchsorted(text_no, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            own = slice(int(bounds[i]), int(bounds[i + 1]))
            if whole[i].is_valid and len(whole[i]):
                gone = np.flatnonzero(np.isin(around[own], whole[i].values.to_numpy().view(_U))) + own.start
                cuts[i] += zip(first[gone].tolist(), (last[gone] + WINDOW).tolist())
            if check[i].is_valid and len(check[i]):
                held: dict[int, dict] = {}
                for j in (np.flatnonzero(np.isin(around[own], check[i].values.to_numpy().view(_U))) + own.start).tolist():
                    p, f, e = int(place[j]), int(first[j]), int(last[j])
                    key = int(around[j])
                    if key not in held:
                        held[key] = {"anchor": int(anchor[j:j + 1].view(np.int64)[0]), "low": p - e, "high": p - f,
                                     "before": texts[i][f:p][::-1], "behind": texts[i][p + ANCHOR:e + WINDOW], "at": []}
                    held[key]["at"].append(p)
                around_of[i] += held.values()
        done = [None if held else _outcome(text, cut) for text, cut, held in zip(texts, cuts, around_of)]
        columns = list(zip(*[(d if d else (None,) * 4) for d in done])) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
             pa.array([None if d else z for d, z in zip(done, batch.column("packed").to_pylist())], pa.binary()), batch.column("size"),
             pa.array([None if d else _merged(c) for d, c in zip(done, cuts)], pa.list_(pa.int32())),
             pa.array([held or None for held in around_of], _AROUND_TYPE)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "packed", "size", "cuts", "surroundings"])


def _own_repeats(texts, text_no, place, first, last, anchor, around, cuts) -> None:
    """Windows that also start earlier in the same text."""
    if not len(place):
        return
    by = np.lexsort((place, around, anchor, text_no))
    t, a, r = text_no[by], anchor[by], around[by]
    group = np.concatenate(([True], (t[1:] != t[:-1]) | (a[1:] != a[:-1])))
    kind = group | np.concatenate(([True], r[1:] != r[:-1]))
    for j in by[~kind].tolist():                               # the same surroundings again
        cuts[int(text_no[j])].append((int(first[j]), int(last[j]) + WINDOW))
    of = np.cumsum(group) - 1
    several = np.add.reduceat(kind.astype(np.int64), np.flatnonzero(group)) > 1
    pick = np.flatnonzero(kind & several[of])
    if not len(pick):
        return
    rows = by[pick]
    flags = later(of[pick], place[rows], place[rows] - last[rows], place[rows] - first[rows],
                  [texts[i][f:p][::-1] for i, f, p in zip(text_no[rows].tolist(), first[rows].tolist(), place[rows].tolist())],
                  [texts[i][p + ANCHOR:e + WINDOW] for i, p, e in zip(text_no[rows].tolist(), place[rows].tolist(), last[rows].tolist())])
    ends = np.concatenate((np.flatnonzero(kind), [len(by)]))    # where the places of one kind end
    for k in np.flatnonzero(flags.any(axis=1)).tolist():
        begin = int(pick[k])
        end = int(ends[np.searchsorted(ends, begin, side="right")])
        for d0, d1 in _runs(flags[k]):
            for x in by[begin:end].tolist():
                cuts[int(text_no[x])].append((int(place[x]) - d1 + 1, int(place[x]) - d0 + WINDOW))


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surroundings come sorted by anchor: the stretches of every row that start
    in a smaller doc_id too."""
    def decide(t: pa.Table) -> pa.RecordBatch:
        anchor, doc, row = (t.column(c).to_numpy() for c in ("anchor", "doc_id", "row"))
        low, high = (t.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
        flags = later(anchor, doc, low, high, t.column("before").to_pylist(), t.column("behind").to_pylist())
        hit = np.flatnonzero(flags.any(axis=1))
        at = t.column("at").take(pa.array(hit)).to_pylist()
        spans = [[x for d0, d1 in _runs(flags[k]) for p in places for x in (p - d1 + 1, p - d0 + WINDOW)]
                 for k, places in zip(hit.tolist(), at)]
        return pa.RecordBatch.from_arrays([pa.array(row[hit]), pa.array(spans, pa.list_(pa.int32()))], names=["row", "spans"])

    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        if held.num_rows < 10_000:
            continue
        anchor = held.column("anchor").to_numpy()
        other = np.flatnonzero(anchor != anchor[-1])
        if len(other):
            yield decide(held.slice(0, int(other[-1]) + 1))
            held = held.slice(int(other[-1]) + 1)
    if held is not None and held.num_rows:
        yield decide(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of surroundings, as two hashes of its bytes around the anchor."""
    for batch in batches:
        doc, row, h1, h2, begin = [], [], [], [], []
        for i, r in enumerate(batch.to_pylist()):
            data = np.frombuffer(r["before"][::-1] + r["behind"], dtype=np.uint8)
            n = len(r["before"])
            d = np.arange(r["low"], r["high"] + 1)
            # the anchor and its place stand for the bytes left out
            seed = _U(r["anchor"] & 0xFFFFFFFFFFFFFFFF) + d.astype(_U) * _U(0x9E3779B97F4A7C15)
            for hasher, out in ((_AROUND, h1), (_OTHER, h2)):
                sums, down = _sums(data, hasher)
                out.append(WD.mix((sums[n - d + SIDE] - sums[n - d]) * down[n - d] + seed).view(np.int64))
            doc.append(np.full(len(d), r["doc_id"]))
            row.append(np.full(len(d), r["row"]))
            begin += [[p - x for p in r["at"]] for x in d.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (row, doc, h1, h2)]
                                         + [pa.array(begin, pa.list_(pa.int32()))], names=["row", "doc_id", "h1", "h2", "begin"])


def _checked(found: DataFrame) -> DataFrame:
    """row, spans of the surroundings that are compared over documents."""
    rows = found.filter("surroundings IS NOT NULL").select("row", "doc_id", F.inline("surroundings"))
    crowded = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP).select("anchor")
    schema = "row long, spans array<int>"
    if not crowded.limit(1).count():
        return (rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorted_out, schema))
    # At most one key per GROUP rows.
    crowded = F.broadcast(_stored(crowded, "suffix-crowded").withColumn("_crowded", F.lit(True)))
    rows = rows.join(crowded, "anchor", "left")
    plain = (rows.filter("_crowded IS NULL").drop("_crowded").repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(_sorted_out, schema))
    windows = _stored(rows.filter("_crowded").drop("_crowded").mapInArrow(
        _windows, "row long, doc_id long, h1 long, h2 long, begin array<int>"), "suffix-windows")
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
                                            F.count(F.lit(1)).alias("n")).filter("least < most").drop("most")
    gone = join_counted(windows, _stored(least, "suffix-least"), ["h1", "h2"], "n").filter("doc_id > least")
    spans = F.flatten(F.transform("begin", lambda p: F.array(p, p + WINDOW)))
    return plain.unionByName(gone.select("row", spans.alias("spans")))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _portions(batches, _packed_bytes):
        out = []
        for z, n, cuts, spans in zip(*[batch.column(c).to_pylist() for c in ("packed", "size", "cuts", "spans")]):
            flat = [*(cuts or []), *(spans or [])]
            out.append(_outcome(pa.decompress(z, n, codec="zstd", asbytes=True), list(zip(flat[0::2], flat[1::2]))))
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _portions(batches, _text_bytes):
        texts = [_raw(t) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([pa.compress(t, codec="zstd", asbytes=True) if t else b"" for t in texts], pa.binary()),
             pa.array([len(t) for t in texts], pa.int64())], names=["doc_id", "packed", "size"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs
    (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = docs.mapInArrow(_packed, "doc_id long, packed binary, size long")
    known = packed.filter("doc_id IS NOT NULL").join(_marks(docs.filter("doc_id IS NOT NULL")), F.col("doc_id") == F.col("m_doc"), "left")
    # Rows without an id would all meet in one task of the join.
    none = F.lit(None).cast("array<long>")
    apart = packed.filter("doc_id IS NULL").select("*", none.alias("whole"), none.alias("check"))
    texts = known.select("doc_id", "packed", "size", "whole", "check").unionByName(apart)
    found = _stored(texts.mapInArrow(_read, f"doc_id long, {_OUT}, packed binary, size long, cuts array<int>, surroundings {_AROUND_SQL}")
                    .withColumn("row", F.monotonically_increasing_id()), "suffix-found")
    decided = found.filter("surroundings IS NULL").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    spans = _checked(found).groupBy(F.col("row").alias("s_row")).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    rest = (found.filter("surroundings IS NOT NULL").select("row", "doc_id", "packed", "size", "cuts")
            .join(spans, F.col("row") == F.col("s_row"), "left").select("doc_id", "packed", "size", "cuts", "spans")
            .mapInArrow(_finish, f"doc_id long, {_OUT}"))
    return decided.unionByName(rest)


def op11_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(read_table(spark, sf_dir, "documents"))
