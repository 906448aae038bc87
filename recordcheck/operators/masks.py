"""Bit masks: what a record's fields and rules came to, in a few BIGINTs.

For every record the evaluation yields words of up to ``BITS`` bits:

* ``_rc_n*`` / ``_rc_b*``: which fields are NULL / blank (one trim per field);
* ``_rc_f*``: which of the other rules fired.

Rules test the bits of the fields they name instead of trimming them again.
The NULL and blank rules (R1, R2: two thirds of the catalogue) need no bit of
their own, they *are* the field bits.  Counters are bit counts under a
constant mask, lists are built from bit tests, observations are constants picked
by bit, totals per rule are sums of bits: nothing is filtered, folded or
exploded, and a record's whole outcome is stored in five numbers (54 fields, 63
other rules).

A ``Layout`` says which bit is whose; it depends on the rules and fields alone, so
stored masks can be read again with the same catalogue.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordcheck.functions import predicates as P
from recordcheck.functions.sql import ident, lit, unfused
from recordcheck.operators.rules import FieldRefs, Rule

BITS = 63                     # bits of a word; the sign stays free
OR = " /* next bit */ | "     # between the bits of a word
NULLS, BLANKS, FIRED = "_rc_n", "_rc_b", "_rc_f"
TRIMMED, UPPER, DIGITS, WHOLE = "_rc_t", "_rc_u", "_rc_d", "_rc_i"


def _tree(parts: Sequence[Column]) -> Column:
    """The parts OR-ed as a balanced tree: generated code is cut at every node that
    grows too long for one method.  A tree of Columns, since the parser looks through all
    of a pair of parentheses before it knows what they are, again for every pair inside."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _tree(parts[:half]).bitwiseOR(_tree(parts[half:]))


def _word(parts: Sequence[str], field: str) -> str:
    """The bits of one word, in a projection of small methods."""
    return OR.join((*parts, f"CAST(size({unfused(f"{ident(field)} = ''", 'INT')}) AS BIGINT)"))


def _column(text: str) -> Column:
    """A column of a step."""
    *bits, last = map(F.expr, text.split(OR))
    return _tree(bits).bitwiseOR(last) if bits else last


@dataclass(frozen=True)
class Bit:
    """One bit of one word."""
    word: str
    number: int

    @property
    def mask(self) -> int:
        return 1 << self.number

    @property
    def test(self) -> str:
        return f"(({self.word} & {self.mask}L) <> 0L)"


class MaskRefs(FieldRefs):
    """Field access of rule conditions through the field bits."""

    def __init__(self, layout: "Layout"):
        self._layout = layout

    def _both(self, field: str) -> str:
        n, b = self._layout.null_bit(field), self._layout.blank_bit(field)
        return f"(({n.word} | {b.word}) & {n.mask}L)"

    def empty(self, field: str) -> str:
        return f"({self._both(field)} <> 0L)"

    def filled(self, field: str) -> str:
        return f"({self._both(field)} = 0L)"


class Layout:
    """Bits of the fields and rules of a catalogue."""

    def __init__(self, rules: Sequence[Rule], fields: Sequence[str]):
        self.rules = tuple(rules)
        used = [f for r in rules for f in (r.field, *r.uses)]
        self.fields = tuple(dict.fromkeys((*fields, *used)))
        self._at = {f: i for i, f in enumerate(self.fields)}
        self._bits: list[Bit] = []
        taken: set[Bit] = set()
        fired = 0
        for r in self.rules:
            bit = None
            if r.state is not None and r.uses == (r.field,):
                bit = self.null_bit(r.field) if r.state == "null" else self.blank_bit(r.field)
            if bit is None or bit in taken:
                bit = Bit(f"{FIRED}{fired // BITS}", fired % BITS)
                fired += 1
            taken.add(bit)
            self._bits.append(bit)
        self.fired_words = -(-fired // BITS)

    def null_bit(self, field: str) -> Bit:
        i = self._at[field]
        return Bit(f"{NULLS}{i // BITS}", i % BITS)

    def blank_bit(self, field: str) -> Bit:
        i = self._at[field]
        return Bit(f"{BLANKS}{i // BITS}", i % BITS)

    def bit(self, n: int) -> Bit:
        """The bit of the ``n``-th rule."""
        return self._bits[n]

    @property
    def columns(self) -> list[str]:
        words = range(-(-len(self.fields) // BITS))
        return [*[f"{NULLS}{w}" for w in words], *[f"{BLANKS}{w}" for w in words],
                *[f"{FIRED}{w}" for w in range(self.fired_words)]]

    # expressions ------------------------------------------------------------------

    def _conditions(self) -> dict[Bit, str]:
        """Conditions of the rules with a bit of their own.  A test for content
        of a field they use becomes a test of its bits; its trimmed and upper-cased
        text, its digits and its integer value references to the ones made once."""
        refs, out = MaskRefs(self), {}
        for r, bit in zip(self.rules, self._bits):
            if not bit.word.startswith(FIRED):
                continue
            text = r.sql(refs)
            for f in dict.fromkeys((r.field, *r.uses)):
                i = self._at[f]
                for old, new in ((P.is_filled(f), refs.filled(f)), (P.is_empty(f), refs.empty(f)),
                                 (P.legacy_int(f), f"{WHOLE}{i}"), (P.only_digits(f), f"{DIGITS}{i}"),
                                 (P.upper_trim(f), f"{UPPER}{i}"), (f"trim({ident(f)})", f"{TRIMMED}{i}")):
                    text = text.replace(old, new)
            out[bit] = text
        return out

    def _made(self, conditions: dict[Bit, str], prefix: str) -> list[int]:
        found = {int(x) for text in conditions.values() for x in re.findall(rf"\b{prefix}(\d+)\b", text)}
        return sorted(found)

    def steps(self) -> list[dict[str, str]]:
        """Columns to add, projection by projection: trimmed texts, digits and integers
        that rules read, field bits (one trim per field), rule bits."""
        conditions = self._conditions()
        upper = self._made(conditions, UPPER)
        trimmed = sorted({*upper, *self._made(conditions, TRIMMED)})
        first = {f"{TRIMMED}{i}": f"trim({ident(self.fields[i])})" for i in trimmed}
        for prefix, made in ((DIGITS, P.only_digits), (WHOLE, P.legacy_int)):
            first |= {f"{prefix}{i}": made(self.fields[i]) for i in self._made(conditions, prefix)}
        second = {f"{UPPER}{i}": f"upper({TRIMMED}{i})" for i in upper}
        for w in range(0, len(self.fields), BITS):
            some = list(enumerate(self.fields))[w:w + BITS]
            text = {i: f"{TRIMMED}{i}" if i in trimmed else f"trim({ident(f)})" for i, f in some}
            second[f"{NULLS}{w // BITS}"] = _word([f"if({P.is_null(f)}, {1 << (i - w)}L, 0L)" for i, f in some], self.fields[w])
            second[f"{BLANKS}{w // BITS}"] = _word([f"if({text[i]} = '', {1 << (i - w)}L, 0L)" for i, _ in some], self.fields[w])
        words: dict[str, list[str]] = {}
        for bit, text in conditions.items():
            words.setdefault(bit.word, []).append(f"if({text}, {bit.mask}L, 0L)")
        return [first, second, {word: _word(parts, self.fields[0]) for word, parts in words.items()}]

    def count(self, chosen: Sequence[int]) -> str:
        """How many of the chosen rules (numbers) fired."""
        masks: dict[str, int] = {}
        for n in chosen:
            masks[self._bits[n].word] = masks.get(self._bits[n].word, 0) | self._bits[n].mask
        if not masks:
            return "0"
        return "(" + " + ".join(f"bit_count({w} & {m}L)" for w, m in masks.items()) + ")"

    def any_of(self, chosen: Sequence[int]) -> str:
        masks: dict[str, int] = {}
        for n in chosen:
            masks[self._bits[n].word] = masks.get(self._bits[n].word, 0) | self._bits[n].mask
        return "(" + " OR ".join(f"({w} & {m}L) <> 0L" for w, m in masks.items()) + ")" if masks else "false"

    def _looked_up(self, chosen: Sequence[int], entry: Callable[[list[int]], str]) -> list[str]:
        """Four rules at a time, their bits are the place in a constant table of
        16 entries (one per subset of them), so expressions stay small."""
        parts = []
        for a in range(0, len(chosen), 4):
            some = [self._bits[n] for n in chosen[a:a + 4]]
            place = " | ".join(f"shiftleft(CAST(shiftright({b.word}, {b.number}) & 1L AS INT), {i})" for i, b in enumerate(some))
            table = [entry([n for i, n in enumerate(chosen[a:a + 4]) if x >> i & 1]) for x in range(1 << len(some))]
            parts.append(f"element_at(array({', '.join(table)}), ({place}) + 1)")
        return parts

    def fired(self) -> str:
        """``array<int>``: the numbers of the rules that fired, in rule order."""
        parts = self._looked_up(range(len(self.rules)), lambda ns: f"array({', '.join(map(str, ns))})" if ns else "CAST(array() AS ARRAY<INT>)")
        return f"flatten(array({', '.join(parts)}, {unfused(f'{self._bits[0].word} = 0L', 'INT')}))" if parts else "CAST(array() AS ARRAY<INT>)"

    def joined(self, texts: dict[int, str], sep: str = ", ") -> str:
        """The texts of the rules that fired, in rule order."""
        parts = self._looked_up(sorted(texts), lambda ns: lit(sep.join(texts[n] for n in ns)) if ns else "CAST(NULL AS STRING)")
        return f"concat_ws({lit(sep)}, {', '.join(parts)}, {unfused(f'{self._bits[min(texts)].word} = 0L', 'STRING')})" if parts else "''"


def with_masks(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` plus the mask columns: narrow projections, no shuffle."""
    clash = sorted(c for c in df.columns if re.fullmatch(r"_rc_[nbftudi]\d+", c))
    if clash:
        raise ValueError(f"columns of the input have names of the masks: {clash}")
    kept = [F.col(ident(c)) for c in df.columns]
    out = df
    for step in layout.steps():
        if step:
            out = out.select("*", *[_column(e).alias(c) for c, e in step.items()])
    return out.select(*kept, *layout.columns)


def bit_counts(words: Sequence[np.ndarray]) -> list[np.ndarray]:
    """How often every bit of every word is set."""
    return [np.unpackbits(np.ascontiguousarray(w).view(np.uint8).reshape(len(w), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            for w in words]


def _summed(columns: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(columns) * 64, dtype=np.int64)
        for batch in batches:
            total += np.concatenate(bit_counts([batch.column(c).to_numpy() for c in columns]))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])
    return run


def rule_totals(masked: DataFrame, layout: Layout) -> DataFrame:
    """(rule, count): on how many records every rule fired (rules that did not fire
    are left out).  The masks are vectors of 0 and 1: every task adds up its own,
    element by element, and the tasks' vectors are added up; no row is exploded."""
    spark, columns = masked.sparkSession, layout.columns
    sums = (masked.select(*columns).mapInArrow(_summed(columns), "at int, n long").groupBy("at").agg(F.sum("n").alias("count")))
    number = {columns.index(b.word) * 64 + b.number: n for n, b in enumerate(layout._bits)}
    names = spark.createDataFrame(sorted(number.items()), "at int, rule int")
    return sums.join(F.broadcast(names), "at").select("rule", "count")
