r"""Secret scan with multipart credential linking.

Strong findings (``BASE`` kinds) are reported wherever their pattern matches.
Weak parts (an identifier, an opaque blob, an endpoint) mean nothing alone:
they are reported only when the other parts of a credential lie in the same
scope, that is within ``SCOPE`` code points: a blob beside an identifier, an
identifier beside a secret, an endpoint beside both.

Matches of a kind are leftmost and do not overlap.  Their places follow from
the lengths of the stretches between them (the text split at the pattern), as
running sums over exploded match rows.  Parts are then joined by interval: both
sides are laid into bins of ``SCOPE`` code points, one side is aggregated per
(document, bin, role) first, so no pairs are enumerated and a document with
very many parts costs its length.  Only DataFrame functions are used.  ``spans``
shuffles match lengths, never texts (unless they are among the columns asked
for); ``redact`` stores and shuffles the texts that can hold a finding, that is a
strong one or an identifier and a blob, and passes the others through.

Defined cases: null text has no spans; null and repeated doc_ids are kept row by
row; an empty table gives an empty result; ``redact`` keeps extra columns, whatever
their names.
Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordcheck.llm.columns import aside
from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

SCOPE = 200                   # code points
VALUE_MIN = 6                 # characters of an assigned value


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_SET = r"""["']?\x20*[:=]\x20*["']?"""
_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
_ID_NAMES = "|".join(map(_any_case, ("access_key_id", "client_id", "account", "username", "user", "login")))

# kind -> (pattern, role); the order is the order of kinds at one start
PATTERNS = {
    "assign": (rf"""({_NAMES}){_SET}([A-Za-z0-9+/_.=-]+)""", "secret"),
    "access": (r"""AKIA[A-Z0-9]{16,}""", "id"),
    "hex": (r"""[0-9a-f]{24,}""", "secret"),
    "ident": (rf"""({_ID_NAMES}){_SET}([A-Za-z0-9@._-]+)""", "id"),
    "blob": (r"""[A-Za-z0-9+/=]{40,}""", "secret"),
    "endpoint": (r"""https?://[A-Za-z0-9.-]+(:[0-9]+)?""", "endpoint"),
}
BASE = ("assign", "access", "hex")
WEAK = ("ident", "blob", "endpoint")
_ORDER = {kind: i for i, kind in enumerate(PATTERNS)}
_VALUED = ("assign", "ident")         # group 2 must have VALUE_MIN characters


def _matches(kind: str) -> Column:
    """Per match of a kind: code points since the last match, its length and
    whether it counts (one more entry for the text after the last match, with a
    null length).  Null for a text without a match."""
    pattern = PATTERNS[kind][0]
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("text", F.lit(pattern), F.lit(2)) if kind in _VALUED else found
    rows = F.arrays_zip(F.split("text", pattern, -1), found, value)
    entry = F.transform(rows, lambda x: F.struct(
        F.lit(kind).alias("kind"), F.length(x["0"]).alias("gap"), F.length(x["1"]).alias("length"),
        (F.length(x["2"]) >= VALUE_MIN).alias("counts")))
    return F.when(F.col("text").rlike(pattern), entry)


def may_hold() -> Column:
    """Whether a text can have a reported span: all strong kinds are, and weak
    parts only where an identifier and a secret meet."""
    has = {k: F.col("text").rlike(PATTERNS[k][0]) for k in (*BASE, "ident", "blob")}
    strong = has["assign"] | has["access"] | has["hex"]
    return F.coalesce(strong | (has["ident"] & has["blob"]), F.lit(False))


def _found(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Stored table: row id, ``columns`` and the matches of every kind."""
    found = docs.select(*columns, *[_matches(k).alias(f"_m_{k}") for k in PATTERNS])
    return scratch_table(docs.sparkSession, found.withColumn("_row", F.monotonically_increasing_id()), "secret-matches")


def _parts(found: DataFrame) -> DataFrame:
    """(_row, kind, role, start, end) of every match that counts."""
    kinds = F.array(*[F.col(f"_m_{k}") for k in PATTERNS])
    rows = (found.select("_row", F.explode(F.array_compact(kinds)).alias("m"))
            .select("_row", F.posexplode("m").alias("place", "x")).select("_row", "place", "x.*")
            .filter(F.col("length").isNotNull()))
    so_far = W.partitionBy("_row", "kind").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    role = F.create_map(*[F.lit(x) for kind, (_, r) in PATTERNS.items() for x in (kind, r)])
    return (rows.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far))
            .filter("counts")
            .select("_row", "kind", role[F.col("kind")].alias("role"), (F.col("end") - F.col("length")).alias("start"), "end"))


def _bins(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(F.greatest(first, F.lit(0)) / SCOPE), F.floor(F.greatest(last, F.lit(0)) / SCOPE)))


def linked(parts: DataFrame) -> DataFrame:
    """The weak parts whose other parts lie within SCOPE code points."""
    beside = (parts.withColumn("bin", _bins(F.col("start"), F.col("end")))
              .groupBy("_row", "bin", F.col("role").alias("other"))
              .agg(F.min("start").alias("first"), F.max("end").alias("last")))
    weak = (parts.filter(F.col("kind").isin(*WEAK))
            .withColumn("bin", _bins(F.col("start") - SCOPE, F.col("end") + SCOPE)))
    near = ((F.col("first") <= F.col("end") + SCOPE) & (F.col("last") >= F.col("start") - SCOPE)
            & (F.col("other") != F.col("role")))
    has = {r: F.max(F.when(F.col("other") == r, 1).otherwise(0)) for r in ("id", "secret")}
    met = (weak.join(beside, ["_row", "bin"]).filter(near)
           .groupBy("_row", "kind", "role", "start", "end")
           .agg(has["id"].alias("has_id"), has["secret"].alias("has_secret")))
    complete = (F.when(F.col("role") == "id", F.col("has_secret") == 1)
                .when(F.col("role") == "secret", F.col("has_id") == 1)
                .otherwise((F.col("has_id") == 1) & (F.col("has_secret") == 1)))
    return met.filter(complete).select("_row", "kind", "role", "start", "end")


def spans(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every row plus ``found``: its reported spans, an array of
    (start, place of the kind, end, kind) in order; null without any."""
    found = _found(docs, columns)
    parts = scratch_table(docs.sparkSession, _parts(found), "secret-parts")
    reported = parts.filter(F.col("kind").isin(*BASE)).unionByName(linked(parts))
    order = F.create_map(*[F.lit(x) for kv in _ORDER.items() for x in kv])
    by_row = reported.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", order[F.col("kind")].alias("place"), "end", "kind"))).alias("found"))
    return found.select("_row", *columns).join(by_row, "_row", "left").drop("_row")


def _joined(found: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","),
                      F.lit(""))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark`` (spans
    that overlap become one) and n_chars, if there, counted again.  ``docs`` is
    read twice, so it should be a stored table."""
    inner, carried, restore = aside(docs, "text")
    marked = spans(inner.filter(may_hold()), [*carried, "text"])
    merged = F.expr("""aggregate(found, cast(array() as array<struct<a:bigint,b:bigint>>), (acc, x) ->
        CASE WHEN size(acc) > 0 AND x.start <= element_at(acc, -1).b
             THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('a', element_at(acc, -1).a,
                  'b', greatest(element_at(acc, -1).b, x.end))))
             ELSE concat(acc, array(named_struct('a', x.start, 'b', x.end))) END)""")
    kept = F.expr(f"""concat(array_join(transform(cuts, (c, i) -> concat(
        substring(text, CAST(if(i = 0, 0, cuts[i - 1].b) + 1 AS INT), CAST(c.a - if(i = 0, 0, cuts[i - 1].b) AS INT)),
        '{mark}')), ''), substring(text, CAST(element_at(cuts, -1).b + 1 AS INT)))""")
    out = marked.withColumn("cuts", merged).withColumn("_clean", F.when(F.size("found") > 0, kept).otherwise(F.col("text")))
    place = dict(zip(docs.columns, carried))
    out = out.withColumn(place["text"], F.col("_clean"))
    if "n_chars" in place:
        counted = F.when(F.size("found") > 0, F.length("_clean")).otherwise(F.col(place["n_chars"]))
        out = out.withColumn(place["n_chars"], counted.cast(docs.schema["n_chars"].dataType))
    return restore(out.select(*carried).unionByName(inner.filter(~may_hold()).select(*carried)))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    docs = read_table(spark, sf_dir, "documents")
    rows = spans(docs, ["doc_id"])
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("found", lambda x: x["kind"] == kind)), F.lit(0)).cast("long")

    return rows.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                       F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def _oracle() -> str:
    """DuckDB SQL for op7: same patterns, places by running sums, linking by a
    range condition between parts of one document."""
    kinds = []
    for kind, (pattern, role) in PATTERNS.items():
        quoted = "'" + pattern.replace("'", "''") + "'"
        value = f"regexp_extract_all(text, {quoted}, 2)" if kind in _VALUED else f"regexp_extract_all(text, {quoted})"
        kinds.append(f"""SELECT doc_id, '{kind}' AS kind, '{role}' AS role, {_ORDER[kind]} AS place,
          unnest(regexp_split_to_array(text, {quoted})[:-2]) AS gap, unnest(regexp_extract_all(text, {quoted})) AS m,
          unnest({value}) AS v, unnest(range(len(regexp_extract_all(text, {quoted})))) AS i FROM documents""")
    base = "', '".join(BASE)
    return f"""
WITH m AS ({' UNION ALL '.join(kinds)}),
e AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop FROM m),
p AS (SELECT doc_id, kind, role, place, stop - length(m) AS start, stop FROM e WHERE length(v) >= {VALUE_MIN}),
near AS (
  SELECT w.doc_id, w.kind, w.place, w.start, w.stop, w.role,
         bool_or(c.role = 'id') AS has_id, bool_or(c.role = 'secret') AS has_secret
  FROM p w JOIN p c ON w.doc_id = c.doc_id AND c.role <> w.role
       AND c.start <= w.stop + {SCOPE} AND c.stop >= w.start - {SCOPE}
  WHERE w.kind NOT IN ('{base}') GROUP BY ALL),
r AS (
  SELECT doc_id, kind, place, start, stop FROM p WHERE kind IN ('{base}')
  UNION ALL
  SELECT doc_id, kind, place, start, stop FROM near
  WHERE CASE role WHEN 'id' THEN has_secret WHEN 'secret' THEN has_id ELSE has_id AND has_secret END),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (kind IN ('{base}')) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""


ORACLE = _oracle()
