r"""Resolution of not-modified revisits in web archive records.

A *revisit* record of a 304 answer stores no body: it stands for the latest
earlier full response of the same page.  Records are joined as of their date by
canonical URL, the validators of the 304 are checked against that response, and
the answer a client would have seen is rebuilt: the stored headers, updated by
the permitted headers of the 304, with the stored body.

The as-of join is two aggregations deep.  Time is cut into buckets; the last
response of every (URL, bucket) is aggregated, carried forward over the buckets
of a period and over the periods of a URL (one row each), and only inside one
bucket rows are sorted.  A URL with a third of all records is spread over its
buckets, and bodies move only in the final join to the response that was found.
Places (URL, second, id) and choices are stored as narrow tables, so records are
parsed once; a broadcast bitmap of the chosen ids keeps most bodies that no
revisit refers to out of the shuffle of that join.

Records: record_id, warc_type, target_uri, warc_date (ISO 8601), http (status
line and headers), payload.  Status of a revisit: ``resolved``; ``no_earlier``
(no full response before it); ``mismatch`` (validators differ or one side lacks
them); ``not_304`` (its own status line is no 304).

Defined cases: null or malformed URLs and dates match nothing (``no_earlier``);
null http has no headers and is no 304; a response counts as full if its status
is 200 and its payload is not null (an empty payload counts); of responses at
one second the largest record_id counts; a response at the very second of the
revisit is not earlier; repeated response rows of one record_id are one record;
repeated revisit rows are resolved each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table

BUCKET = 3600                 # seconds
PERIOD = 24                   # buckets
BITS_PER_ID = 16              # of the bitmap of chosen ids
MAX_BITS = 1 << 28            # its largest size (32 MB)

# Headers that a 304 must not change in the stored response
# (hop-by-hop fields and those that describe the stored body).
KEPT_FROM_STORED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer",
                    "transfer-encoding", "upgrade")

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def canonical_url(uri: Column) -> Column:
    """Scheme and host in lower case, no user, default port or fragment, ``/``
    for an empty path, query parameters sorted; null for anything else."""
    part = lambda i: F.regexp_extract(uri, _URL, i)                                     # noqa: E731
    scheme = F.lower(part(1))
    host = F.lower(F.regexp_replace(part(2), "^.*@", ""))
    host = (F.when(scheme == "http", F.regexp_replace(host, ":80$", ""))
            .when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host))
    path = F.when(part(3) == "", F.lit("/")).otherwise(part(3))
    query = F.array_join(F.array_sort(F.split(F.substring(part(4), 2, 1_000_000_000), "&")), "&")
    return F.when(uri.rlike(_URL), F.concat(scheme, F.lit("://"), host, path,
                                            F.when(F.length(part(4)) > 1, F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def seconds(date: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(date, F.lit("yyyy-MM-dd'T'HH:mm:ssX")))


def headers(http: Column) -> Column:
    """array<struct<name, value>>, names in lower case, in order."""
    every = F.split(F.coalesce(http, F.lit("")), "\r?\n")
    lines = F.filter(F.slice(every, F.lit(2), F.size(every)), lambda x: x.rlike("^[^:\\s]+:"))
    return F.transform(lines, lambda x: F.struct(
        F.lower(F.regexp_extract(x, "^([^:]+):", 1)).alias("name"), F.trim(F.regexp_extract(x, "^[^:]+:(.*)$", 1)).alias("value")))


def status_code(http: Column) -> Column:
    return F.regexp_extract(F.coalesce(http, F.lit("")), r"^HTTP/[0-9.]+ ([0-9]{3})", 1)


def header(of: Column, name: str) -> Column:
    """The value of a header (the first, if it is repeated), or null."""
    return F.get(F.filter(of, lambda h: h["name"] == name), F.lit(0))["value"]


def validated(old: Column, new: Column) -> Column:
    """Whether a 304 with headers ``new`` confirms a response with ``old``: its
    ETag decides (weak comparison), without one its Last-Modified; with neither,
    the response must have neither."""
    def tag(h: Column) -> Column:
        return F.regexp_replace(header(h, "etag"), "^W/", "")

    said, modified = tag(new), header(new, "last-modified")
    return F.coalesce(F.when(said.isNotNull(), said == tag(old))
                      .when(modified.isNotNull(), modified == header(old, "last-modified"))
                      .otherwise(tag(old).isNull() & header(old, "last-modified").isNull()), F.lit(False))


def merged_headers(old: Column, new: Column) -> Column:
    """Headers of the stored response updated by the permitted ones of the 304."""
    may = F.filter(new, lambda h: ~h["name"].isin(*KEPT_FROM_STORED))
    return F.concat(F.filter(old, lambda h: ~F.exists(may, lambda m: m["name"] == h["name"])), may)


def header_block(http: Column, of: Column) -> Column:
    first = F.regexp_extract(http, "^([^\r\n]*)", 1)
    return F.concat(first, F.lit("\r\n"), F.array_join(F.transform(
        of, lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\r\n"), F.lit("\r\n\r\n"))


def _latest_earlier(events: DataFrame) -> DataFrame:
    """events (url, at, record_id, full) -> revisit id, id of the latest full
    response of the url before it."""
    events = events.withColumn("bucket", F.floor(F.col("at") / BUCKET))
    response = F.when(F.col("full"), F.struct("at", "record_id"))
    # The last response before every bucket: earlier buckets of its period, else
    # the last of earlier periods; no window holds more than a URL's periods.
    buckets = (events.groupBy("url", "bucket").agg(F.max(response).alias("last"))
               .withColumn("period", F.floor(F.col("bucket") / PERIOD)))
    before = (lambda *key: W.partitionBy(*key[:-1]).orderBy(key[-1]).rowsBetween(W.unboundedPreceding, -1))
    periods = buckets.groupBy("url", "period").agg(F.max("last").alias("last")).select(
        "url", "period", F.last("last", ignorenulls=True).over(before("url", "period")).alias("older"))
    carried = (buckets.withColumn("recent", F.last("last", ignorenulls=True).over(before("url", "period", "bucket")))
               .join(periods, ["url", "period"]).select("url", "bucket", F.coalesce("recent", "older").alias("carried")))
    # Inside a bucket: the last response at an earlier second.
    inside = W.partitionBy("url", "bucket").orderBy("at").rangeBetween(W.unboundedPreceding, -1)
    found = (events.withColumn("within", F.max(response).over(inside)).filter(~F.col("full"))
             .join(carried, ["url", "bucket"]))
    return found.select(F.col("row"), F.coalesce("within", "carried")["record_id"].alias("refers_to"))


def _less_unwanted(responses: DataFrame, found: DataFrame) -> DataFrame:
    """``responses`` (record_id, ...) less most of those that ``found`` (refers_to)
    does not name.  The bitmap has one bit per hash of an id, in rows of 32,768
    bits; beyond MAX_BITS ids it would hold back next to nothing and all pass."""
    named = found.count()
    if named > MAX_BITS:
        return responses
    bits = 1 << 15
    while bits < min(BITS_PER_ID * named, MAX_BITS):
        bits *= 2

    def place(of: str) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(bits))

    bitmaps = (found.select(place("refers_to").alias("b")).groupBy(F.shiftright("b", 15).alias("b_row"))
               .agg(F.bitmap_construct_agg(F.col("b").bitwiseAND(F.lit(32767))).alias("b_map")))
    byte = F.conv(F.hex(F.expr("substring(b_map, cast(shiftright(b_at, 3) AS INT) + 1, 1)")), 16, 10).cast("int")
    return (responses.withColumn("b_row", F.shiftright(place("record_id"), 15))
            .withColumn("b_at", place("record_id").bitwiseAND(F.lit(32767)))
            .join(F.broadcast(bitmaps), "b_row").filter(F.getbit(byte, F.col("b_at").bitwiseAND(F.lit(7)).cast("int")) == 1)
            .drop("b_row", "b_at", "b_map"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit record: record_id, canonical_url, warc_date, status,
    refers_to, refers_to_date, http (rebuilt), payload."""
    spark = records.sparkSession
    is_revisit = F.coalesce(F.col("warc_type") == "revisit", F.lit(False))
    revisits = scratch_table(spark, records.filter(is_revisit).select(
        F.monotonically_increasing_id().alias("row"), "record_id", "warc_date", "http",
        canonical_url(F.col("target_uri")).alias("url"), seconds(F.col("warc_date")).alias("at")), "warc-revisits")
    full = (F.coalesce(F.col("warc_type") == "response", F.lit(False)) & (status_code(F.col("http")) == "200")
            & F.col("payload").isNotNull() & F.col("record_id").isNotNull())
    responses = records.filter(full)
    places = responses.select(F.lit(None).cast("long").alias("row"), "record_id", canonical_url(F.col("target_uri")).alias("url"),
                              seconds(F.col("warc_date")).alias("at"), F.lit(True).alias("full"))
    events = (places.unionByName(revisits.select("row", "record_id", "url", "at", F.lit(False).alias("full")))
              .filter(F.col("url").isNotNull() & F.col("at").isNotNull()))
    events = scratch_table(spark, events, "warc-events")
    found = scratch_table(spark, _latest_earlier(events).filter(F.col("refers_to").isNotNull()), "warc-found")
    bodies = responses.select("record_id", F.col("warc_date").alias("s_date"), F.col("http").alias("s_http"), "payload")
    stored = _less_unwanted(bodies, found).dropDuplicates(["record_id"]).withColumnRenamed("record_id", "s_id")
    rows = (revisits.join(found.withColumnRenamed("row", "f_row"), F.col("row") == F.col("f_row"), "left")
            .join(stored, F.col("refers_to") == F.col("s_id"), "left"))
    new, old = headers(F.col("http")), headers(F.col("s_http"))
    status = (F.when(status_code(F.col("http")) != "304", "not_304").when(F.col("s_id").isNull(), "no_earlier")
              .when(validated(old, new), "resolved").otherwise("mismatch"))
    done = F.col("status") == "resolved"
    return (rows.withColumn("status", status)
            .select("record_id", F.col("url").alias("canonical_url"), "warc_date", "status",
                    F.when(done, F.col("s_id")).alias("refers_to"), F.when(done, F.col("s_date")).alias("refers_to_date"),
                    F.when(done, header_block(F.col("s_http"), merged_headers(old, new))).alias("http"),
                    F.when(done, F.col("payload")).alias("payload")))


# Input of the query: archive records with the pages' URLs and bodies ----------------

# Every page was fetched three times with status 200, days apart, and changed with
# the last fetch; pages of one in four share one URL.  Every page was asked for
# again between, after or (one in twenty-one) before these and answered 304 (one
# in thirteen: 200), one in fifteen with another ETag, one in four without an ETag.
# (Portable SQL, used on both sides of the comparison.)
_DAY0 = "DATE '2024-01-01'"
FETCHES = 3


def _stand_in(concat_date: str) -> str:
    first = "(page_id * 7919 % 31000000)"
    again = f"({first} + CASE WHEN page_id % 21 = 0 THEN -60 ELSE 3600 + page_id % 9 * 86400 END)"
    address = "CASE WHEN page_id % 4 = 1 THEN concat('http://hot.example.com/?p=1&a=', page_id % 2) ELSE url END"

    def date(x: str) -> str:
        return concat_date.replace("{x}", x)

    def fetch(j: int) -> str:
        body = "html" if j < FETCHES - 1 else "concat(html, '<!-- new -->')"
        return f"""
  SELECT concat('r', page_id, '-{j}') AS record_id, 'response' AS warc_type, {address} AS target_uri, {date(f"({first} + {j * 3} * 86400)")} AS warc_date,
         concat('HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: ', length({body}), '\r\nETag: "', md5({body}),
                '"\r\nLast-Modified: Mon, 0', page_id % 9 + 1, ' Jan 2023 00:00:00 GMT\r\nCache-Control: max-age=60\r\n\r\n') AS http,
         {body} AS payload
  FROM pages"""

    return " UNION ALL".join(fetch(j) for j in range(FETCHES)) + f"""
  UNION ALL
  SELECT concat('v', page_id) AS record_id, 'revisit' AS warc_type, concat({address}, '#again') AS target_uri, {date(again)} AS warc_date,
         concat(CASE WHEN page_id % 13 = 0 THEN 'HTTP/1.1 200 OK\r\n' ELSE 'HTTP/1.1 304 Not Modified\r\n' END,
                CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 15 = 0 THEN 'ETag: "other"\r\n'
                     ELSE concat('etag: W/"', md5(html), '"\r\n') END,
                'Last-Modified: Mon, 0', page_id % 9 + 1, ' Jan 2023 00:00:00 GMT\r\nContent-Length: 0\r\nCache-Control: max-age=',
                page_id % 100, '\r\nX-Cache: HIT\r\n\r\n') AS http,
         CAST(NULL AS {{text}}) AS payload
  FROM pages"""


_SPARK_DATE = (f"concat(CAST(date_add({_DAY0}, CAST(floor({{x}} / 86400) AS INT)) AS STRING), 'T', "
               "lpad(CAST(floor(pmod({x}, 86400) / 3600) AS STRING), 2, '0'), ':', "
               "lpad(CAST(floor(pmod({x}, 3600) / 60) AS STRING), 2, '0'), ':', lpad(CAST(pmod({x}, 60) AS STRING), 2, '0'), 'Z')")
_DUCK_DATE = f"strftime({_DAY0}::TIMESTAMP + to_seconds({{x}}), '%Y-%m-%dT%H:%M:%SZ')"


def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the schema of ``resolve_revisits`` with the URLs and bodies of
    ``pages``; one row per fetch."""
    sql = _stand_in(_SPARK_DATE).replace("FROM pages", "FROM {pages}").replace("{text}", "STRING")
    return spark.sql(sql, pages=read_table(spark, sf_dir, "pages"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All revisit records over ``pages``, resolved; payload as digest and length."""
    done = resolve_revisits(archive_records(spark, sf_dir))
    return done.select("record_id", "canonical_url", "warc_date", "status", "refers_to", "refers_to_date", "http",
                       F.sha2("payload", 256).alias("payload_sha256"), F.length("payload").cast("long").alias("payload_length"))


def _oracle() -> str:
    kept = ", ".join(f"'{h}'" for h in KEPT_FROM_STORED)
    host = "lower(regexp_replace(regexp_extract(target_uri, re, 2), '^.*@', ''))"
    scheme = "lower(regexp_extract(target_uri, re, 1))"
    sql = _stand_in(_DUCK_DATE).replace("{text}", "VARCHAR").replace("'HTTP", "E'HTTP").replace("' Jan", "E' Jan")
    sql = sql.replace("'\r\n", "E'\r\n").replace("'\"\r\n", "E'\"\r\n").replace("\"other\"", '"other"').replace("\r", "\\r").replace("\n'", "\\n'")
    return f"""
WITH records AS ({sql}),
u AS (SELECT *, '{_URL}' AS re FROM records),
c AS (
  SELECT * EXCLUDE (re), CASE WHEN regexp_matches(target_uri, re) THEN
    {scheme} || '://' || CASE {scheme} WHEN 'http' THEN regexp_replace({host}, ':80$', '')
      WHEN 'https' THEN regexp_replace({host}, ':443$', '') ELSE {host} END
    || CASE WHEN regexp_extract(target_uri, re, 3) = '' THEN '/' ELSE regexp_extract(target_uri, re, 3) END
    || CASE WHEN length(regexp_extract(target_uri, re, 4)) > 1
       THEN '?' || array_to_string(list_sort(string_split(substr(regexp_extract(target_uri, re, 4), 2), '&')), '&') ELSE '' END END AS url,
    [{{'name': lower(regexp_extract(x, '^([^:]+):', 1)), 'value': trim(regexp_extract(x, '^[^:]+:(.*)$', 1))}}
     FOR x IN regexp_split_to_array(http, '\\r?\\n')[2:] IF regexp_matches(x, '^[^:\\s]+:')] AS h
  FROM u),
r AS (
  SELECT url, warc_date AS s_date, max(record_id) AS s_id FROM c WHERE warc_type = 'response' AND payload IS NOT NULL GROUP BY ALL),
v AS (SELECT v.*, r.s_id, r.s_date FROM (SELECT * FROM c WHERE warc_type = 'revisit') v
      ASOF LEFT JOIN r ON v.url = r.url AND v.warc_date > r.s_date),
j AS (
  SELECT v.*, s.http AS s_http, s.payload AS s_payload, s.h AS s_h,
         regexp_replace([x.value FOR x IN v.h IF x.name = 'etag'][1], '^W/', '') AS new_tag,
         regexp_replace([x.value FOR x IN s.h IF x.name = 'etag'][1], '^W/', '') AS old_tag,
         [x.value FOR x IN v.h IF x.name = 'last-modified'][1] AS new_mod,
         [x.value FOR x IN s.h IF x.name = 'last-modified'][1] AS old_mod,
         [x FOR x IN v.h IF x.name NOT IN ({kept})] AS may
  FROM v LEFT JOIN c s ON s.record_id = v.s_id),
t AS (
  SELECT *, CASE WHEN NOT regexp_matches(http, '^HTTP/[0-9.]+ 304') THEN 'not_304' WHEN s_id IS NULL THEN 'no_earlier'
    WHEN coalesce(CASE WHEN new_tag IS NOT NULL THEN new_tag = old_tag WHEN new_mod IS NOT NULL THEN new_mod = old_mod
         ELSE old_tag IS NULL AND old_mod IS NULL END, false) THEN 'resolved' ELSE 'mismatch' END AS status FROM j)
SELECT record_id, url AS canonical_url, warc_date, status,
       CASE WHEN status = 'resolved' THEN s_id END AS refers_to, CASE WHEN status = 'resolved' THEN s_date END AS refers_to_date,
       CASE WHEN status = 'resolved' THEN regexp_extract(s_http, '^([^\\r\\n]*)', 1) || E'\\r\\n' || array_to_string(
         [y.name || ': ' || y.value FOR y IN list_concat([x FOR x IN s_h IF NOT list_contains([m.name FOR m IN may], x.name)], may)],
         E'\\r\\n') || E'\\r\\n\\r\\n' END AS http,
       CASE WHEN status = 'resolved' THEN sha256(s_payload) END AS payload_sha256,
       CASE WHEN status = 'resolved' THEN length(s_payload) END AS payload_length
FROM t
"""


ORACLE = _oracle()
