"""Not-modified revisits against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from recordcheck.llm import warc as A

SCHEMA = "record_id string, warc_type string, target_uri string, warc_date string, http string, payload string, row string"


def response(i, url, date, etag=None, modified=None, payload="body", status=200, more=""):
    head = f"HTTP/1.1 {status} OK\r\nContent-Length: 4\r\nX-A: old\r\n{more}"
    head += f"ETag: {etag}\r\n" if etag else ""
    head += f"Last-Modified: {modified}\r\n" if modified else ""
    return (i, "response", url, date, head + "\r\n", payload, "own")


def revisit(i, url, date, etag=None, modified=None, status=304, more=""):
    head = f"HTTP/1.1 {status} Not Modified\r\ncontent-length: 0\r\n{more}"
    head += f"etag: {etag}\r\n" if etag else ""
    head += f"last-modified: {modified}\r\n" if modified else ""
    return (i, "revisit", url, date, head + "\r\n", None, "own")


def resolve(spark, rows):
    return {r["record_id"]: r for r in A.resolve_revisits(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}


def test_validators_and_headers(spark):
    day = "2024-03-01T00:00:%02dZ"
    u = "http://A.example.com:80/x?b=2&a=1"
    rows = [response("r1", u, day % 1, '"t1"', "Mon"), response("r2", "HTTP://a.example.com/x?a=1&b=2#f", day % 10, 'W/"t2"', "Tue"),
            revisit("v1", "http://u@a.example.com/x?a=1&b=2", day % 20, '"t2"', "no", more="X-A: new\r\nX-B: b\r\n"),
            revisit("v2", u, day % 5, '"t1"'), revisit("v3", u, day % 10, '"t1"'), revisit("v4", u, day % 1, '"t1"'),
            revisit("v5", u, day % 20, '"t1"'), revisit("v6", u, day % 20, modified="Tue"), revisit("v7", u, day % 20),
            revisit("v8", u, day % 20, '"t2"', status=200), revisit("v9", "not a url", day % 20, '"t2"'),
            revisit("v10", u, "bad date", '"t2"'), (None, None, None, None, None, None, None),
            ("v11", "revisit", None, None, None, None, None), response("r3", u, day % 15, '"t3"', status=404),
            response("r4", u, day % 16, '"t4"', payload=None), response("r2", "http://a.example.com/x?a=1&b=2", day % 10, 'W/"t2"', "Tue")]
    got = resolve(spark, rows)
    assert {k: v["status"] for k, v in got.items()} == {
        "v1": "resolved", "v2": "resolved", "v3": "resolved", "v4": "no_earlier", "v5": "mismatch", "v6": "resolved",
        "v7": "mismatch", "v8": "not_304", "v9": "no_earlier", "v10": "no_earlier", "v11": "not_304"}
    assert [got[v]["refers_to"] for v in ("v1", "v2", "v3", "v5")] == ["r2", "r1", "r1", None]
    head = got["v1"]["http"].split("\r\n")
    assert head[0] == "HTTP/1.1 200 OK" and "content-length: 4" in head and "x-a: new" in head and "x-b: b" in head
    assert "x-a: old" not in head and got["v1"]["payload"] == "body"


def test_as_of_against_a_loop(spark, monkeypatch):
    monkeypatch.setattr(A, "BUCKET", 50)
    monkeypatch.setattr(A, "PERIOD", 4)
    rng = random.Random(3)
    rows, fulls, asks = [], {}, []
    for i in range(400):
        url = "http://hot.example/" if i % 3 == 0 else f"http://h{i % 7}.example/"
        t = rng.randrange(900)
        date = f"2024-01-01T00:{t // 60:02d}:{t % 60:02d}Z"
        if rng.random() < 0.4:
            rows.append(response(f"r{i:03d}", url, date, payload=f"p{i}"))
            fulls.setdefault(url, []).append((t, f"r{i:03d}"))
        else:
            rows.append(revisit(f"v{i:03d}", url, date))
            asks.append((f"v{i:03d}", url, t))
    got = resolve(spark, rows)
    assert len(got) == len(asks)
    for v, url, t in asks:
        earlier = [f for f in fulls.get(url, []) if f[0] < t]
        assert got[v]["refers_to"] == (max(earlier)[1] if earlier else None)


def test_bitmap_loses_no_chosen_response(spark, monkeypatch):
    """Every chosen id passes, most others do not; with more ids than bits all pass."""
    every = spark.range(20000).select(F.concat(F.lit("r"), F.col("id")).alias("record_id"), "id")
    found = every.filter("id % 10 = 3").select(F.col("record_id").alias("refers_to"))
    got = {r["id"] for r in A._less_unwanted(every, found).collect()}
    assert {i for i in range(20000) if i % 10 == 3} <= got and len(got) < 20000 * 0.25
    monkeypatch.setattr(A, "MAX_BITS", 1 << 11)
    assert A._less_unwanted(every, found.limit(2000)).count() < 20000       # fuller, still exact
    assert A._less_unwanted(every, found.union(found)).count() == 20000
    monkeypatch.undo()
    assert A._less_unwanted(every, found.limit(0)).count() == 0


def test_query_really_chooses(spark):
    """Revisits with several earlier responses, one URL with a large share, every outcome."""
    from tests.conftest import SMALL

    records = A.archive_records(spark, SMALL).withColumn("url", A.canonical_url(F.col("target_uri")))
    earlier = (records.filter("warc_type = 'revisit'").alias("v").join(records.filter("warc_type = 'response'").alias("r"),
               F.expr("v.url = r.url AND r.warc_date < v.warc_date")).groupBy("v.record_id").count())
    n = spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert earlier.filter("count > 1").count() > n / 3
    assert records.groupBy("url").count().agg(F.max("count")).first()[0] > records.count() / 10
    got = {r["status"]: r["count"] for r in A.op4_warc_revisits(spark, SMALL).groupBy("status").count().collect()}
    assert set(got) == {"resolved", "no_earlier", "mismatch", "not_304"}
    assert sum(got.values()) == n and records.count() == 4 * n


@pytest.mark.parametrize("url,want", [
    ("HTTPS://Ex.com:443", "https://ex.com/"), ("http://ex.com:8080/A?", "http://ex.com:8080/A"), ("ftp://x/y#z", "ftp://x/y"),
    ("http://ex.com/?b&a&b", "http://ex.com/?a&b&b"), ("nonsense", None), (None, None), ("", None)])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(A.canonical_url(F.col("u")).alias("c")).first()["c"] == want


def test_empty_table(spark):
    assert A.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
