import pytest
from pyspark.sql import types as T

from tests.conftest import SMALL

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def docs_frame(spark, rows, extra=()):
    """rows: (doc_id, text, lang, source); ``extra``: columns whose names clash."""
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], DOCS).repartition(3)
    from pyspark.sql import functions as F

    return df.select("*", *[F.concat(F.lit("own-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(c)
                            for c in extra])


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    words = " ".join(f"word{i % 977}" for i in range(30_000))
    return [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (None, "null id text", "en", None),
            (None, "null id text", "en", None), (4, words, "en", "b"), (5, words, "de", "b"), (6, "short text here", "fr", "a"),
            (6, "short text here", "fr", "a"), (6, "another text with that id", "es", "a"), (7, "é" * 5000, "fr", "c"),
            (8, "1234 5678 !!!", "en", "c"), (9, "short text here", "en", "b")]


def by_id(rows):
    return {r["doc_id"]: r for r in rows}
