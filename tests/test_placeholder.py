"""The placeholder check over the pieces of all documents."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tools.compare_oracle import canon


@pytest.mark.parametrize("planted", [False, True])
def test_pieces_match_the_oracle(spark, tmp_path, planted):
    """The test documents hold no placeholder word, so some are planted."""
    folder = SMALL
    if planted:
        folder = str(tmp_path)
        texts = ["value n/a here", "plain words\nNULL", "", None, "desconocido", "s/n  sn", "banana"]
        pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "lang": ["es"] * len(texts),
                                 "source": ["a"] * len(texts)}), f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    df = E.queries()["dq_documents_placeholder"](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()["dq_documents_placeholder"])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, rows) == canon(cols, res.fetchall())
    if planted:
        assert {r[2] for r in rows} == {True, False}
