"""Registered queries against their DuckDB oracle SQL (small scale)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tools.compare_oracle import TABLES, canon

CHECKED = ["dq_summary", "dq_report", "dq_detail", "dq_view_critical", "dq_totals", "dq_record_counts",
           "dq_top_fields", "dq_field_profile", "dq_category_avg", "r09_post_without_count",
           "r22_email_invalid", "r27_update_count", "r28_optional_text", "dq_dates", "pb08_double_locale",
           "dq_documents_text", "s13_tx_required_all", "dq_extended_obs", "snk1_detalle_observaciones"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    from oracle import oracle_queries
    from recordcheck.plans.queries import registry

    assert set(oracle_queries()) == set(registry())   # every audit query has an oracle
    assert set(registry()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(registry()) >= 100


def test_oracle_lists_are_its_own():
    """The comparison SQL knows the specification's lists without the library."""
    from oracle import spec
    from recordcheck import constants as K
    from recordcheck.plans.queries import FIELD_FUNCTIONS

    for name in ("FIELDS", "MANDATORY", "CONDITIONAL", "OPTIONAL_CONDITIONAL", "OPTIONAL", "REP_LEGAL_DEPENDENTS",
                 "PLACEHOLDER_WORDS", "KEYBOARD_RUNS", "KEYBOARD_RUNS_DRAFT", "ASCENDING_RUNS", "DESCENDING_RUNS"):
        assert getattr(spec, name) == getattr(K, name), name
    assert {n: tuple(f) for n, (_, f) in spec.FIELD_QUERIES.items()} == {n: tuple(f) for n, (_, _, f) in FIELD_FUNCTIONS.items()}


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert canon(df.columns, rows) == canon(d_cols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1500
    assert "CANT_TOTAL_OBS" in df.columns
