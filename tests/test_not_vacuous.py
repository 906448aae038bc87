"""Every registered check tells records apart: its boolean columns have both
values over the test input, and the views over the profile have rows."""

import pytest
from pyspark.sql import functions as F

from recordcheck.plans.queries import FIELD_FUNCTIONS, registry
from tests.conftest import MEDIUM

# Texts of the small tables hold no placeholder word and none is empty.
CONSTANT = {"TIENE_PALABRA_INVALIDA", "VACIO"}


@pytest.mark.parametrize("name", [*FIELD_FUNCTIONS, "dq_seq_repeat", "dq_numeric_text", "dq_dates"])
def test_booleans_have_both_values(spark, name):
    df = registry()[name](spark, MEDIUM)
    flags = [c for c, t in df.dtypes if t == "boolean" and c not in CONSTANT]
    if flags:
        row = df.agg(*[F.count_if(F.col(c)).alias(f"t{i}") for i, c in enumerate(flags)],
                     *[F.count_if(~F.col(c)).alias(f"f{i}") for i, c in enumerate(flags)]).first()
        bad = [c for i, c in enumerate(flags) if not row[f"t{i}"] or not row[f"f{i}"]]
        assert not bad
    else:
        row = df.agg(*[F.count_distinct(c).alias(c) for c, _ in df.dtypes if c != "k"]).first()
        assert all(row)


@pytest.mark.parametrize("name", ["dq_critical_fields", "dq_null_above", "dq_mandatory_below", "dq_excellent_fields",
                                  "dq_documents_email", "dq_documents_phone", "s13_tx_required_all"])
def test_views_have_rows(spark, name):
    assert registry()[name](spark, MEDIUM).count() > 0
