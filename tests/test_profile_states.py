"""Profile states: first codes by folding, merging over runs."""

import tempfile

import pytest
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.operators import profile as PF
from recordcheck.plans.audit import STATES, Audit, merged_profile


def first_codes(rows, field, null, k=K.EXAMPLE_CODES):
    hit = {r["CODIGO"] for r in rows if (r[field] is None if null else r[field] is not None and not r[field].strip(" "))
           and r["CODIGO"] is not None and r["CODIGO"].strip(" ")}
    return sorted(hit, key=lambda c: c.encode())[:k]


@pytest.mark.parametrize("examples", [1, 5, 9])
def test_first_codes_ascending(spark, party_small, examples):
    # a third of all records share one code; accents and case order by bytes
    df = party_small.withColumn("CODIGO", F.expr(
        "CASE WHEN k % 3 = 0 THEN 'C0' WHEN k % 5 = 0 THEN 'ñandú ' || k WHEN k % 7 = 0 THEN 'c' || k ELSE CODIGO END")).repartition(7)
    rows = df.collect()
    got = {r["campo"]: r for r in Audit(df, keys=("k",)).profile(examples).collect()}
    for f in ("CODIGO", "NIT", "TELEFONO", "OPERACION_ASOCIADA_ALTA", "CANTIDAD_ACTUALIZACIONES"):
        assert got[f]["CODIGOS_NULL_EJEMPLO"] == first_codes(rows, f, True, examples)
        assert got[f]["CODIGOS_VACIO_EJEMPLO"] == first_codes(rows, f, False, examples)


def test_profile_plan_has_no_sort_and_reads_masks_only(party_small):
    plan = Audit(party_small, keys=("k",)).profile_states()._jdf.queryExecution().executedPlan().toString()
    assert " Sort " not in plan and "Window" not in plan and "Generate" not in plan and "SortAggregate" not in plan
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(read) == 1 and "CODIGO:" in read[0] and "_rc_n0" in read[0] and "NIT" not in read[0]


def test_states_of_parts_merge_to_the_whole(spark, party_small):
    root = tempfile.mkdtemp(prefix="rc-runs-")
    runs = []
    for part in range(3):
        with Audit(party_small.filter(F.col("k") % 3 == part), keys=("k",)) as audit:
            runs.append(audit.write(root, run_id=f"p{part}"))
    with Audit(party_small, keys=("k",)) as whole:
        want = sorted(map(tuple, whole.profile().collect()))
    assert sorted(map(tuple, merged_profile(spark, runs).collect())) == want
    # merging is associative: merged states are states
    states = [spark.read.schema(PF.STATE_SCHEMA).parquet(f"{r}/{STATES}") for r in runs]
    twice = PF.merge_states(PF.merge_states(states[0].unionByName(states[1])).unionByName(states[2]))
    assert sorted(map(tuple, PF.profile_of_states(twice, K.FIELDS).collect())) == want
    # and reads no record
    plan = merged_profile(spark, runs)._jdf.queryExecution().optimizedPlan().toString()
    assert "estado" in plan and "CODIGO#" not in plan


def test_empty_runs(spark, party_small):
    got = {r["campo"]: r for r in Audit(party_small.limit(0), keys=("k",)).profile().collect()}
    assert len(got) == 54 and got["NIT"]["CANT_NULL"] == 0 and got["NIT"]["PCT_NULL"] is None
    assert got["NIT"]["CODIGOS_NULL_EJEMPLO"] == [] and got["NIT"]["CALIDAD_CAMPO"] is None


def test_names_of_states_are_constants(party_small):
    """A table of them, made from a Python list, took Python workers and a join."""
    plan = Audit(party_small, keys=("k",)).profile_states()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ExistingRDD" not in plan and "LocalTableScan" not in plan
