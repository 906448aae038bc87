"""Invariants of the audit outputs on the sf0.001 party table."""

from pyspark.sql import functions as F

from recordcheck.operators.summary import COUNTERS, TOTAL
from recordcheck.plans.audit import Audit


def test_total_is_sum_of_counters(spark, party_small):
    # A filter on counters reads the materialized evaluation (the default).
    s = Audit(party_small, keys=("k",)).summary()
    bad = s.filter(sum(F.col(n) for n, _ in COUNTERS) != F.col(TOTAL)).count()
    assert bad == 0


def test_detail_rows_equal_total_observations(spark, party_small):
    a = Audit(party_small, keys=("k",))
    totals = a.type_totals().collect()[0]
    assert a.detail(order="none").count() == totals["TOTAL_OBSERVACIONES"]
    assert a.report(order="none").count() == totals["TOTAL_OBSERVACIONES"]


def test_clean_and_detail_keys_cover_all_records(spark, party_small):
    a = Audit(party_small, keys=("k",))
    clean = {r.k for r in a.clean().select("k").collect()}
    flagged = {r.k for r in a.detail(order="none").select("k").distinct().collect()}
    everyone = {r.k for r in party_small.select("k").collect()}
    assert not clean & flagged
    assert clean | flagged == everyone


def test_profile_totals_match_type_totals(spark, party_small):
    a = Audit(party_small, keys=("k",))
    p = a.profile().agg(F.sum("CANT_NULL").alias("n"), F.sum("CANT_VACIO").alias("v"), F.count("*").alias("c"))
    row, totals = p.collect()[0], a.type_totals().collect()[0]
    assert row["c"] == 54
    assert row["n"] == totals["TOTAL_NULL"]
    assert row["v"] == totals["TOTAL_VACIO"]


def test_record_counts(spark, party_small):
    a = Audit(party_small, keys=("k",))
    r = a.record_counts().collect()[0]
    assert r["TOTAL_REGISTROS"] == 1500
    assert r["REGISTROS_CON_OBS"] + r["REGISTROS_LIMPIOS"] == 1500
    assert r["PCT_CON_OBS"] == round(100 * r["REGISTROS_CON_OBS"] / 1500, 2)


def test_partition_count_does_not_change_results(spark, party_small):
    a = Audit(party_small.repartition(3), keys=("k",), spread=3).summary()
    b = Audit(party_small.repartition(7), keys=("k",)).summary()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_top_fields_is_bounded_and_sorted(spark, party_small):
    rows = Audit(party_small, keys=("k",)).top_fields().collect()
    assert len(rows) == 10
    counts = [r["count"] for r in rows]
    assert counts == sorted(counts, reverse=True)


def test_profile_examples_are_distinct_and_filled(spark, party_small):
    hot = party_small.withColumn("CODIGO", F.when(F.col("k") % 3 == 0, F.lit("XXXX")).otherwise(F.col("CODIGO")))
    a = Audit(hot, keys=("k",))
    cells = {r["k"]: r.asDict() for r in hot.collect()}
    for row in a.profile().collect():
        for column, test in (("CODIGOS_NULL_EJEMPLO", lambda v: v is None),
                             ("CODIGOS_VACIO_EJEMPLO", lambda v: v is not None and not v.strip(" "))):
            codes = row[column]
            assert len(codes) == len(set(codes)) <= 5
            assert all(c.strip(" ") for c in codes)
            having = {r["CODIGO"] for r in cells.values() if test(r[row["campo"]])}
            assert set(codes) <= having
            if len({c for c in having if c and c.strip(" ")}) >= 100:
                assert len(codes) == 5
    assert len(a.profile(examples=2).first()["CODIGOS_NULL_EJEMPLO"]) <= 2
