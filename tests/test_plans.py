"""Plan shape: the evaluation is one narrow projection and the derived
outputs never re-evaluate the rules inside a pushed-down filter."""

from pyspark.sql import functions as F

from recordcheck.operators.detail import detail
from recordcheck.operators.evaluate import evaluate
from recordcheck.plans.audit import Audit
from recordcheck.plans.catalog_party import party_catalog
from recordcheck.plans.queries import _audit, _party
from recordcheck.sources.fixtures import party
from tests.conftest import SMALL


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_evaluation_is_one_projection_without_shuffle(party_small):
    cat = party_catalog()
    ev = evaluate(party_small, cat.rules, cat.fields)
    plan = physical(ev)
    assert "Exchange" not in plan
    lines = optimized(ev).splitlines()
    assert sum(1 for line in lines if "flatten(" in line) == 1
    # trimmed texts, field bits, rule bits, observations
    assert sum(1 for line in lines if "Project" in line and "_rc_" in line) <= 5


def test_detail_does_not_push_rules_into_a_filter(party_small):
    cat = party_catalog()
    ev = evaluate(party_small, cat.rules, cat.fields)
    plan = optimized(detail(ev, ("k",), order="none"))
    for line in plan.splitlines():
        if line.strip().lstrip("+-: ").startswith("Filter"):
            assert "flatten(" not in line, line


def test_views_read_the_materialized_table(party_small):
    a = Audit(party_small, keys=("k",))
    plan = optimized(a.critical())
    assert "flatten(" not in plan          # rules are not re-planned
    assert "Relation" in plan and "parquet" in plan


def test_profile_reads_masks_only(party_small):
    plan = physical(Audit(party_small, keys=("k",)).profile())
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(read) == 1 and "CODIGO:" in read[0] and "_rc_n0" in read[0]
    assert "NIT" not in read[0] and "TELEFONO" not in read[0]
    assert "Window " not in plan and "SortAggregate" not in plan and " Sort [" not in plan


def test_scored_table_stores_no_audited_column(party_small):
    a = Audit(party_small, keys=("k",))
    kept = {"k", "CODIGO", "RAZON_SOCIAL", "NIT"}
    assert set(a.masked.columns) & set(party_small.columns) == set(a.scored.columns) & set(party_small.columns) == kept
    # written in one pass over the source
    lazy = physical(Audit(party_small, keys=("k",), materialize=False).masked)
    assert lazy.count("FileScan") == 1 and "Exchange" not in lazy


def test_building_an_audit_starts_no_job(spark, party_small):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit-build", "build")
    try:
        a = Audit(party_small.repartition(3).groupBy("k").agg(F.first("NIT").alias("NIT")).join(party_small.drop("NIT"), "k"),
                  keys=("k",), materialize=False)
        a.summary(), a.critical(), a.profile(), a.report(order="none")
        assert not tracker.getJobIdsForGroup("audit-build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_views_of_registered_queries_do_not_repeat_the_rules(spark):
    from recordcheck.plans.queries import registry
    from tests.conftest import SMALL

    plan = optimized(registry()["dq_view_critical"](spark, SMALL))
    for line in plan.splitlines():
        if line.strip().lstrip("+-: ").startswith("Filter"):
            assert "flatten(" not in line, line


def test_record_lookup_filters_the_source(spark):
    from recordcheck.plans.queries import registry
    from tests.conftest import SMALL

    plan = optimized(registry()["dq_record_lookup"](spark, SMALL))
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "flatten(" in line)
    below = "\n".join(lines[at + 1:])
    assert "Filter" in below and "C7" in below       # the code is tested under the rules


def test_field_counts_are_partially_aggregated(party_small):
    plan = physical(Audit(party_small, keys=("k",)).top_fields())
    assert "partial_sum" in plan


def test_fixture_reads_only_the_key_column(party_small):
    plan = physical(party_small)
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_sorted_detail_spreads_a_hot_code(spark, party_small):
    # a third of all records share one code
    hot = party_small.withColumn("CODIGO", F.when(F.col("k") % 3 == 0, F.lit("XXXX")).otherwise(F.col("CODIGO")))
    det = Audit(hot, keys=("k",)).detail(order="global")
    assert "_rc_row_id" not in det.columns
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")   # small test data: keep the range partitions apart
    try:
        sizes = [r["n"] for r in det.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset(key)
    assert len(sizes) > 1
    assert max(sizes) < 0.5 * sum(sizes)      # the hot third is not in one partition
    codes = [r["CODIGO"] for r in det.select("CODIGO").collect()]
    assert codes == sorted(codes, key=lambda c: (c is not None, c))   # still globally ordered (NULLs first)


def test_long_projections_stay_out_of_fused_methods(spark):
    """Fused, a projection of dozens of branches is one method too long for the
    JVM to compile (a default session fuses)."""
    session = spark.newSession()
    session.conf.set("spark.sql.codegen.wholeStage", "true")
    src = party(session, SMALL)
    audit = Audit(src, keys=("k",), materialize=False)
    cat = party_catalog()
    for df in (src, audit.masked, audit.summary(), audit.detail(order="none"), evaluate(src, cat.rules, cat.fields)):
        long = [line for line in physical(df).splitlines()
                if sum(line.count(x) for x in ("if (", "CASE WHEN", "element_at(")) > 30]
        assert long
        assert not [line[:60] for line in long if line.lstrip(" :+-").startswith("*(")]


def test_texts_of_observations_follow_the_sort(party_small):
    """Neither the sample of the range sort nor its shuffle carries constants of a rule."""
    audit = Audit(party_small, keys=("k",), materialize=False)
    for df in (audit.detail(), audit.report(), audit.detail(order="range"), audit.report(order="range")):
        lines = optimized(df).splitlines()
        sort = next(i for i, line in enumerate(lines) if "Sort [" in line)
        assert any("AS CAMPO#" in line for line in lines[:sort])
        assert not any("AS DESCRIPCION#" in line for line in lines[sort:])


def test_keys_of_one_row_group_are_dealt_to_many_tasks(spark, tmp_path):
    """A scan gives a row group to one task, which then ran every rule on it alone."""
    keys = [None, *range(2000), 7, 7]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    whole, dealt = party(spark, str(tmp_path)), _party(spark, str(tmp_path))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.5 * len(keys)
    assert dealt.columns == whole.columns and dealt.count() == len(keys)
    assert dealt.exceptAll(whole).count() == 0
    with _audit(spark, str(tmp_path), materialize=True) as audit:
        assert audit.masked.groupBy(F.input_file_name()).count().count() > 1
