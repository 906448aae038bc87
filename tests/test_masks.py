"""Bit masks: layout, one trim per field, counters and totals from bits."""

import re

from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.operators import rules as R
from recordcheck.operators.evaluate import evaluate, layout_of
from recordcheck.operators.masks import BITS, Layout, with_masks
from recordcheck.operators.summary import RECORD_ID, SUMMARY_COLUMNS, executive_summary, mask_summary, with_summary
from recordcheck.plans.audit import Audit
from recordcheck.plans.catalog_party import party_catalog
from recordcheck.schema import OBS_COL


def test_layout_of_the_catalogue():
    cat = party_catalog()
    layout = Layout(cat.rules, cat.fields)
    assert layout.columns == ["_rc_n0", "_rc_b0", "_rc_f0"]
    bits = [layout.bit(n) for n in range(len(cat.rules))]
    assert len(set(bits)) == len(bits) == 171
    assert all(b.number < BITS for b in bits)
    extended = party_catalog(extended=True)
    assert Layout(extended.rules, extended.fields).columns[-2:] == ["_rc_f0", "_rc_f1"]


def test_one_trim_per_field():
    cat = party_catalog()
    text = " ".join(e for step in Layout(cat.rules, cat.fields).steps() for e in step.values())
    assert text.count("trim(") == len(K.FIELDS)
    assert len(re.findall(r"trim\(`(\w+)`\)", text)) == len(set(re.findall(r"trim\(`(\w+)`\)", text)))
    assert text.count("upper(") == len(set(re.findall(r"upper\(\w+\)", text)))


def test_plan_has_one_trim_per_field(party_small):
    cat = party_catalog()
    layout = layout_of(party_small, cat.rules, cat.fields)
    plan = with_masks(party_small, layout)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == len(K.FIELDS)


def test_more_fields_and_rules_than_one_word(spark):
    """200 fields, 400 state rules, 70 others over them."""
    fields = [f"F{i}" for i in range(200)]
    rows = [(r, *[None if (i * 7 + r) % 11 == 0 else "  " if (i * 3 + r) % 13 == 0 else f"v{i}" for i in range(200)]) for r in range(40)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{f} string" for f in fields))
    rules = [x for f in fields for x in (R.null_rule(f, K.TIPO_NULL, K.SEV_ALTA), R.blank_rule(f, K.TIPO_VACIO, K.SEV_ALTA))]
    rules += [R.required_if_any(fields[i], (fields[199 - i],), f"M{i}", K.TIPO_CONDICIONAL, K.SEV_ALTA, "X") for i in range(70)]
    rules.append(R.null_rule("F3", K.TIPO_OPCIONAL, K.SEV_BAJA, "Y"))        # the same state again
    layout = layout_of(df, rules, fields)
    assert len(layout.columns) == 4 + 4 + 2
    got = {r["k"]: r for r in with_summary(evaluate(df, rules, fields)).collect()}
    masked = {r["k"]: r for r in with_masks(df, layout).select("k", *mask_summary(layout)).collect()}
    for r, *cells in rows:
        empty = [c is None or not c.strip() for c in cells]
        want = []
        for i, c in enumerate(cells):
            want += [f"F{i}_NULL"] if c is None else [f"F{i}_VACIO"] if empty[i] else []
        want += [f"M{i}" for i in range(70) if not empty[199 - i] and empty[i]]
        want += ["F3_NULL"] if cells[3] is None else []
        assert [o["motivo"] for o in got[r][OBS_COL]] == want
        for c in SUMMARY_COLUMNS:
            assert masked[r][c] == got[r][c], c
        assert masked[r]["CANT_TOTAL_OBS"] == len(want)


def test_fold_equals_masks(party_small):
    cat = party_catalog()
    ev = evaluate(party_small, cat.rules, cat.fields).select("k", *RECORD_ID, OBS_COL)
    folded = executive_summary(with_summary(ev), ("k",))
    masked = Audit(party_small, keys=("k",), materialize=False).summary()
    assert folded.columns == masked.columns
    assert folded.exceptAll(masked).count() == 0 and masked.count() == folded.count()
    plan = with_summary(ev)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1 and "filter(" not in plan


def test_counts_without_generate(party_small):
    audit = Audit(party_small, keys=("k",))
    plan = audit.field_type_counts()._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "partial_sum" in plan
    want = (audit.detail(order="none").groupBy("CAMPO", "TIPO_VERIFICACION").count())
    got = audit.field_type_counts()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    none = Audit(party_small.limit(0), keys=("k",))
    assert none.field_counts().count() == 0 and none.top_fields().count() == 0


def test_names_of_masks_are_refused(party_small):
    cat = party_catalog()
    df = party_small.withColumn("_rc_n0", F.lit(1))
    try:
        evaluate(df, cat.rules, cat.fields)
        raised = False
    except ValueError:
        raised = True
    assert raised


def test_stored_masks_are_small(party_small):
    audit = Audit(party_small, keys=("k",))
    assert set(audit.masked.columns) == {"k", "CODIGO", "RAZON_SOCIAL", "NIT", "_rc_n0", "_rc_b0", "_rc_f0", "_rc_row_id"}


def test_detail_and_report_of_masks_equal_those_of_observations(party_small):
    from recordcheck.operators.detail import audit_report, detail

    cat = party_catalog(extended=True)
    ev = evaluate(party_small, cat.rules, cat.fields)
    audit = Audit(party_small, catalog=cat, keys=("k",), materialize=False)
    for got, want in ((audit.detail(order="none"), detail(ev, ("k",), order="none")),
                      (audit.report(order="none"), audit_report(ev, ("k",), order="none"))):
        assert got.columns == want.columns and got.count() == want.count()
        assert got.exceptAll(want).count() == 0


def test_texts_that_several_rules_read_are_made_once():
    """Regular expressions are much of a record's time; there were 136 of them."""
    cat = party_catalog()
    text = " ".join(e for step in Layout(cat.rules, cat.fields).steps() for e in step.values())
    assert text.count("RLIKE") + text.count("regexp_") < 90
    for made in ("regexp_replace(`TELEFONO`, '[^0-9]'", "regexp_replace(`NIT`, '[^0-9]'", "try_cast(regexp_extract(`IDENTIFICACION_CANT_INT_ALTA_GERENCIA`"):
        assert text.count(made) == 1


def test_bits_of_a_word_are_parsed_one_by_one():
    """Parentheses around parentheses took the parser seconds: it reads through a pair to
    its end before it knows what it is."""
    from recordcheck.operators.masks import OR

    cat = party_catalog()
    words = [e.split(OR) for step in Layout(cat.rules, cat.fields).steps() for c, e in step.items() if c[:5] in ("_rc_n", "_rc_b", "_rc_f")]
    assert [len(parts) - 1 for parts in words] == [54, 54, 63]
    assert all(p.startswith("if(") for parts in words for p in parts[:-1])
