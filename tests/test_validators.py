"""Validator and parser goldens (value -> expected)."""

import pytest
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.functions import predicates as P
from recordcheck.functions import validators as V


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(F.expr(fn("v"))).collect()]


def check(spark, fn, cases):
    values = [v for v, _ in cases]
    got = run(spark, fn, values)
    for (v, want), g in zip(cases, got):
        assert g == want, f"{fn.__name__}({v!r}) = {g!r}, want {want!r}"


def test_v1_placeholder(spark):
    yes = ["NA", "N/A", "S/N", "na-1", " na", "sin información", "Sin Informacion", "Compañía NA SRL",
           "NO APLICA", "dato no disponible"]
    no = ["Banana", "Ana", "doña", "peña", "ñna", "na_x", "SIN INFORMACIÓN", "NO PROVEÍDO", None, "   "]
    check(spark, V.has_placeholder, [(v, True) for v in yes] + [(v, False) for v in no])


def test_v1_unicode_case_option(spark):
    pat = V.placeholder_pattern(unicode_case=True)
    got = run(spark, lambda c: V.has_placeholder(c, pat), ["SIN INFORMACIÓN", "Banana"])
    assert got == [True, False]


def test_v2_email(spark):
    check(spark, V.email_invalid, [
        ("juan.perez@acme.bo", False), ("ab@acme.bo", True), ("juan@acme", True), ("sin correo", True),
        ("12345@acme.bo", True), ("jaaaan@acme.bo", True), ("jaAAan@acme.bo", True), (None, False), ("  ", False),
    ])


def test_v3_phone(spark):
    check(spark, V.phone_invalid, [
        ("77712345", False), ("7771234", False), ("77777777", True), ("123", True), ("abc", True),
        ("+591 77712345", True), (None, False),
    ])


def test_v4_tax_id(spark):
    check(spark, V.nit_invalid, [
        ("10203021", False), ("1020304015", False), ("1020302", True), ("102030100", True),
        ("1020304055", True), ("1020-304015", True), ("A102030", True), ("10203 04015", False), (None, False),
    ])


def test_v5_address(spark):
    check(spark, V.address_invalid, [
        ("AVENIDA AMERICA ZONA NORTE", False), ("12", True), ("12345678", True), ("CALLE S/N", True),
        ("CASA", True), (None, False),
    ])


def test_v6_free_text(spark):
    check(spark, V.text_invalid, [
        ("Comercial Andina SRL", False), ("XX", True), ("LP", True), ("sa", True), ("12345", True),
        ("AAAA SRL", True), ("peñaaaa", True), ("ababab", True), ("ABCABCABC", True), ("ABAB", False),
        ("BCDF", True), ("qwerty sa", True), ("no aplica", True), (None, False), ("   ", False),
    ])


def test_v7_numeric_sequence(spark):
    check(spark, V.numeric_sequence, [
        ("1111", True), ("1234", True), ("9876", True), ("8901", True), ("5791", False), ("13579", False),
        ("0901", False), ("11112", False), ("123", False), (None, False),
    ])


def test_v8_repeated_letters(spark):
    check(spark, V.repeated_letters, [("ZZZZ", True), ("ñññña", True), ("ZZZ", False), (None, False)])


def test_pb7_pb8_to_double(spark):
    cases = [("1.234,56", None, 1234.56), ("1,234.56", None, 1234.56), ("1,234,567", None, 1234.567),
             ("1.234.567", None, 1234.567), ("-5", -5.0, -5.0), ("5-", None, 5.0), ("(100)", 100.0, 100.0),
             ("Bs 2.500,00", None, 2500.0), ("-", None, 0.0), ("", None, None), ("abc", None, None)]
    values = [v for v, _, _ in cases]
    simple = run(spark, P.to_double_simple, values)
    locale = run(spark, P.to_double_locale, values)
    for (v, want_s, want_l), s, l in zip(cases, simple, locale):
        assert s == want_s, (v, s)
        assert l == pytest.approx(want_l) if want_l is not None else l is None, (v, l)


def test_pb9_legacy_int(spark):
    check(spark, P.legacy_int, [
        ("3", 3), ("3.5", 3), (" 4 ", 4), ("-1", -1), ("+7", 7), (".5", 0), ("abc", None), ("1e2", None),
        ("", None), ("99999999999", None), ("5.", 5), ("-", None), ("\t4\t", 4), ("00012", 12),
        (" -3.9 ", -3), ("2147483647", 2147483647), ("2147483648", None),
    ])


def test_pb13_bad_dates(spark):
    check(spark, P.is_bad_date, [
        ("15/03/2025", False), ("00/00/0000", True), ("31/12/9999", True), ("01/01/1800", True),
        ("31/02/2024", True), ("10/01/2026", True), ("   ", True), (None, True), ("1/2/2024", False), ("2024-02-01", True),
    ])


def test_pb1_to_pb4(spark):
    vals = [None, "", "   ", "\t", " x "]
    assert run(spark, P.is_null, vals) == [True, False, False, False, False]
    assert run(spark, P.is_blank, vals) == [False, True, True, False, False]
    assert run(spark, P.is_empty, vals) == [True, True, True, False, False]
    assert run(spark, P.is_filled, vals) == [False, False, False, True, True]


def test_results_do_not_depend_on_ansi_mode(spark):
    vals = ["3.5", "abc", " 4 ", "1.234,56", "31/02/2024", "15/03/2025", None, "-", "99999999999"]
    fns = [P.legacy_int, P.to_double_simple, P.to_double_locale, P.is_bad_date, P.parsed_date]
    before = spark.conf.get("spark.sql.ansi.enabled")
    got = {}
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            got[ansi] = [run(spark, fn, vals) for fn in fns]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got["true"] == got["false"]


def test_pb12_dates_as_the_audit_reads_them(spark):
    import datetime as dt

    cases = [("5/3/2024", dt.date(2024, 3, 5)), ("05/3/2024", dt.date(2024, 3, 5)), (" 15/03/2025", dt.date(2025, 3, 15)),
             ("15/03/2025 ", dt.date(2025, 3, 15)), ("15/03/2025 10:00", dt.date(2025, 3, 15)), ("15/03/25", dt.date(25, 3, 15)),
             ("15/ 3/2025", dt.date(2025, 3, 15)), ("015/003/2025", dt.date(2025, 3, 15)), ("15/03/2025abc", dt.date(2025, 3, 15)),
             ("31/02/2024", None), ("00/00/0000", None), ("115/03/2025", None), ("15 /03/2025", None), ("x15/03/2025", None),
             ("29/02/2023", None), ("29/02/2024", dt.date(2024, 2, 29)), ("", None), (None, None)]
    check(spark, P.parsed_date, cases)
    check(spark, lambda c: P.parsed_date(c, strict=True),
          [(v, want if v in ("29/02/2024",) else None) for v, want in cases])


def test_pb8_signs_and_marks(spark):
    cases = [("-5", -5.0), (",-5", 0.5), (",-5.0", -5.0), ("5-", 5.0), ("--5", -5.0), ("1.234.567", 1234.567), ("1,2,3", 12.3),
             (".", 0.0), ("..", 0.0), (",", 0.0), ("-", 0.0), ("--", 0.0), ("-.", None), (".-", 0.0), ("5.", 5.0), (".5", 0.5),
             ("-.5", -0.5)]
    check(spark, P.to_double_locale, cases)


def test_pb9_signs_marks_and_edges(spark):
    check(spark, P.legacy_int, [
        (".", 0), ("+.", 0), ("-.5", 0), ("+", None), ("\x00-7.\n", -7), ("5 .", None), ("5\u2028", None), ("5 \u2028", None),
        ("\n \t", None), ("\u0663", None), ("--3", None), ("+0", 0), ("-2147483648", -2147483648), ("-2147483649.9", None),
    ])


def test_v6_repeats_and_vowels_like_the_separate_searches(spark):
    texts = ["AAAA", "xaaaay", "aaa", "1111", "a\n\n\n\nb", "\n\n\n\n", "ABABAB", "ABAB", "ABCABCABC\n", "ABCABCABC", "AbcaBcabC", "12121", "121212",
             "ÁÁÁÁ", "bcd", "bcü", "b1c", "ñññ", "12\u0663", "007", " 12 ", "1 2", "-12", "\U0001f600\U0001f600\U0001f600\U0001f600", "ZZZ", "Ú23", "xyz\u2028"]
    s, letters = P.upper_trim("v"), P.regexp_replace(P.upper_trim("v"), f"[^{K.LETTERS_CLASS}]", "")
    parts = ["length(trim(v)) < 3", f"NOT {P.rlike('v', '[^0-9]')}", P.rlike(s, K.TEXT_REPEAT), P.rlike(s, K.UNIT_REPEAT), V.keyboard_run("v"),
             f"(NOT {P.rlike(s, f'[{K.VOWELS_CLASS}]')} AND length({letters}) >= 3)", P.rlike("v", V.PLACEHOLDER_RE)]
    df = spark.createDataFrame([(t,) for t in [*texts, None, "", "  "]], "v string")
    rows = df.select("v", F.expr(V.text_invalid("v")).alias("now"), F.expr(f"({P.is_filled('v')} AND ({' OR '.join(parts)}))").alias("was")).collect()
    assert [(r["v"], r["now"]) for r in rows] == [(r["v"], r["was"]) for r in rows]
    assert {r["now"] for r in rows} == {True, False}
