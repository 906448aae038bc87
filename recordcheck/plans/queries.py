"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them audit the whole ``party`` table built from ``orders`` (one row
per order), so their work grows with the data.  Counters are cast to BIGINT
and array columns joined to text so results compare cleanly against SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.functions import predicates as P
from recordcheck.functions import validators as V
from recordcheck.operators import profile as PF
from recordcheck.operators import views as VW
from recordcheck.operators.detail import detail as detail_rows
from recordcheck.operators.evaluate import evaluate
from recordcheck.operators.summary import COUNTERS, RECORD_ID, TOTAL, executive_summary, with_summary
from recordcheck.plans.audit import Audit, merged_profile
from recordcheck.plans.catalog_party import party_catalog
from recordcheck.schema import OBS_COL
from recordcheck.sources.delimited import read_quarantined
from recordcheck.sources.fixtures import party
from recordcheck.sources.storage import lookup, scratch_path
from recordcheck.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ("k",)
LOOKUP_CODE = "C7"          # EX2 / EX3 example record code
ONE_FIELD = "TELEFONO_REP_LEGAL"  # PF9 single-field lookup


TASKS_PER_CORE = 4          # records cost unequal time


def _party(spark: SparkSession, sf_dir: str) -> DataFrame:
    return party(spark, sf_dir, "orders", tasks=TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def _audit(spark: SparkSession, sf_dir: str, materialize: bool = False) -> Audit:
    return Audit(_party(spark, sf_dir), keys=KEYS, materialize=materialize)


def _bigint_counters(df: DataFrame) -> DataFrame:
    counters = {n for n, _ in COUNTERS} | {TOTAL}
    return df.select(*[F.col(c).cast("long").alias(c) if c in counters else F.col(c) for c in df.columns])


def _joined_arrays(df: DataFrame) -> DataFrame:
    return df.select(*[F.array_join(c, ", ").alias(c) if c.startswith("CODIGOS_") else F.col(c)
                       for c in df.columns])


# Observation rows of selected rule families ----------------------------------

def observations(spark: SparkSession, sf_dir: str, families: Sequence[str],
                 extended: bool = False) -> DataFrame:
    """(k, IDX_CAMPO, CAMPO, TIPO_VERIFICACION, SEVERIDAD, DESCRIPCION) for
    every observation the given families raise."""
    src = _party(spark, sf_dir)
    cat = party_catalog(src.columns, extended=extended).only(*families)
    ev = evaluate(src, cat.rules, cat.fields)
    return detail_rows(ev, KEYS, order="none").drop("CODIGO", "RAZON_SOCIAL", "NIT")


def _families(*fams: str) -> Query:
    return lambda spark, sf: observations(spark, sf, fams)


GROUPS = {
    "dq_null_blank_obs": ("R1", "R2"),
    "dq_mandatory_obs": ("R3", "R4", "R5", "R6"),
    "dq_dependency_obs": tuple(f"R{i}" for i in range(7, 17)),
    "dq_domicile_obs": ("R17", "R18"),
    "dq_mutual_required_obs": ("R19", "R20", "R21"),
    "dq_contact_format_obs": ("R22", "R23", "R24"),
    "dq_at_least_one_obs": ("R25", "R26", "R27"),
    "dq_optional_text_obs": ("R28",),
}

RULE_SLUGS = {
    "R1": "null", "R2": "blank", "R3": "mandatory_missing", "R4": "mandatory_placeholder",
    "R5": "nit_format", "R6": "company_name_text", "R7": "mgmt_count_without_post",
    "R8": "mgmt_count_without_names", "R9": "post_without_count", "R10": "post_without_names",
    "R11": "names_without_count", "R12": "names_without_post", "R13": "doc_type_required",
    "R14": "doc_number_required", "R15": "rep_dependents_required", "R16": "spouse_required",
    "R17": "address_invalid", "R18": "home_address_invalid", "R19": "tx_date_required",
    "R20": "tx_account_required", "R21": "tx_channel_required", "R22": "email_invalid",
    "R23": "rep_phone_invalid", "R24": "phone_invalid", "R25": "rep_code_required",
    "R26": "at_least_one_reference", "R27": "update_count", "R28": "optional_text",
}


def rule_query_name(fam: str) -> str:
    return f"r{int(fam[1:]):02d}_{RULE_SLUGS[fam]}"


# Summary, detail, report -------------------------------------------------------

def dq_summary(spark, sf):
    """SM1..SM10 + OUT1 for every record."""
    return _bigint_counters(_audit(spark, sf).summary())


def dq_detail(spark, sf):
    """OUT2 + SO1: one row per observation, ordered by CODIGO, IDX_CAMPO.
    The global sort samples its input first, so it reads the materialized
    evaluation instead of running the rules twice."""
    return _audit(spark, sf, materialize=True).detail(order="global")


def dq_report(spark, sf):
    """OUT3 (REGLA, friendly DESCRIPCION) + SO1."""
    return _audit(spark, sf, materialize=True).report(order="global")


# Views -----------------------------------------------------------------------------

def _fenced(df: DataFrame) -> DataFrame:
    """The same rows through a one-row generator: a filter on top of it stays
    there.  Below it Spark would substitute the whole rule array into the
    condition once per counter named."""
    row = F.array(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(F.explode_outer(row).alias("_r")).select("_r.*")


def _view(fn) -> Query:
    return lambda spark, sf: fn(_fenced(_bigint_counters(_audit(spark, sf).summary())))


dq_view_critical = _view(VW.critical_records)
dq_view_dependency = _view(VW.dependency_records)
dq_view_inconsistent = _view(VW.inconsistent_records)
dq_view_clean = _view(VW.clean_records)
dq_missing_mandatory = _view(VW.missing_mandatory)
dq_bad_nit = _view(VW.bad_tax_id)


def dq_heavy_records(spark, sf):
    """SO4: records with more than 10 observations, most first.  The order
    samples its input, so it reads the materialized evaluation."""
    return _bigint_counters(_audit(spark, sf, materialize=True).heavy_records())


def _one_record(spark, sf) -> Audit:
    """The audit of the records with one code: the code passes through
    untouched, so the source is filtered before any rule runs."""
    return Audit(_party(spark, sf).filter(F.col("CODIGO") == LOOKUP_CODE), keys=KEYS, materialize=False)


def dq_record_lookup(spark, sf):
    """EX2: detail rows of one record code."""
    return VW.record_lookup(_one_record(spark, sf).detail(order="local"), LOOKUP_CODE)


def dq_report_lookup(spark, sf):
    """EX3: report rows of one record code."""
    return VW.record_lookup(_one_record(spark, sf).report(order="local"), LOOKUP_CODE)


def _report_filter(fn, value) -> Query:
    return lambda spark, sf: fn(_audit(spark, sf).report(order="none"), value)


dq_report_null_type = _report_filter(VW.by_type, K.TIPO_NULL)
dq_report_conditional_type = _report_filter(VW.by_type, K.TIPO_CONDICIONAL)
dq_report_depends = _report_filter(VW.by_rule_category, "DEPENDE_DE")
dq_report_format = _report_filter(VW.by_rule_category, "FORMATO")


# Totals and counts --------------------------------------------------------------

def dq_totals(spark, sf):
    """AG3: global sums per observation type."""
    return _audit(spark, sf).type_totals()


def dq_record_counts(spark, sf):
    """AG1 + AG2: records, with observations, clean, and percents."""
    return _audit(spark, sf).record_counts()


def dq_field_counts(spark, sf):
    """AG4: observations per field."""
    return _audit(spark, sf).field_counts()


def dq_top_fields(spark, sf):
    """SO2: top 10 fields by observations (ties by name)."""
    return _audit(spark, sf).top_fields()


def dq_field_type_counts(spark, sf):
    """AG5: observations per field and type."""
    return _audit(spark, sf).field_type_counts()


# Per-field profile ------------------------------------------------------------

def _profile(spark, sf) -> DataFrame:
    return _audit(spark, sf).profile()


def dq_field_profile(spark, sf):
    """PF1..PF7 (example codes joined to text)."""
    return _joined_arrays(_profile(spark, sf))


def _profile_view(fn, *args) -> Query:
    return lambda spark, sf: _joined_arrays(fn(_profile(spark, sf), *args))


dq_worst_fields = _profile_view(PF.worst_fields, 10)
dq_critical_fields = _profile_view(PF.critical_fields)
dq_mandatory_below = _profile_view(PF.mandatory_below, 95)
dq_null_above = _profile_view(PF.null_above, 20)
dq_excellent_fields = _profile_view(PF.excellent_fields)
dq_one_field = _profile_view(PF.one_field, ONE_FIELD)


def dq_category_avg(spark, sf):
    """PF10: average percents per category."""
    return PF.category_averages(_profile(spark, sf))


# Field-level parsers and validators ----------------------------------------------

DATE_FIELDS = ("FECHA_ULTIMA_TRANSACCION", "FECHA_NACIMIENTO_REP_LEGAL", "FECHA_INGRESO_TRABAJO_REP_LEGAL",
               "FECHA_INGRESO_TRAB_REP_LEGAL", "FECHA_ALTA", "FECHA_ULTIMA_ACTUALIZACION")
INCOME = ("NIVEL_INGRESOS_REP_LEGAL", "NIVEL_INGRESOS_REP_LEGAL_SUS")
NUMERIC_OPTIONAL = ("NUMERO_REGISTRO", "NIT_REP_LEGAL")


def _field_checks(spark, sf, exprs: dict[str, str]) -> DataFrame:
    return _party(spark, sf).select("k", *[F.expr(e).alias(name) for name, e in exprs.items()])


def dq_numeric_text(spark, sf):
    """PB5..PB11 on every record: upper/trim, digits, the two double parsers,
    the non-ANSI integer parse and the number tests."""
    exprs = {"RAZON_SOCIAL_UPPER": P.upper_trim("RAZON_SOCIAL"), "NIT_DIGITOS": P.only_digits("NIT")}
    for f, tag in zip(INCOME, ("ING", "SUS")):
        exprs[f"{tag}_SIMPLE"] = P.to_double_simple(f)
        exprs[f"{tag}_LOCALE"] = P.to_double_locale(f)
        exprs[f"{tag}_NO_NEGATIVO"] = P.is_nonneg_number(f)
        exprs[f"{tag}_POSITIVO"] = P.is_positive_number(f)
    exprs["CANT_GERENCIA_INT"] = P.legacy_int("IDENTIFICACION_CANT_INT_ALTA_GERENCIA")
    exprs["CANT_GERENCIA_POSITIVA"] = P.is_positive_int("IDENTIFICACION_CANT_INT_ALTA_GERENCIA")
    exprs["CANT_ACTUALIZACIONES_INT"] = P.legacy_int("CANTIDAD_ACTUALIZACIONES")
    return _field_checks(spark, sf, exprs)


def dq_seq_repeat(spark, sf):
    """V7..V10: digit runs / repeats and repeated letters on every record."""
    exprs = {}
    for f in NUMERIC_OPTIONAL + ("TELEFONO", "TELEFONO_REP_LEGAL"):
        exprs[f"V7_{f}"] = V.numeric_sequence(f)
    for f in ("RAZON_SOCIAL",) + K.OPTIONAL[:6]:
        exprs[f"V8_{f}"] = V.repeated_letters(f)
        exprs[f"V9_{f}"] = V.optional_text_inconsistent(f)
    for f in NUMERIC_OPTIONAL:
        exprs[f"V10_{f}"] = V.optional_number_inconsistent(f)
    return _field_checks(spark, sf, exprs)


def dq_dates(spark, sf):
    """PB12 / PB13 on the six date fields (as of the run date)."""
    exprs = {}
    for f in DATE_FIELDS:
        exprs[f"{f}_FECHA"] = P.parsed_date(f)
        exprs[f"{f}_MALA"] = P.is_bad_date(f, K.DEFAULT_AS_OF)
    return _field_checks(spark, sf, exprs)


def _text_checks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V6..V9 and the draft list over whole texts, and how many of their
    pieces are placeholder words or too short for an address."""
    return df.select(*keys, *[F.expr(e).alias(name) for name, e in {
        "TEXTO_INVALIDO": V.text_invalid("text"), "TEXTO_INVALIDO_BORRADOR": V.text_invalid("text", runs=K.KEYBOARD_RUNS_DRAFT),
        "SECUENCIA_NUMERICA": V.numeric_sequence("text"), "LETRAS_REPETIDAS": V.repeated_letters("text"),
        "TIENE_PALABRA_INVALIDA": V.has_placeholder("text"), "VACIO": P.is_empty("text")}.items()])


def dq_documents_text(spark, sf):
    """V1, V6, V6b, V7, V8, PB3 on every whole document text."""
    return _text_checks(read_table(spark, sf, "documents"), ("doc_id", "lang", "source"))


def dq_conversations_text(spark, sf):
    """V1, V6, V6b, V7, V8, PB3 on every whole conversation turn."""
    return _text_checks(read_table(spark, sf, "conversations"), ("conv_id", "turn", "role"))


def _pieces(spark, sf) -> DataFrame:
    """(doc_id, lang, pieza): the blank-separated pieces of all documents."""
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", "lang", F.explode(F.split("text", "[ \\n]+")).alias("pieza"))


def dq_documents_placeholder(spark, sf):
    """V1 on every piece of a document text."""
    return _pieces(spark, sf).select("doc_id", "pieza", F.expr(V.has_placeholder("pieza")).alias("TIENE_PALABRA_INVALIDA"))


def dq_documents_email(spark, sf):
    """V2 on every piece of a document text that holds an at sign."""
    return _pieces(spark, sf).filter(F.col("pieza").contains("@")).select(
        "doc_id", "pieza", F.expr(V.email_invalid("pieza")).alias("EMAIL_INVALIDO"))


def dq_documents_phone(spark, sf):
    """V3 and V5 on every piece of a document text that holds a digit."""
    return _pieces(spark, sf).filter(F.col("pieza").rlike("[0-9]")).select(
        "doc_id", "pieza", F.expr(V.phone_invalid("pieza")).alias("TELEFONO_INVALIDO"),
        F.expr(V.address_invalid("pieza")).alias("DOMICILIO_INVALIDO"))


def dq_placeholder_by_lang(spark, sf):
    """V1 and V6 over the pieces of all documents, counted per language
    (partial aggregation)."""
    return _pieces(spark, sf).groupBy("lang").agg(
        F.count(F.lit(1)).alias("PIEZAS"),
        F.expr(f"count_if({V.has_placeholder('pieza')})").alias("CON_PALABRA_INVALIDA"),
        F.expr(f"count_if({V.text_invalid('pieza')})").alias("CON_TEXTO_INVALIDO"))


def dq_csv_roundtrip(spark, sf):
    """SRC1 + SNK2: the party table written as ';' text with a header under the
    shared folder, read back by its header as all strings, audited, and the
    summary returned."""
    from recordcheck.sources.delimited import read_delimited, write_delimited

    path = scratch_path(spark, "csv")
    write_delimited(_party(spark, sf), path)
    back = read_delimited(spark, path)
    back = back.withColumn("k", F.col("k").cast("long"))
    return _bigint_counters(Audit(back, keys=KEYS, materialize=False).summary())


OUTPUTS = ("resumen_ejecutivo", "detalle_observaciones", "reporte_auditoria", "resumen_por_campo",
           "registros_criticos", "registros_con_dependencias")


def _written(name: str) -> Query:
    """SNK1 + SNK3: all outputs written under a run-stamped path in the shared
    folder, one of them read back."""
    def query(spark, sf):
        with _audit(spark, sf, materialize=True) as audit:
            path = audit.write(scratch_path(spark, "outputs"), run_id="20251130")
        return _joined_arrays(_bigint_counters(spark.read.parquet(f"{path}/{name}")))

    return query


def dq_summary_fold(spark, sf):
    """SM1..SM10 from the observation array, by one fold over it."""
    src = _party(spark, sf)
    cat = party_catalog(src.columns)
    ev = evaluate(src, cat.rules, cat.fields).select(*KEYS, *RECORD_ID, OBS_COL)
    return _bigint_counters(executive_summary(with_summary(ev), KEYS))


def _looked_up(output: str) -> Query:
    """EX2 / EX3 over SNK1: one record code in a written, range-sorted output."""
    def query(spark, sf):
        with _audit(spark, sf, materialize=True) as audit:
            path = audit.write(scratch_path(spark, "outputs"), run_id="20251130")
        return lookup(spark, f"{path}/{output}", LOOKUP_CODE)

    return query


def pf_merged_runs(spark, sf):
    """PF1..PF7 of two runs, each over half of the records, merged from their
    stored states."""
    root, runs = scratch_path(spark, "runs"), []
    for half in (0, 1):
        with Audit(_party(spark, sf).filter(F.col("k") % 2 == half), keys=KEYS) as audit:
            runs.append(audit.write(root, run_id=f"mitad{half}"))
    return _joined_arrays(merged_profile(spark, runs))


def _damaged_file(spark, sf) -> str:
    """The party table as ';' text in the shared folder, some lines damaged: cut
    short, with fields too many, or with a byte that is no UTF-8."""
    src = _party(spark, sf)
    k, cells = F.col("k"), [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in src.columns]
    byte = F.expr("cast(unhex('E9') as string)")
    broken = [F.concat(c, byte) if n == "RAZON_SOCIAL" else c for n, c in zip(src.columns, cells)]
    line = (F.when(k % 17 == 3, F.concat_ws(";", *cells[:40])).when(k % 17 == 5, F.concat_ws(";", *cells, F.lit("x"), F.lit("y")))
            .when(k % 17 == 7, F.concat_ws(";", *broken)).otherwise(F.concat_ws(";", *cells)))
    path = scratch_path(spark, "damaged")
    src.select(line.alias("value")).write.text(path)
    return path


def src2_quarantine(spark, sf):
    """SRC2: the damaged lines of a written file, with what is wrong with them."""
    _, rejected = read_quarantined(spark, _damaged_file(spark, sf), fields=(*KEYS, *K.FIELDS), header=False)
    return rejected.select(F.substring_index("LINEA", ";", 1).cast("long").alias("k"), "MOTIVO", "CAMPOS")


def src2_accepted(spark, sf):
    """SRC1 + SRC2: the audit's summary of the lines of that file that are whole."""
    rows, _ = read_quarantined(spark, _damaged_file(spark, sf), fields=(*KEYS, *K.FIELDS), header=False)
    return _bigint_counters(Audit(rows.withColumn("k", F.col("k").cast("long")), keys=KEYS, materialize=False).summary())


def s13_tx_required_all(spark, sf):
    """A transaction field is required only when both others are filled."""
    src = _party(spark, sf)
    cat = party_catalog(src.columns, mutual="all").only("R19", "R20", "R21")
    ev = evaluate(src, cat.rules, cat.fields)
    return detail_rows(ev, KEYS, order="none").drop("CODIGO", "RAZON_SOCIAL", "NIT")


# One query per predicate / validator (PB1..PB13, V1..V10) -----------------------

_ALL = K.FIELDS
_REFS = ("REFERENCIAS_PERS_REP_LEGAL", "REFERENCIAS_COM_REP_LEGAL", "REFERENCIAS_BANCARIAS_REP_LEGAL")
_NUMBERS = INCOME + ("IDENTIFICACION_CANT_INT_ALTA_GERENCIA", "CANTIDAD_ACTUALIZACIONES")
_TEXT = ("RAZON_SOCIAL", "LUGAR_TRABAJO_REP_LEGAL", "CARGO_REP_LEGAL") + K.OPTIONAL
# query name -> (column prefix, function over a field, fields it is applied to)
FIELD_FUNCTIONS = {
    "pb01_is_null": ("PB1", P.is_null, _ALL),
    "pb02_is_blank": ("PB2", P.is_blank, _ALL),
    "pb03_is_empty": ("PB3", P.is_empty, _ALL),
    "pb04_is_filled": ("PB4", P.is_filled, _ALL),
    "pb05_upper_trim": ("PB5", P.upper_trim, ("RAZON_SOCIAL", "DOMICILIO", "CARGO_REP_LEGAL")),
    "pb06_only_digits": ("PB6", P.only_digits, ("NIT", "TELEFONO", "TELEFONO_REP_LEGAL") + _REFS),
    "pb07_double_simple": ("PB7", P.to_double_simple, _NUMBERS),
    "pb08_double_locale": ("PB8", P.to_double_locale, _NUMBERS),
    "pb09_positive_int": ("PB9", P.is_positive_int, _NUMBERS),
    "pb10_nonneg_number": ("PB10", P.is_nonneg_number, _NUMBERS),
    "pb11_positive_number": ("PB11", P.is_positive_number, _NUMBERS),
    "pb12_parsed_date": ("PB12", P.parsed_date, DATE_FIELDS),
    "pb13_bad_date": ("PB13", P.is_bad_date, DATE_FIELDS),
    "v01_placeholder": ("V1", V.has_placeholder, _ALL),
    "v02_email": ("V2", V.email_invalid, ("CORREO_ELECTRONICO_REP_LEGAL",) + _REFS),
    "v03_phone": ("V3", V.phone_invalid, ("TELEFONO", "TELEFONO_REP_LEGAL") + _REFS),
    "v04_tax_id": ("V4", V.nit_invalid, ("NIT", "NIT_REP_LEGAL", "NRO_DOC_ID")),
    "v05_address": ("V5", V.address_invalid,
                    ("DOMICILIO", "DOMICILIO_PARTICULAR_REP_LEGAL", "DOMICILIO_COMERCIAL_REP_LEGAL")),
    "v06_free_text": ("V6", V.text_invalid, _TEXT),
    "v06b_free_text_draft": ("V6B", lambda c: V.text_invalid(c, runs=K.KEYBOARD_RUNS_DRAFT), _TEXT),
    "v07_numeric_sequence": ("V7", V.numeric_sequence, NUMERIC_OPTIONAL + ("TELEFONO", "NRO_DOC_ID")),
    "v08_repeated_letters": ("V8", V.repeated_letters, _TEXT),
    "v09_optional_text": ("V9", V.optional_text_inconsistent, K.OPTIONAL),
    "v10_optional_number": ("V10", V.optional_number_inconsistent, NUMERIC_OPTIONAL),
}


def _field_function(name: str) -> Query:
    prefix, fn, fields = FIELD_FUNCTIONS[name]
    return lambda spark, sf: _field_checks(spark, sf, {f"{prefix}_{f}": fn(f) for f in fields})


# One query per summary column group (SM1..SM10) -----------------------------------

SUMMARY_PARTS = {
    "sm01_null_blank_counts": ("CANT_NULL", "CANT_VACIO"),
    "sm02_mandatory_count": ("CANT_OBLIGADOS_FALTANTES",),
    "sm03_conditional_count": ("CANT_CONDICIONALES_FALTANTES",),
    "sm04_opc_conditional_count": ("CANT_OPC_CONDICIONALES_FALTANTES",),
    "sm05_optional_count": ("CANT_INCONSISTENCIAS_DATOS",),
    "sm06_total_count": ("CANT_TOTAL_OBS",),
    "sm07_null_blank_list": ("OBS_CAMPOS_NULL_VACIO",),
    "sm08_mandatory_list": ("OBS_OBLIGADOS",),
    "sm09_conditional_list": ("OBS_CONDICIONALES",),
    "sm10_inconsistency_list": ("OBS_INCONSISTENCIAS",),
}


def _summary_part(cols) -> Query:
    return lambda spark, sf: dq_summary(spark, sf).select("k", *cols)


def dq_ratio(spark, sf):
    """AG2: share of records with and without observations (percent, 2 decimals)."""
    return _audit(spark, sf).record_counts().select("PCT_CON_OBS", "PCT_LIMPIOS")


def dq_extended_obs(spark, sf):
    """S1..S9, S12: observations of the extended catalogue."""
    from recordcheck.plans.catalog_extended import EXTENDED_FAMILIES

    return observations(spark, sf, EXTENDED_FAMILIES, extended=True)


def registry() -> dict[str, Query]:
    out: dict[str, Query] = {name: _families(*fams) for name, fams in GROUPS.items()}
    for fam in RULE_SLUGS:
        out[rule_query_name(fam)] = _families(fam)
    for name in FIELD_FUNCTIONS:
        out[name] = _field_function(name)
    for name, cols in SUMMARY_PARTS.items():
        out[name] = _summary_part(cols)
    g = globals()
    for name in ("dq_summary", "dq_detail", "dq_report", "dq_view_critical", "dq_view_dependency",
                 "dq_view_inconsistent", "dq_view_clean", "dq_missing_mandatory", "dq_bad_nit",
                 "dq_heavy_records", "dq_record_lookup", "dq_report_lookup", "dq_report_null_type",
                 "dq_report_conditional_type", "dq_report_depends", "dq_report_format", "dq_totals",
                 "dq_record_counts", "dq_field_counts", "dq_top_fields", "dq_field_type_counts",
                 "dq_field_profile", "dq_worst_fields", "dq_critical_fields", "dq_mandatory_below",
                 "dq_null_above", "dq_excellent_fields", "dq_one_field", "dq_category_avg",
                 "dq_numeric_text", "dq_seq_repeat", "dq_dates", "dq_documents_text",
                 "dq_conversations_text", "dq_placeholder_by_lang", "dq_csv_roundtrip",
                 "dq_extended_obs", "dq_ratio", "dq_documents_placeholder", "dq_documents_email", "dq_documents_phone",
                 "s13_tx_required_all", "dq_summary_fold", "pf_merged_runs", "src2_quarantine", "src2_accepted"):
        out[name] = g[name]
    for name in OUTPUTS:
        out[f"snk1_{name}"] = _written(name)
    out["snk1_lookup_detail"] = _looked_up("detalle_observaciones")
    out["snk1_lookup_report"] = _looked_up("reporte_auditoria")
    return out
