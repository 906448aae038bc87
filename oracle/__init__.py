"""DuckDB oracle SQL, one entry per registered Spark query (same names,
same column names)."""

from __future__ import annotations

from oracle import party_sql as S
from oracle.spec import FIELD_QUERIES

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

RULE_NAMES = {
    "R1": "r01_null", "R2": "r02_blank", "R3": "r03_mandatory_missing",
    "R4": "r04_mandatory_placeholder", "R5": "r05_nit_format", "R6": "r06_company_name_text",
    "R7": "r07_mgmt_count_without_post", "R8": "r08_mgmt_count_without_names",
    "R9": "r09_post_without_count", "R10": "r10_post_without_names",
    "R11": "r11_names_without_count", "R12": "r12_names_without_post",
    "R13": "r13_doc_type_required", "R14": "r14_doc_number_required",
    "R15": "r15_rep_dependents_required", "R16": "r16_spouse_required",
    "R17": "r17_address_invalid", "R18": "r18_home_address_invalid",
    "R19": "r19_tx_date_required", "R20": "r20_tx_account_required",
    "R21": "r21_tx_channel_required", "R22": "r22_email_invalid", "R23": "r23_rep_phone_invalid",
    "R24": "r24_phone_invalid", "R25": "r25_rep_code_required",
    "R26": "r26_at_least_one_reference", "R27": "r27_update_count", "R28": "r28_optional_text",
}


def oracle_queries() -> dict[str, str]:
    out = {name: S.obs_rows(fams) for name, fams in GROUPS.items()}
    for fam, name in RULE_NAMES.items():
        out[name] = S.obs_rows((fam,))
    out.update({
        "dq_summary": S.summary_sql(),
        "dq_detail": S.detail_sql(),
        "dq_report": S.report_sql(),
        "dq_view_critical": S.summary_sql("CANT_OBLIGADOS_FALTANTES > 0 OR CANT_NULL > 5"),
        "dq_view_dependency": S.summary_sql("CANT_CONDICIONALES_FALTANTES > 0"),
        "dq_view_inconsistent": S.summary_sql("CANT_INCONSISTENCIAS_DATOS > 0"),
        "dq_view_clean": S.summary_sql("CANT_TOTAL_OBS = 0"),
        "dq_missing_mandatory": S.summary_sql("CANT_OBLIGADOS_FALTANTES > 0"),
        "dq_bad_nit": S.summary_sql("contains(OBS_OBLIGADOS, 'NIT_FORMATO_INVALIDO')"),
        "dq_heavy_records": S.summary_sql("CANT_TOTAL_OBS > 10"),
        "dq_record_lookup": S.detail_sql("p.CODIGO = 'C7'"),
        "dq_report_lookup": S.report_sql("CODIGO = 'C7'"),
        "dq_report_null_type": S.report_sql("TIPO_VERIFICACION = 'NULL'"),
        "dq_report_conditional_type": S.report_sql("TIPO_VERIFICACION = 'CAMP_CONDICIONAL'"),
        "dq_report_depends": S.report_sql("REGLA = 'DEPENDE_DE'"),
        "dq_report_format": S.report_sql("REGLA = 'FORMATO'"),
        "dq_totals": S.totals_sql(),
        "dq_record_counts": S.record_counts_sql(),
        "dq_field_counts": S.field_counts_sql(),
        "dq_top_fields": S.field_counts_sql(top=10),
        "dq_field_type_counts": S.field_type_counts_sql(),
        "dq_field_profile": S.profile_sql(),
        "dq_worst_fields": S.profile_sql() + " ORDER BY PCT_COMPLETITUD NULLS LAST, campo LIMIT 10",
        "dq_critical_fields": S.profile_sql("CALIDAD_CAMPO = 'CRÍTICA'"),
        "dq_mandatory_below": S.profile_sql("CATEGORIA = 'OBLIGATORIO' AND PCT_COMPLETITUD < 95"),
        "dq_null_above": S.profile_sql("PCT_NULL > 20"),
        "dq_excellent_fields": S.profile_sql("CALIDAD_CAMPO = 'EXCELENTE'"),
        "dq_one_field": S.profile_sql("campo = 'TELEFONO_REP_LEGAL'"),
        "dq_category_avg": S.category_avg_sql(),
        "dq_numeric_text": S.numeric_text_sql(),
        "dq_seq_repeat": S.seq_repeat_sql(),
        "dq_dates": S.dates_sql(),
        "dq_documents_text": S.text_table_sql("documents", "doc_id, lang, source"),
        "dq_conversations_text": S.text_table_sql("conversations", "conv_id, turn, role"),
        "dq_documents_placeholder": S.documents_placeholder_sql(),
        "dq_placeholder_by_lang": S.placeholder_by_lang_sql(),
        "dq_csv_roundtrip": S.summary_sql(),
        "dq_extended_obs": S.extended_obs_sql(),
    })
    for name, (prefix, fields) in FIELD_QUERIES.items():
        out[name] = S.field_function_sql(prefix, fields)
    for name, cols in SUMMARY_PARTS.items():
        out[name] = S.summary_sql().replace("SELECT * FROM summary", f"SELECT k, {', '.join(cols)} FROM summary")
    out["dq_ratio"] = f"SELECT PCT_CON_OBS, PCT_LIMPIOS FROM ({S.record_counts_sql()})"
    out["dq_documents_email"] = S.pieces_email_sql()
    out["dq_documents_phone"] = S.pieces_phone_sql()
    out["s13_tx_required_all"] = S.tx_required_all_sql()
    for output, query in {"resumen_ejecutivo": "dq_summary", "detalle_observaciones": "dq_detail",
                          "reporte_auditoria": "dq_report", "resumen_por_campo": "dq_field_profile",
                          "registros_criticos": "dq_view_critical",
                          "registros_con_dependencias": "dq_view_dependency"}.items():
        out[f"snk1_{output}"] = out[query]
    out["dq_summary_fold"] = out["dq_summary"]
    out["snk1_lookup_detail"], out["snk1_lookup_report"] = out["dq_record_lookup"], out["dq_report_lookup"]
    out["pf_merged_runs"] = out["dq_field_profile"]
    out["src2_quarantine"], out["src2_accepted"] = S.quarantine_sql(), S.accepted_sql()
    return out


# Columns of each per-ID summary query (same split as the Spark side).
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
