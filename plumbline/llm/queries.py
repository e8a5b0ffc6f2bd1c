"""The queries of this subpackage and, where SQL can say the same, their DuckDB text."""

from . import decontaminate, fill_middle, jaccard_join, licenses, line_dedup, mixing, pii, quality_model, quality_rules, secrets, suffix_dedup, token_counts, vector_codes

QUERIES = {
    "op1_quality_rules": quality_rules.op1,
    "op2_pii": pii.op2,
    "op3_line_dedup": line_dedup.op3,
    "op4_suffix_dedup": suffix_dedup.op4,
    "op5_secret_scan": secrets.op5,
    "op6_jaccard_join": jaccard_join.op6,
    "op7_decontaminate": decontaminate.op7,
    "op8_token_counts": token_counts.op8,
    "op9_quality_model": quality_model.op9,
    "op10_source_mix": mixing.op10,
    "op11_license_scan": licenses.op11,
    "op12_fill_middle": fill_middle.op12,
    "op13_vector_codes": vector_codes.op13,
}

ORACLES = {
    "op1_quality_rules": quality_rules.op1_sql(),
    "op3_line_dedup": line_dedup.op3_sql(),
    "op5_secret_scan": secrets.op5_sql(),
    "op6_jaccard_join": jaccard_join.op6_sql(),
    "op7_decontaminate": decontaminate.op7_sql(),
    "op12_fill_middle": fill_middle.op12_sql(),
    "op13_vector_codes": vector_codes.op13_sql(),
}
