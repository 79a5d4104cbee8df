"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import audit, bpe, decontamination, fingerprints, licenses, line_dedup, lm, negatives, quality, secrets, sharding, simhash, toxicity

QUERIES = {
    "op1_lm_scoring": lm.op1_lm_scoring,
    "op2_license_scans": licenses.op2_license_scans,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_secret_scans": secrets.op4_secret_scans,
    "op5_simhash": simhash.op5_simhash,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_sharding": sharding.op10_sharding,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_fingerprints": fingerprints.op12_fingerprints,
    "op13_filter_audit": audit.op13_filter_audit,
}
ORACLE_SQL = {
    "op2_license_scans": licenses.OP2_SQL,
    "op3_quality_rules": quality.OP3_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op9_decontamination": decontamination.OP9_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op13_filter_audit": audit.OP13_SQL,
}
