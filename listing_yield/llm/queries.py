"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from . import (exact_search, hard_negatives, language_id, line_dedup, mixing, near_dedup, packing, quality_rules,
               secret_scans, token_counts, url_filters, warc_bundles, whitening)

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_url_filters": url_filters.op2_url_filters,
    "op3_exact_search": exact_search.op3_exact_search,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_secret_scans": secret_scans.op5_secret_scans,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_language_id": language_id.op8_language_id,
    "op9_mixing": mixing.op9_mixing,
    "op10_packing": packing.op10_packing,
    "op11_warc_bundles": warc_bundles.op11_warc_bundles,
    "op12_whitening": whitening.op12_whitening,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES = {
    "op2_url_filters": url_filters.ORACLE,
    "op3_exact_search": exact_search.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op5_secret_scans": secret_scans.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_near_dedup": near_dedup.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_warc_bundles": warc_bundles.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
