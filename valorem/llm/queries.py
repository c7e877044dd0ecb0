"""Registry of this package: LLM_QUERIES[name](spark, sf_dir), LLM_SQL[name] (DuckDB)."""

from __future__ import annotations

from valorem.llm import (byte_bpe, decontaminate, exact_dedup, language_id, licenses, line_dedup, lm_scoring, prefix_trie, quality,
                         run_detection, simhash, substring_dedup, warc_fixity)

LLM_QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_simhash": simhash.op4_simhash,
    "op5_lm_scoring": lm_scoring.op5_lm_scoring,
    "op6_warc_fixity": warc_fixity.op6_warc_fixity,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_language_id": language_id.op9_language_id,
    "op10_quality": quality.op10_quality,
    "op11_periodic_runs": run_detection.op11_periodic_runs,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

LLM_SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_license_scan": licenses.SQL,
    "op3_line_dedup": line_dedup.SQL,
    "op6_warc_fixity": warc_fixity.SQL,
    "op8_decontaminate": decontaminate.SQL,
    "op12_substring_dedup": substring_dedup.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
