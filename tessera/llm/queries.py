"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from tessera.llm import chat, exact, extract, jaccard, language, likelihood, merkle, mixing, packing, pii, quality, runs, windows

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_language_id": language.op4_language_id,
    "op5_personal_data": pii.op5_personal_data,
    "op6_tool_calls": chat.op6_tool_calls,
    "op7_exact_dedup": exact.op7_exact_dedup,
    "op8_extract_text": extract.op8_extract_text,
    "op9_pseudo_likelihood": likelihood.op9_pseudo_likelihood,
    "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
    "op11_window_packing": windows.op11_window_packing,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLES = {
    "op1_quality_rules": quality.OP1_SQL,
    "op2_mix_sources": mixing.OP2_SQL,
    "op6_tool_calls": chat.OP6_SQL,
    "op7_exact_dedup": exact.OP7_SQL,
    "op10_ngram_jaccard": jaccard.OP10_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
