"""Registered queries of the numbered operators, and the SQL that checks them."""

from __future__ import annotations

from tickweave.llm import bpe, collocations, curves, html, jaccard, lm, packing, quality_classifier, quality_rules, repair, repair_sql, sharding, simhash, tokens

QUERIES = {
    "op1_ann_curves": curves.op1_ann_curves,
    "op2_jaccard_join": jaccard.op2_jaccard_join,
    "op3_html_extraction": html.op3_html_extraction,
    "op4_bpe": bpe.op4_bpe,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_token_counts": tokens.op6_token_counts,
    "op7_lm_scoring": lm.op7_lm_scoring,
    "op8_sharding": sharding.op8_sharding,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_packing": packing.op10_packing,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_simhash_near_dedup": simhash.op12_simhash_near_dedup,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}
ORACLES: dict[str, str] = {
    "op2_jaccard_join": jaccard.SQL,
    "op11_conversation_repair": repair_sql.SQL,
    "op13_phrase_collocations": collocations.SQL,
}
