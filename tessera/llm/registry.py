"""Queries of the subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, conversation_repair, exact_dedup, fingerprint, html_extract, langmix, line_dedup, mixing, ngram_join, ring_shards, rule_ensemble, secret_scan, token_align


def queries() -> dict:
    return {
        "op1_html_boosted": html_extract.op1_html_boosted,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_secret_scan": secret_scan.op3_secret_scan,
        "op4_ring_shards": ring_shards.op4_ring_shards,
        "op5_rule_quality": rule_ensemble.op5_rule_quality,
        "op6_byte_bpe": bpe.op6_byte_bpe,
        "op7_language_mixture": langmix.op7_language_mixture,
        "op8_cdc_fingerprints": fingerprint.op8_cdc_fingerprints,
        "op9_mix_sources": mixing.op9_mix_sources,
        "op10_ngram_join": ngram_join.op10_ngram_join,
        "op11_conversation_repair": conversation_repair.op11_conversation_repair,
        "op12_line_dedup": line_dedup.op12_line_dedup,
        "op13_token_alignment": token_align.op13_token_alignment,
    }


def oracle_sql() -> dict:
    return {
        "op2_exact_dedup": exact_dedup.OP2_SQL,
        "op3_secret_scan": secret_scan.OP3_SQL,
        "op11_conversation_repair": conversation_repair.OP11_SQL,
        "op12_line_dedup": line_dedup.OP12_SQL,
    }
