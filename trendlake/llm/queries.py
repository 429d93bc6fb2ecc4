"""Queries of this subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from trendlake.llm import (bpe, html, mixing, negatives, quality, rollup, rules, simhash, suffix, topk, toxicity, warc,
                           whitening)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_quality_rules": rules.op2_quality_rules,
    "op3_token_rollup": rollup.op3_token_rollup,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_repeats": suffix.op5_repeats,
    "op6_bpe": bpe.op6_bpe,
    "op7_html": html.op7_html,
    "op8_simhash": simhash.op8_simhash,
    "op9_topk": topk.op9_topk,
    "op10_mixing": mixing.op10_mixing,
    "op11_whitening": whitening.op11_whitening,
    "op12_warc": warc.op12_warc,
    "op13_negatives": negatives.op13_negatives,
}

SQL = {
    "op2_quality_rules": rules.OP2_SQL,
    "op3_token_rollup": rollup.OP3_SQL,
    "op9_topk": topk.OP9_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op12_warc": warc.OP12_SQL,
    "op13_negatives": negatives.OP13_SQL,
}
