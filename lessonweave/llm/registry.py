"""Queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from lessonweave.llm import collocations, decontamination, html_extract, jaccard, licences, line_dedup, packing, pii, quality, secret_scan, topk, toxicity, vector_codes

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_packing": packing.op2_packing,
    "op3_html": html_extract.op3_html,
    "op4_quality": quality.op4_quality,
    "op5_jaccard": jaccard.op5_jaccard,
    "op6_pii": pii.op6_pii,
    "op7_licences": licences.op7_licences,
    "op8_topk": topk.op8_topk,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_collocations": collocations.op12_collocations,
    "op13_secrets": secret_scan.op13_secrets,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op5_jaccard": jaccard.OP5_SQL,
    "op8_topk": topk.OP8_SQL,
    "op9_decontamination": decontamination.OP9_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
