"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm import ann, centroids, chat, decontam, jaccard, licenses, lm, mixing, pii, quality, secrets, tokalign, warc

QUERIES = {
    "op1_lm_score": lm.op1_lm_score,
    "op2_nearest": ann.op2_nearest,
    "op3_decontaminate": decontam.op3_decontaminate,
    "op4_jaccard": jaccard.op4_jaccard,
    "op5_mix": mixing.op5_mix,
    "op6_quality": quality.op6_quality,
    "op7_chat_format": chat.op7_chat_format,
    "op8_licenses": licenses.op8_licenses,
    "op9_warc_derivatives": warc.op9_warc_derivatives,
    "op10_pii": pii.op10_pii,
    "op11_align": tokalign.op11_align,
    "op12_cluster": centroids.op12_cluster,
    "op13_secrets": secrets.op13_secrets,
}

ORACLE = {
    "op4_jaccard": jaccard.OP4_SQL,
    "op7_chat_format": chat.OP7_SQL,
    "op12_cluster": centroids.OP12_SQL,
}
