"""Queries of the training-data operators and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from quillmill.llm import bpe, chat, decontaminate, html, licenses, neardup, quality, search, secrets, toxicity

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_html": html.op2_html,
    "op3_search": search.op3_search,
    "op4_bpe": bpe.op4_bpe,
    "op5_chat": chat.op5_chat,
    "op6_secrets": secrets.op6_secrets,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_neardup": neardup.op9_neardup,
    "op10_licenses": licenses.op10_licenses,
}

ORACLE_SQL = {
    "op5_chat": chat.OP5_SQL,
    "op7_decontaminate": decontaminate.OP7_SQL,
}
