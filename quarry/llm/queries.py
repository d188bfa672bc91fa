"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from quarry.llm.ann import ORACLE_OP4, op4_ann
from quarry.llm.bpe import op2_bpe
from quarry.llm.chat import ORACLE_OP3, op3_chat
from quarry.llm.decontam import op8_decontamination
from quarry.llm.filter_audit import ORACLE_OP11, op11_filter_audit
from quarry.llm.html_extract import op1_html
from quarry.llm.importance import op13_importance
from quarry.llm.langid import op9_langid
from quarry.llm.pii import op10_pii
from quarry.llm.simhash import op7_simhash
from quarry.llm.substring import op5_substring
from quarry.llm.suffix import op12_suffix_dedup
from quarry.llm.toxicity import op6_toxicity

REGISTRY = {
    "op1_html": op1_html,
    "op2_bpe": op2_bpe,
    "op3_chat": op3_chat,
    "op4_ann": op4_ann,
    "op5_substring": op5_substring,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_langid": op9_langid,
    "op10_pii": op10_pii,
    "op11_filter_audit": op11_filter_audit,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_importance": op13_importance,
}

ORACLE: dict[str, str] = {
    "op3_chat": ORACLE_OP3,
    "op4_ann": ORACLE_OP4,
    "op11_filter_audit": ORACLE_OP11,
}
