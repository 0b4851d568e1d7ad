"""Queries of the corpus operators and of the pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from eventloom.llm import bpe, chat, decontaminate, fill_middle, filter_audit, html_text, lines, lm, mixing, quality, simhash, tokens, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1_warc,
        "op2_token_counts": tokens.op2_token_counts,
        "op3_html_text": html_text.op3_html_text,
        "op4_line_dedup": lines.op4_line_dedup,
        "op5_chat_format": chat.op5_chat_format,
        "op6_decontaminate": decontaminate.op6_decontaminate,
        "op7_simhash": simhash.op7_simhash,
        "op8_mixing": mixing.op8_mixing,
        "op9_lm_scores": lm.op9_lm_scores,
        "op10_quality_rules": quality.op10_quality_rules,
        "op11_byte_bpe": bpe.op11_byte_bpe,
        "op12_filter_audit": filter_audit.op12_filter_audit,
        "op13_fill_in_middle": fill_middle.op13_fill_in_middle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.ORACLE,
        "op4_line_dedup": lines.ORACLE,
        "op5_chat_format": chat.ORACLE,
        "op12_filter_audit": filter_audit.ORACLE,
        "op13_fill_in_middle": fill_middle.ORACLE,
    }
