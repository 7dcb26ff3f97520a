"""The registered queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, decontaminate, html, langid, mixing, quality, rules, simhash, toxicity, urls
from .common import read


def queries() -> dict:
    return {
        "op1_simhash": lambda s, d: simhash.op1_simhash(read(s, d, "documents")),
        "op2_quality": lambda s, d: quality.op2_quality(read(s, d, "documents"), read(s, d, "labels")),
        "op3_rules": lambda s, d: rules.op3_rules(read(s, d, "documents"), read(s, d, "labels")),
        "op4_urls": lambda s, d: urls.op4_urls(read(s, d, "pages")),
        "op5_html": lambda s, d: html.op5_html(read(s, d, "pages")),
        "op6_langid": lambda s, d: langid.op6_langid(read(s, d, "documents")),
        "op7_toxicity": lambda s, d: toxicity.op7_toxicity(read(s, d, "documents"), read(s, d, "labels")),
        "op8_chat": lambda s, d: chat.op8_chat(read(s, d, "conversations")),
        "op9_decontamination": lambda s, d: decontaminate.op9_decontamination(read(s, d, "documents"), read(s, d, "benchmark")),
        "op10_mixing": lambda s, d: mixing.op10_mixing(read(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_urls": urls.ORACLE_SQL}
