"""The queries of this package and their SQL."""

from __future__ import annotations

from rollforge.llm import collocations, decontam, exact_dedup, filter_audit, html_extract, jaccard_join, language_id, mixing, sharding
from rollforge.llm import suffix_dedup, token_counts, toxicity, url_filter, url_filter_sql

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_language_id": language_id.op2_language_id,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_sharding": sharding.op4_sharding,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_decontaminate": decontam.op6_decontaminate,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_mixing": mixing.op10_mixing,
    "op11_collocations": collocations.op11_collocations,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_html_extract": html_extract.op13_html_extract,
}
CHECKS = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op6_decontaminate": decontam.OP6_SQL,
    "op8_url_filter": url_filter_sql.OP8_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
}
