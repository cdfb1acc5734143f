"""The subpackage's registered queries and their DuckDB counterparts."""

from __future__ import annotations

from . import (
    decontaminate,
    html_render,
    jaccard_join,
    lexical_search,
    line_dedup,
    packing,
    quality_crf,
    quality_rules,
    reply_trees,
    secrets,
    spelling,
    suffix_dedup,
    url_filter,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_quality_crf": quality_crf.op5_quality_crf,
    "op6_html_render": html_render.op6_html_render,
    "op7_ngram_jaccard": jaccard_join.op7_ngram_jaccard,
    "op8_packing": packing.op8_packing,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_reply_trees": reply_trees.op12_reply_trees,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op2_quality_rules": quality_rules.ORACLE_SQL,
    "op7_ngram_jaccard": jaccard_join.ORACLE_SQL,
    "op9_url_filter": url_filter.ORACLE_SQL,
    "op11_lexical_search": lexical_search.ORACLE_SQL,
    "op12_reply_trees": reply_trees.ORACLE_SQL,
}
