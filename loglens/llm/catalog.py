"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from loglens.llm import (
    decontaminate,
    html_extract,
    jaccard_join,
    line_dedup,
    lm_scoring,
    mixing,
    near_dup,
    ordinal_quality,
    phrase_mining,
    quality_rules,
    spelling_variants,
    suffix_dedup,
    url_filter,
)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_ordinal_quality": ordinal_quality.query,
    "op3_decontaminate": decontaminate.query,
    "op4_url_filter": url_filter.query,
    "op5_html_extract": html_extract.query,
    "op6_near_dedup": near_dup.query,
    "op7_quality_rules": quality_rules.query,
    "op8_source_mixing": mixing.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_lm_scoring": lm_scoring.query,
    "op11_phrase_mining": phrase_mining.query,
    "op12_jaccard_join": jaccard_join.query,
    "op13_spelling_variants": spelling_variants.query,
}

#: Only where SQL gives the whole result in reasonable time; the others are
#: held against brute force in the tests.
ORACLE = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op3_decontaminate": decontaminate.ORACLE,
    "op6_near_dedup": near_dup.ORACLE,
    "op11_phrase_mining": phrase_mining.ORACLE,
    "op12_jaccard_join": jaccard_join.ORACLE,
    "op13_spelling_variants": spelling_variants.ORACLE,
}
