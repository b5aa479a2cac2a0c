"""The queries of this package, one for each operator, over its whole table."""

from __future__ import annotations

from tidemark.llm.decontamination import op8_decontamination
from tidemark.llm.language import op10_language
from tidemark.llm.lm import op5_lm_score
from tidemark.llm.manifest import op13_manifest
from tidemark.llm.mixing import op1_mix
from tidemark.llm.near_dup import op9_near_duplicates
from tidemark.llm.ngram_join import op12_ngram_join
from tidemark.llm.quality_rules import op7_quality_rules
from tidemark.llm.search import op11_search
from tidemark.llm.sharding import op6_sharding
from tidemark.llm.substring import op2_substring_dedup
from tidemark.llm.token_files import op4_token_files
from tidemark.llm.url_filter import op3_url_filter

QUERIES = {
    "op1_mix": op1_mix,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_token_files": op4_token_files,
    "op5_lm_score": op5_lm_score,
    "op6_sharding": op6_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language": op10_language,
    "op11_search": op11_search,
    "op12_ngram_join": op12_ngram_join,
    "op13_manifest": op13_manifest,
}
