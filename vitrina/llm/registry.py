"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from vitrina.llm.byte_bpe import op7_byte_bpe
from vitrina.llm.graph_search import op5_graph_search
from vitrina.llm.license_scan import op2_license_scan
from vitrina.llm.main_text import op13_main_text
from vitrina.llm.packing import op10_packing
from vitrina.llm.pii import op3_pii
from vitrina.llm.popcount_clusters import OP12_SQL, op12_popcount_clusters
from vitrina.llm.quality_rules import OP1_SQL, op1_quality_rules
from vitrina.llm.shingle_join import op8_shingle_join
from vitrina.llm.spelling_variants import OP11_SQL, op11_spelling_variants
from vitrina.llm.suffix_dedup import op6_suffix_dedup
from vitrina.llm.toxicity import op4_toxicity
from vitrina.llm.url_cascade import OP9_SQL, op9_url_cascade

LLM_QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scan": op2_license_scan,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_graph_search": op5_graph_search,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_shingle_join": op8_shingle_join,
    "op9_url_cascade": op9_url_cascade,
    "op10_packing": op10_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_popcount_clusters": op12_popcount_clusters,
    "op13_main_text": op13_main_text,
}

LLM_SQL = {
    "op1_quality_rules": OP1_SQL,
    "op9_url_cascade": OP9_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_popcount_clusters": OP12_SQL,
}
