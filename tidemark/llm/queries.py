"""The registered queries of this package and, where SQL can express them, the same in SQL."""

from tidemark.llm.decontaminate import op6_benchmark_decontamination
from tidemark.llm.exact import EXACT_SQL, op9_exact_dedup
from tidemark.llm.line_dedup import LINE_SQL, op11_line_dedup
from tidemark.llm.mixing import op4_lm_scoring
from tidemark.llm.ngram_join import op8_ngram_jaccard_join
from tidemark.llm.page_text import op2_page_text
from tidemark.llm.packing import op5_packing
from tidemark.llm.passages import op3_substring_dedup
from tidemark.llm.pii import op10_pii
from tidemark.llm.ranked_search import SEARCH_SQL, op13_ranked_search
from tidemark.llm.token_alignment import op12_token_alignment
from tidemark.llm.token_matrix import op1_token_matrix
from tidemark.llm.toxicity import op7_toxicity

LLM_QUERIES = {
    "op1_token_matrix": op1_token_matrix,
    "op2_page_text": op2_page_text,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_packing": op5_packing,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pii": op10_pii,
    "op11_line_dedup": op11_line_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_ranked_search": op13_ranked_search,
}

LLM_ORACLES = {"op9_exact_dedup": EXACT_SQL, "op11_line_dedup": LINE_SQL, "op13_ranked_search": SEARCH_SQL}
