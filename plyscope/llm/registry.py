"""The registered queries of the subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from plyscope.llm.chat import OP5_SQL, op5_typed_parts_chat
from plyscope.llm.decontaminate import OP10_SQL, op10_winnowing_decontamination
from plyscope.llm.embeddings import OP8_SQL, op8_iterative_quantisation
from plyscope.llm.html_text import op7_text_to_tag_extraction
from plyscope.llm.langid import op2_string_kernel_language
from plyscope.llm.lm import op4_context_mixing_scores
from plyscope.llm.mixing import op9_proportional_fitting
from plyscope.llm.neardup import OP6_SQL, op6_odd_sketch_near_dup
from plyscope.llm.quality import op1_factorisation_quality
from plyscope.llm.search import op11_balanced_posting_lists
from plyscope.llm.sharding import op3_histogram_sort
from plyscope.llm.spelling import OP12_SQL, op12_kd_tree_spelling
from plyscope.llm.vector_codes import OP13_SQL, op13_cover_tree_codes

QUERIES = {
    f.__name__: f
    for f in (
        op1_factorisation_quality,
        op2_string_kernel_language,
        op3_histogram_sort,
        op4_context_mixing_scores,
        op5_typed_parts_chat,
        op6_odd_sketch_near_dup,
        op7_text_to_tag_extraction,
        op8_iterative_quantisation,
        op9_proportional_fitting,
        op10_winnowing_decontamination,
        op11_balanced_posting_lists,
        op12_kd_tree_spelling,
        op13_cover_tree_codes,
    )
}

ORACLES = {
    "op5_typed_parts_chat": OP5_SQL,
    "op6_odd_sketch_near_dup": OP6_SQL,
    "op8_iterative_quantisation": OP8_SQL,
    "op10_winnowing_decontamination": OP10_SQL,
    "op12_kd_tree_spelling": OP12_SQL,
    "op13_cover_tree_codes": OP13_SQL,
}
