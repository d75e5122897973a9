"""Queries of the operators in this package, one per operator."""

from __future__ import annotations

from cargoline.llm.byte_bpe import op13
from cargoline.llm.chat import OP1_SQL, op1
from cargoline.llm.classifier import op7
from cargoline.llm.decontaminate import op4
from cargoline.llm.mixing import op8
from cargoline.llm.packing import op6
from cargoline.llm.pages import op3
from cargoline.llm.perplexity import op9
from cargoline.llm.simhash import op2
from cargoline.llm.spelling import op12
from cargoline.llm.substring import op10
from cargoline.llm.suffix import op5
from cargoline.llm.whitening import op11

QUERIES = {
    "op1_chat_formatting": op1,
    "op2_simhash_near_dedup": op2,
    "op3_html_extraction": op3,
    "op4_benchmark_decontamination": op4,
    "op5_suffix_array_dedup": op5,
    "op6_packing": op6,
    "op7_quality_classifier": op7,
    "op8_lm_scoring": op8,
    "op9_quality_rules": op9,
    "op10_substring_dedup": op10,
    "op11_embedding_whitening": op11,
    "op12_spelling_variants": op12,
    "op13_bpe_encoding": op13,
}

ORACLES: dict[str, str] = {"op1_chat_formatting": OP1_SQL}
