"""The queries of this package and, where SQL can express them, their DuckDB forms."""

from __future__ import annotations

from cdclake.llm import line_dedup, mixing
from cdclake.llm.bpe import op11_byte_bpe
from cdclake.llm.fingerprints import op6_fingerprints
from cdclake.llm.html_extraction import op1_html_extraction
from cdclake.llm.language_id import op2_language_id
from cdclake.llm.line_dedup import op10_line_dedup
from cdclake.llm.mixing import op5_mix_sources
from cdclake.llm.ngram_join import op8_ngram_jaccard_join
from cdclake.llm.packing import op3_pack_sequences
from cdclake.llm.personal_data import op4_personal_data
from cdclake.llm.quality_rules import op7_quality_rules
from cdclake.llm.spelling import op13_spelling_variants
from cdclake.llm.substring_dedup import op9_substring_dedup
from cdclake.llm.whitening import op12_whitening

ALL = [
    op1_html_extraction, op2_language_id, op3_pack_sequences, op4_personal_data, op5_mix_sources, op6_fingerprints,
    op7_quality_rules, op8_ngram_jaccard_join, op9_substring_dedup, op10_line_dedup,
    op11_byte_bpe, op12_whitening, op13_spelling_variants,
]

ORACLES = {"op5_mix_sources": mixing.ORACLE, "op10_line_dedup": line_dedup.ORACLE}
