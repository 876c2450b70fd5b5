"""Queries of the operators over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from .bit_sliced_simhash import op11_bit_sliced_simhash
from .conversation_repair import op13_structure_repair
from .dual_tree_codes import op12_dual_tree_codes
from .hash_tree import op10_hash_tree
from .line_dedup import op2_line_dedup
from .line_frequency import op6_line_frequency
from .minmax_dedup import op8_minmax_dedup
from .mixing import op4_mixing
from .mtree import op7_mtree
from .passage_quality import op5_passage_quality
from .oracles import ORACLES
from .sampled_pieces import op9_sampled_pieces
from .token_blocks import op1_token_blocks
from .toxicity import op3_toxicity

QUERIES = {
    "op1_token_blocks": op1_token_blocks,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_passage_quality": op5_passage_quality,
    "op6_line_frequency": op6_line_frequency,
    "op7_mtree": op7_mtree,
    "op8_minmax_dedup": op8_minmax_dedup,
    "op9_sampled_pieces": op9_sampled_pieces,
    "op10_hash_tree": op10_hash_tree,
    "op11_bit_sliced_simhash": op11_bit_sliced_simhash,
    "op12_dual_tree_codes": op12_dual_tree_codes,
    "op13_structure_repair": op13_structure_repair,
}

__all__ = ["ORACLES", "QUERIES"]
