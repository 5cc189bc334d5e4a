"""Registered queries of this package and the DuckDB SQL that restates them where SQL can."""

from cabmill.llm import exact_topk, hard_negatives, lexical_tree
from cabmill.llm.byte_bpe import op12_byte_bpe
from cabmill.llm.chat_format import op5_chat_format
from cabmill.llm.exact_topk import op7_exact_topk
from cabmill.llm.hard_negatives import op13_hard_negatives
from cabmill.llm.html_extract import op1_html_extract
from cabmill.llm.jaccard_join import op8_jaccard_join
from cabmill.llm.lexical_tree import op11_lexical_tree
from cabmill.llm.packing import op2_packing
from cabmill.llm.permutation_index import op10_permutation_index
from cabmill.llm.piece_encode import op6_piece_encode
from cabmill.llm.recurrent_lm import op3_recurrent_lm
from cabmill.llm.secret_scan import op9_secret_scan
from cabmill.llm.toxicity import op4_toxicity

QUERIES = {
    "op1_html_extract": op1_html_extract,
    "op2_packing": op2_packing,
    "op3_recurrent_lm": op3_recurrent_lm,
    "op4_toxicity": op4_toxicity,
    "op5_chat_format": op5_chat_format,
    "op6_piece_encode": op6_piece_encode,
    "op7_exact_topk": op7_exact_topk,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_secret_scan": op9_secret_scan,
    "op10_permutation_index": op10_permutation_index,
    "op11_lexical_tree": op11_lexical_tree,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op7_exact_topk": exact_topk.ORACLE,
    "op11_lexical_tree": lexical_tree.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
