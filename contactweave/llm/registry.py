"""Queries of the training-data operators and, where SQL can say the same, their SQL."""

from contactweave.llm.centroids import OP13_SQL, op13_hilbert_blocks
from contactweave.llm.language import op4_subword_language
from contactweave.llm.line_dedup import OP11_SQL, op11_first_lines
from contactweave.llm.mixing import OP10_SQL, op10_systematic_mix
from contactweave.llm.packing import op8_nnls_packing
from contactweave.llm.quality import OP3_SQL, op3_rule_ledger
from contactweave.llm.search import OP9_SQL, op9_ball_tree_search
from contactweave.llm.sharding import op1_rendezvous_shards
from contactweave.llm.simhash import op5_covering_simhash
from contactweave.llm.spelling import OP12_SQL, op12_trie_pairs
from contactweave.llm.suffix_dedup import op2_suffix_merge
from contactweave.llm.token_counts import op6_viterbi_counts
from contactweave.llm.token_matrix import op7_best_fit_matrices

QUERIES = {
    "op1_rendezvous_shards": op1_rendezvous_shards,
    "op2_suffix_merge": op2_suffix_merge,
    "op3_rule_ledger": op3_rule_ledger,
    "op4_subword_language": op4_subword_language,
    "op5_covering_simhash": op5_covering_simhash,
    "op6_viterbi_counts": op6_viterbi_counts,
    "op7_best_fit_matrices": op7_best_fit_matrices,
    "op8_nnls_packing": op8_nnls_packing,
    "op9_ball_tree_search": op9_ball_tree_search,
    "op10_systematic_mix": op10_systematic_mix,
    "op11_first_lines": op11_first_lines,
    "op12_trie_pairs": op12_trie_pairs,
    "op13_hilbert_blocks": op13_hilbert_blocks,
}
ORACLES = {
    "op3_rule_ledger": OP3_SQL,
    "op9_ball_tree_search": OP9_SQL,
    "op10_systematic_mix": OP10_SQL,
    "op11_first_lines": OP11_SQL,
    "op12_trie_pairs": OP12_SQL,
    "op13_hilbert_blocks": OP13_SQL,
}
