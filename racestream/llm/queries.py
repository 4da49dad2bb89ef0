"""The registered queries of this subpackage and their SQL."""

from . import (
    decontaminate, html_text, jaccard_join, packing, periodic_runs, pii, shard, spelling, suffix_tree_lm, token_counts,
    topk, toxicity, url_filter,
)

QUERIES = {
    "op1_url_filter": url_filter.q_op1_url_filter,
    "op2_lm_scoring": suffix_tree_lm.q_op2_lm_scoring,
    "op3_toxicity": toxicity.q_op3_toxicity,
    "op4_packing": packing.q_op4_packing,
    "op5_jaccard_join": jaccard_join.q_op5_jaccard_join,
    "op6_token_counts": token_counts.q_op6_token_counts,
    "op7_decontaminate": decontaminate.q_op7_decontaminate,
    "op8_pii": pii.q_op8_pii,
    "op9_topk": topk.q_op9_topk,
    "op10_sharding": shard.q_op10_sharding,
    "op11_periodic_runs": periodic_runs.q_op11_periodic_runs,
    "op12_spelling": spelling.q_op12_spelling,
    "op13_html_text": html_text.q_op13_html_text,
}

ORACLES = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op5_jaccard_join": jaccard_join.OP5_SQL,
    "op7_decontaminate": decontaminate.OP7_SQL,
    "op9_topk": topk.OP9_SQL,
    "op11_periodic_runs": periodic_runs.OP11_SQL,
    "op12_spelling": spelling.OP12_SQL,
    "op13_html_text": html_text.OP13_SQL,
}
