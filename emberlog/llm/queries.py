"""The dealt operators as registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from emberlog.llm import (
    conversations,
    gam,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    outliers,
    pieces,
    ranked_search,
    surrogates,
    token_counts,
    toxicity,
    url_rules,
)

QUERIES = {
    "op1_quality": gam.op1_quality,
    "op2_neighbours": neighbours.op2_neighbours,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_surrogates": surrogates.op4_surrogates,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_url_filters": url_rules.op7_url_filters,
    "op8_pieces": pieces.op8_pieces,
    "op9_outliers": outliers.op9_outliers,
    "op10_mixing": mixing.op10_mixing,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_toxicity": toxicity.op13_toxicity,
}

ORACLES = {
    "op7_url_filters": url_rules.OP7_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_conversation_repair": conversations.OP11_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
}
