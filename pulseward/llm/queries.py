"""Registry of the corpus operators: query name -> callable, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (op10_lm, op11_ranked_search, op12_conversations, op13_decontaminate, op1_quality, op2_pieces, op3_dart, op4_ranker,
               op5_cascade, op6_wavelet, op7_forest, op8_mixing, op9_suffix)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality.op1_quality_rules,
    "op2_piece_round_trip": op2_pieces.op2_piece_round_trip,
    "op3_dart_minhash": op3_dart.op3_dart_minhash,
    "op4_pairwise_quality": op4_ranker.op4_pairwise_quality,
    "op5_url_cascade": op5_cascade.op5_url_cascade,
    "op6_wavelet_shards": op6_wavelet.op6_wavelet_shards,
    "op7_prefix_forest": op7_forest.op7_prefix_forest,
    "op8_temperature_mix": op8_mixing.op8_temperature_mix,
    "op9_suffix_dedup": op9_suffix.op9_suffix_dedup,
    "op10_cross_entropy": op10_lm.op10_cross_entropy,
    "op11_ranked_search": op11_ranked_search.op11_ranked_search,
    "op12_conversation_repair": op12_conversations.op12_conversation_repair,
    "op13_decontaminate": op13_decontaminate.op13_decontaminate,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": op1_quality.ORACLE,
    "op5_url_cascade": op5_cascade.ORACLE,
    "op8_temperature_mix": op8_mixing.ORACLE,
    "op11_ranked_search": op11_ranked_search.ORACLE,
    "op13_decontaminate": op13_decontaminate.ORACLE,
}
