"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prospect.llm import (anchors, flat_graph, langid, mixing, packing, prefix_trie, repair_ids, secret_scan, sentencepiece_codec,
                          simhash, spotsigs, url_filter, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_flat_graph": flat_graph.op1_flat_graph,
    "op2_language": langid.op2_language,
    "op3_simhash": simhash.op3_simhash,
    "op4_temperature_mix": mixing.op4_temperature_mix,
    "op5_anchor_dedup": anchors.op5_anchor_dedup,
    "op6_sentencepiece": sentencepiece_codec.op6_sentencepiece,
    "op7_spot_signatures": spotsigs.op7_spot_signatures,
    "op8_repair_ids": repair_ids.op8_repair_ids,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_shortest_pack": packing.op11_shortest_pack,
    "op12_bit_sliced_whitening": whitening.op12_bit_sliced_whitening,
    "op13_conversation_trie": prefix_trie.op13_conversation_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op1_flat_graph": flat_graph.ORACLE_SQL,
    "op4_temperature_mix": mixing.ORACLE_SQL,
    "op5_anchor_dedup": anchors.ORACLE_SQL,
    "op9_url_filter": url_filter.ORACLE_SQL,
    "op13_conversation_trie": prefix_trie.ORACLE_SQL,
}
