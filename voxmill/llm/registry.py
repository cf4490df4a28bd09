"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, conversation_repair, exact_dedup, host_rules, ngram_join, pareto_mix, pii, rule_ensemble, spelling, substring_dedup, url_rules, warc, wavelet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_quality_rule_ensemble": rule_ensemble.query,
    "op2_host_quality_rules": host_rules.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_wavelet_shards": wavelet.query,
    "op5_substring_dedup": substring_dedup.query,
    "op6_pii_anchors": pii.query,
    "op7_warc_normaliser": warc.query,
    "op8_pareto_mix": pareto_mix.query,
    "op9_byte_bpe": byte_bpe.query,
    "op10_ngram_tree_join": ngram_join.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_url_rules": url_rules.query,
    "op13_spelling_variants": spelling.query,
}
ORACLE_SQL: dict[str, str] = {
    "op2_host_quality_rules": host_rules.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op7_warc_normaliser": warc.SQL,
    "op8_pareto_mix": pareto_mix.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_url_rules": url_rules.SQL,
    "op13_spelling_variants": spelling.SQL,
}
