"""The registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obsmart.llm import (
    fill_middle, filter_audit, html_wrapper, license_scan, mixing, ngram_join, packing, quality_rules,
    repeated_spans, sharding, topk_search, warc, wavelet,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_cascade": quality_rules.op1_quality_cascade,
    "op2_voronoi_top_k": topk_search.op2_voronoi_top_k,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_wrapper_extraction": html_wrapper.op4_wrapper_extraction,
    "op5_signature_tree_join": ngram_join.op5_signature_tree_join,
    "op6_karmarkar_karp_packing": packing.op6_karmarkar_karp_packing,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_warc_index": warc.op8_warc_index,
    "op9_hash_tree_shards": sharding.op9_hash_tree_shards,
    "op10_wavelet_matrix": wavelet.op10_wavelet_matrix,
    "op11_fenwick_fill_middle": fill_middle.op11_fenwick_fill_middle,
    "op12_debruijn_dedup": repeated_spans.op12_debruijn_dedup,
    "op13_transducer_audit": filter_audit.op13_transducer_audit,
}

ORACLES: dict[str, str] = {
    "op1_quality_cascade": quality_rules.OP1_SQL,
    "op2_voronoi_top_k": topk_search.OP2_SQL,
    "op3_source_mix": mixing.OP3_SQL,
    "op7_license_scan": license_scan.OP7_SQL,
    "op8_warc_index": warc.OP8_SQL,
    "op11_fenwick_fill_middle": fill_middle.OP11_SQL,
    "op12_debruijn_dedup": repeated_spans.OP12_SQL,
    "op13_transducer_audit": filter_audit.OP13_SQL,
}
