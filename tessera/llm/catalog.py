"""Queries of the training-data operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from tessera.llm.ann import op2_ann
from tessera.llm.bpe import op10_bpe
from tessera.llm.centroids import ORACLE_OP11, op11_centroids
from tessera.llm.langid import op7_language_id
from tessera.llm.licenses import op3_license_scan
from tessera.llm.line_dedup import op9_line_dedup
from tessera.llm.near_dup import op5_near_dup
from tessera.llm.packing import op1_packing
from tessera.llm.passages import op8_suffix_array_dedup
from tessera.llm.quality import op6_quality_rules
from tessera.llm.resample import ORACLE_OP12, op12_resample
from tessera.llm.topk import ORACLE_OP13, op13_topk
from tessera.llm.url_filter import op4_url_filter

QUERIES = {
    "op1_packing": op1_packing,
    "op2_ann": op2_ann,
    "op3_license_scan": op3_license_scan,
    "op4_url_filter": op4_url_filter,
    "op5_near_dup": op5_near_dup,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_bpe": op10_bpe,
    "op11_centroids": op11_centroids,
    "op12_resample": op12_resample,
    "op13_topk": op13_topk,
}

ORACLE: dict[str, str] = {
    "op11_centroids": ORACLE_OP11,
    "op12_resample": ORACLE_OP12,
    "op13_topk": ORACLE_OP13,
}
