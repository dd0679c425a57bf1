"""Named queries of this subpackage, and the SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citystream.llm import (decontaminate, exactdup, mainbody, merkle, mixing, neardup, neighbours, quality, secrets, spans, suffixes, toxicity,
                            trie)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_html": mainbody.op2_html,
    "op3_repeated_bytes": suffixes.op3_repeated_bytes,
    "op4_sentence_spans": spans.op4_sentence_spans,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_quality": quality.op6_quality,
    "op7_near_duplicates": neardup.op7_near_duplicates,
    "op8_mixing": mixing.op8_mixing,
    "op9_neighbours": neighbours.op9_neighbours,
    "op10_secrets": secrets.op10_secrets,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_exact_duplicates": exactdup.op12_exact_duplicates,
    "op13_manifest": merkle.op13_manifest,
}
ORACLES: dict[str, str] = {
    "op4_sentence_spans": spans.ORACLE,
    "op7_near_duplicates": neardup.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op12_exact_duplicates": exactdup.ORACLE,
    "op13_manifest": merkle.ORACLE,
}
