"""Queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from glyphmill.llm.decontaminate import op4_benchmark_leaks
from glyphmill.llm.embedding_dedup import op7_rotation_codes
from glyphmill.llm.jaccard_join import op2_jaccard_join
from glyphmill.llm.language_id import op1_language_bitmask
from glyphmill.llm.oracles import ORACLES as OPERATOR_ORACLES
from glyphmill.llm.packing import op6_retrieval_packing
from glyphmill.llm.quality import op10_quality_ftrl
from glyphmill.llm.sharding import op5_jump_shards
from glyphmill.llm.substring_dedup import op9_relative_lz
from glyphmill.llm.token_store import op8_token_bits
from glyphmill.llm.warc import op3_warc_round_trip

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_language_bitmask": op1_language_bitmask,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_warc_round_trip": op3_warc_round_trip,
    "op4_benchmark_leaks": op4_benchmark_leaks,
    "op5_jump_shards": op5_jump_shards,
    "op6_retrieval_packing": op6_retrieval_packing,
    "op7_rotation_codes": op7_rotation_codes,
    "op8_token_bits": op8_token_bits,
    "op9_relative_lz": op9_relative_lz,
    "op10_quality_ftrl": op10_quality_ftrl,
}

ORACLES: dict[str, str] = OPERATOR_ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
