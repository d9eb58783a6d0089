"""Queries of the subpackage; their DuckDB counterparts, where there are any, are in `sql`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.language import op9_language_id
from shelfcast.llm.mixing import op6_mixing
from shelfcast.llm.near import op7_minhash
from shelfcast.llm.pieces import op5_sentencepiece
from shelfcast.llm.quality import op8_quality_rules
from shelfcast.llm.repeats import op3_repeats
from shelfcast.llm.scoring import op4_backoff_scores
from shelfcast.llm.secrets import op2_secret_scan
from shelfcast.llm.sharding import op10_sharding
from shelfcast.llm.sql import oracle_sql
from shelfcast.llm.tokenfiles import op13_token_files
from shelfcast.llm.trie import op11_prefix_trie
from shelfcast.llm.vectors import op1_near_vectors
from shelfcast.llm.whitening import op12_whitening

__all__ = ["oracle_sql", "queries"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_vectors": op1_near_vectors,
        "op2_secret_scan": op2_secret_scan,
        "op3_repeats": op3_repeats,
        "op4_backoff_scores": op4_backoff_scores,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_mixing": op6_mixing,
        "op7_minhash": op7_minhash,
        "op8_quality_rules": op8_quality_rules,
        "op9_language_id": op9_language_id,
        "op10_sharding": op10_sharding,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_whitening": op12_whitening,
        "op13_token_files": op13_token_files,
    }
