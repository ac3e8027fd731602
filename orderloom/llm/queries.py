"""The operators as named queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm.bpe_trie import op1_bpe_trie
from orderloom.llm.collocations import OP13_SQL, op13_collocations
from orderloom.llm.context_mixing import op5_context_mixing
from orderloom.llm.conversation_trie import OP11_SQL, op11_conversation_trie
from orderloom.llm.decontamination import op3_decontamination
from orderloom.llm.deobfuscation import op12_personal_data
from orderloom.llm.neighbours import OP4_SQL, op4_neighbours
from orderloom.llm.quality import op2_quality
from orderloom.llm.secrets import op6_secrets
from orderloom.llm.sharding import op9_sharding
from orderloom.llm.simhash import op7_simhash
from orderloom.llm.token_counts import op8_token_counts
from orderloom.llm.warc import OP10_SQL, op10_warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_bpe_trie": op1_bpe_trie,
        "op2_quality": op2_quality,
        "op3_decontamination": op3_decontamination,
        "op4_neighbours": op4_neighbours,
        "op5_context_mixing": op5_context_mixing,
        "op6_secrets": op6_secrets,
        "op7_simhash": op7_simhash,
        "op8_token_counts": op8_token_counts,
        "op9_sharding": op9_sharding,
        "op10_warc": op10_warc,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_personal_data": op12_personal_data,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_neighbours": OP4_SQL,
        "op10_warc": OP10_SQL,
        "op11_conversation_trie": OP11_SQL,
        "op13_collocations": OP13_SQL,
    }
