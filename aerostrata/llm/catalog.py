"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerostrata.llm.best_fit import op13_best_fit_packing
from aerostrata.llm.embedding import OP3_SQL, op3_embedding_near_dedup
from aerostrata.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from aerostrata.llm.fill_middle import OP12_SQL, op12_fill_in_middle
from aerostrata.llm.language import op9_language_id
from aerostrata.llm.near_dedup import OP6_SQL, op6_minhash_near_dedup
from aerostrata.llm.packing import op4_packing
from aerostrata.llm.quality import op10_quality
from aerostrata.llm.resampling import op11_resampling
from aerostrata.llm.sentence_piece import op8_sentencepiece
from aerostrata.llm.toxicity import op5_toxicity
from aerostrata.llm.transcripts import op2_chat_format
from aerostrata.llm.warc import OP7_SQL, op7_warc_fixity

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_chat_format": op2_chat_format,
        "op3_embedding_near_dedup": op3_embedding_near_dedup,
        "op4_packing": op4_packing,
        "op5_toxicity": op5_toxicity,
        "op6_minhash_near_dedup": op6_minhash_near_dedup,
        "op7_warc_fixity": op7_warc_fixity,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_language_id": op9_language_id,
        "op10_quality": op10_quality,
        "op11_resampling": op11_resampling,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_best_fit_packing": op13_best_fit_packing,
    }


def oracle_queries() -> dict[str, str]:
    """SQL of the queries that need no learnt model and no tokenizer."""
    return {
        "op1_exact_dedup": OP1_SQL,
        "op3_embedding_near_dedup": OP3_SQL,
        "op6_minhash_near_dedup": OP6_SQL,
        "op7_warc_fixity": OP7_SQL,
        "op12_fill_in_middle": OP12_SQL,
    }
