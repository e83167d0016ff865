"""The operators' queries by name: (spark, folder of the input tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casemart.llm import (
    chat,
    jaccard,
    language,
    licences,
    mixing,
    neighbours,
    packing,
    quality,
    repair,
    sharding,
    simhash,
    suffixes,
    variants,
)
from casemart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The public tokenizer that the packing query is defined with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def on(name: str, plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(table(spark, sf_dir, name))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_license_scan": on("documents", licences.digest),
        "op1_license_notices": on("documents", licences.notice_digest),
        "op2_quality": lambda spark, sf_dir: quality.digest(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
        ),
        "op3_chat_format": on("conversations", chat.digest),
        "op4_fingerprints": on("documents", simhash.digest),
        "op5_source_mixing": on("documents", mixing.digest),
        "op6_nearest_neighbours": on("embeddings", neighbours.digest),
        "op7_language_id": on("documents", language.digest),
        "op8_jaccard_join": on("documents", jaccard.digest),
        "op9_packing": on("documents", lambda docs: packing.digest(docs, tokenizer_path())),
        "op10_suffix_dedup": on("documents", suffixes.digest),
        "op11_spelling_variants": on("documents", variants.digest),
        "op12_conversation_repair": on("conversations", repair.digest),
        "op13_sharding": on("documents", sharding.digest),
    }
