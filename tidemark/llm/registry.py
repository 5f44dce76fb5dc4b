"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    bpe,
    conversations,
    decontaminate,
    grade,
    jaccard,
    langid,
    oracle,
    pii,
    rules,
    shards,
    simhash,
    substrings,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        rules.op1_isolation_rules,
        bpe.op2_byte_bpe,
        decontaminate.op3_edit_decontamination,
        pii.op4_weak_supervision_pii,
        substrings.op5_super_kmers,
        simhash.op6_simhash_grid,
        grade.op7_ordinal_quality,
        langid.op8_language_filters,
        shards.op9_vector_packing,
        toxicity.op10_toxic_segments,
        jaccard.op11_grouped_prefix_join,
        alignment.op12_token_alignment,
        conversations.op13_scalar_repair,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
