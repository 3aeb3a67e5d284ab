"""Queries and SQL of the corpus operators, for the entry module."""

from __future__ import annotations

from chronolex.llm import chat, dedup, jaccard, langid, media, mixing, packing, quality, secrets, sharding

QUERIES = {
    "op1_language_id": langid.op1,
    "op2_media_columns": media.op2,
    "op3_packing": packing.op3,
    "op4_chat_formatting": chat.op4,
    "op5_ngram_jaccard_join": jaccard.op5,
    "op6_mixing": mixing.op6,
    "op7_secret_scan": secrets.op7,
    "op8_quality_classifier": quality.op8,
    "op9_exact_dedup": dedup.op9,
    "op10_sharding": sharding.op10,
}

ORACLE_SQL = {
    "op6_mixing": mixing.OP6_SQL,
    "op9_exact_dedup": dedup.OP9_SQL,
}
