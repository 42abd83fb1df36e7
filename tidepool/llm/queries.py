"""Registered queries of the training-data operators, and their oracles where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tidepool.llm import (centroids, chat, decontaminate, exact_dedup, language_id, nearest, packing, secret_scan,
                          sharding, simhash, structure_repair, suffix_dedup, token_store)

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_nearest_neighbours": nearest.op4_nearest_neighbours,
    "op5_packing": packing.op5_packing,
    "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_token_store": token_store.op9_token_store,
    "op10_sharding": sharding.op10_sharding,
    "op11_structure_repair": structure_repair.op11_structure_repair,
    "op12_centroid_clusters": centroids.op12_centroid_clusters,
    "op13_exact_dedup": exact_dedup.op13_exact_dedup,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op3_chat_formatting": chat.OP3_SQL,
    "op11_structure_repair": structure_repair.OP11_SQL,
    "op12_centroid_clusters": centroids.OP12_SQL,
    "op13_exact_dedup": exact_dedup.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
