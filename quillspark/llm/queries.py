"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from quillspark.llm import bpe, fingerprints, langid, lines, packing, passages, secrets, simhash, substrings, vectors

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_suffix_array_dedup": substrings.op2_suffix_array_dedup,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_document_fingerprints": simhash.op4_document_fingerprints,
    "op5_bpe_codec": bpe.op5_bpe_codec,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_embedding_near_dedup": vectors.op8_embedding_near_dedup,
    "op9_substring_near_dedup": passages.op9_substring_near_dedup,
    "op10_simhash_near_dedup": fingerprints.op10_simhash_near_dedup,
}

ORACLE_SQL: dict[str, str] = {"op3_line_dedup": lines.OP3_SQL}
