"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_cnn, clause_grammar, cover_tree, derivation, fair_mix, license_scan, media_chunks, nb_svm, reply_trees, simhash, token_files, warc_revisits, winnowing


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_media_chunks": media_chunks.op1_media_chunks,
        "op2_token_files": token_files.op2_token_files,
        "op3_reply_trees": reply_trees.op3_reply_trees,
        "op4_byte_cnn": byte_cnn.op4_byte_cnn,
        "op5_winnowing": winnowing.op5_winnowing,
        "op6_simhash": simhash.op6_simhash,
        "op7_fair_mix": fair_mix.op7_fair_mix,
        "op8_license_scan": license_scan.op8_license_scan,
        "op9_nb_svm": nb_svm.op9_nb_svm,
        "op10_warc_revisits": warc_revisits.op10_warc_revisits,
        "op11_clause_grammar": clause_grammar.op11_clause_grammar,
        "op12_derivation": derivation.op12_derivation,
        "op13_cover_tree": cover_tree.op13_cover_tree,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_reply_trees": reply_trees.SQL,
        "op5_winnowing": winnowing.SQL,
        "op7_fair_mix": fair_mix.SQL,
        "op8_license_scan": license_scan.sql(),
        "op10_warc_revisits": warc_revisits.SQL,
        "op12_derivation": derivation.SQL,
        "op13_cover_tree": cover_tree.sql(),
    }
