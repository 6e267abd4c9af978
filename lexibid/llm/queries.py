"""The queries of this package, each over its whole table, and DuckDB SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexibid.llm import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    hmm_lm,
    jaccard_join,
    language_id,
    merkle,
    mixing,
    pii,
    quality_cnn,
    secret_scan,
    vector_codes,
    warc,
)
from lexibid.llm.common import read_documents, read_pages, read_vectors
from lexibid.llm.oracle import all_oracles as all_oracles

Query = Callable[[SparkSession, str], DataFrame]


def on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: operator(read_documents(spark, directory))


def on_pages(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: operator(read_pages(spark, directory))


def on_vectors(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: operator(read_vectors(spark, directory))


def all_queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": on_documents(exact_dedup.dedup_report),
        "op2_byte_bpe": on_documents(byte_bpe.round_trip_report),
        "op3_fingerprints": on_documents(fingerprints.edit_report),
        "op4_jaccard_join": on_documents(jaccard_join.component_report),
        "op5_warc": on_pages(warc.round_trip_report),
        "op6_hmm_lm": on_documents(hmm_lm.score_report),
        "op7_pii": on_documents(pii.personal_data_report),
        "op8_language_id": on_documents(language_id.language_report),
        "op9_mixing": on_documents(mixing.mix_report),
        "op10_secret_scan": on_documents(secret_scan.secret_report),
        "op11_vector_codes": on_vectors(vector_codes.code_report),
        "op12_quality_cnn": quality_cnn.quality_report,
        "op13_merkle_manifest": on_documents(merkle.manifest_report),
    }
