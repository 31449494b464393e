"""The corpus operators as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import (
    fill_middle,
    fingerprints,
    jaccard_join,
    language,
    licences,
    merkle,
    mixing,
    near_vectors,
    oracles,
    packing,
    personal_data,
    repeats,
    secret_ledger,
    toxicity,
)
from tidemark.llm.common import table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_repeats": lambda s, d: repeats.digests(table(s, d, "documents")),
        "op2_mixing": lambda s, d: mixing.mixture(table(s, d, "documents")),
        "op3_toxicity": lambda s, d: toxicity.score_documents(table(s, d, "documents"), table(s, d, "labels")),
        "op4_licence_scan": lambda s, d: licences.scan_pages(table(s, d, "pages")),
        "op5_vector_packing": lambda s, d: packing.pack_documents(table(s, d, "documents"), added=True),
        "op6_personal_data": lambda s, d: personal_data.find_in_documents(table(s, d, "documents")),
        "op7_language_id": lambda s, d: language.identify_documents(table(s, d, "documents")),
        "op8_near_vectors": lambda s, d: near_vectors.linked_vectors(table(s, d, "embeddings")),
        "op9_jaccard_join": lambda s, d: jaccard_join.linked_documents(table(s, d, "documents")),
        "op10_document_fingerprints": lambda s, d: fingerprints.edited_fingerprints(table(s, d, "documents")),
        "op11_fill_in_middle": lambda s, d: fill_middle.document_digests(table(s, d, "documents")),
        "op12_secret_ledger": lambda s, d: secret_ledger.document_secrets(table(s, d, "documents")),
        "op13_merkle_manifest": lambda s, d: merkle.document_manifest(table(s, d, "documents")),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.build()
