"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame; all but the last have the columns of ``documents``. Of tables other than ``docs`` a stage
reads ``labels`` alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, mixing, packing, personal_data, toxicity
from tidemark.llm.common import stored, table


def _whole(docs: DataFrame) -> DataFrame:
    """Each row whole in ``row``, so that a stage's own columns clash with none of its names."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _unwrapped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labelled ones that are not held out.

    Null and empty texts have a score like any other.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(_whole(docs), model, F.col("row.text"), "score")
    return _unwrapped(scored.filter(F.col("score") < toxicity.THRESHOLD), docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles connect, the one with the smallest id stays.

    Rows of one id are one document: they stay or go together. Of those that repeat its id and text, null
    ids included, one stays. Rows without an id link with nothing.
    """
    linked = jaccard_join.linked_documents(docs, words=5, least=(80, 100))
    ids = linked.groupBy("doc_id").agg(F.min("component_id").alias("least"), (F.count("*") > 1).alias("many"))
    kept = stored(ids.filter("doc_id IS NULL OR doc_id = least").select(F.col("doc_id").alias("id"), "many"), "kept-ids")
    own = lambda many: _whole(docs).join(
        kept.filter(F.col("many") == many), F.col("row.doc_id").eqNullSafe(F.col("id"))
    )
    # Only repeated ids are looked at twice; a hot one is spread by its texts, and ranked in each map task first.
    ranked = Window.partitionBy("id", "row.text").orderBy(F.to_json("row"))
    single = own(True).withColumn("at", F.row_number().over(ranked)).filter("at = 1")
    return _unwrapped(own(False).select("row").unionAll(single.select("row")), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind; ``n_chars`` counts the new text."""
    changed = personal_data.with_redaction(docs, personal_data.train(docs), F.col("text"))
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens approach the raked shares of sources, languages and topics; rows may repeat."""
    return mixing.sampled(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, as rows of pieces."""
    return packing.pack_documents(docs, added=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_copies", one_of_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_to_targets),
    ("packing", pack_sequences),
]

#: Trained models and tokenizers are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
