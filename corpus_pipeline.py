"""The corpus pipeline: five stages over ``documents``, each one of the operators in ``llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import decontamination, line_dedup, near_dedup, sentencepiece_unigram, toxicity
from llm.session import discard, materialise, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    model = toxicity.fit(docs, toxicity.training_labels(spark, sf_dir))
    return toxicity.drop_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows go; a document of which no line is left goes as well."""
    found = line_dedup.dedup_lines(docs)
    return found.where("n_removed = 0 or n_removed < n_lines").select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8) stays."""
    return near_dedup.drop_near_duplicates(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left: doc_id, n_pieces, ids, round_trip."""
    import public_tokenizers

    return sentencepiece_unigram.encode_texts(docs, sentencepiece_unigram.load(public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: The classifier and the piece segmentation can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written as Parquet in the shared folder and read again; a stage's table goes once the next is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        out = materialise(stage(spark, docs, sf_dir))
        discard(docs)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
