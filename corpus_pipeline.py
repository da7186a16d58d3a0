"""The training-data pipeline: five stages over documents, each an operator of ``quadrille.llm``.

Toxic documents go, then exact copies, then near copies but one of each group, then documents with benchmark passages; what is left is encoded.
Each stage takes what the one before kept, as a Parquet table in the shared folder, and judges rows by their own texts. A stage's tables are deleted once the next one's input is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quadrille.llm import bpe, common, decontamination, exact_dedup, near_dedup, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a model of the labels predicts toxic."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the one of largest doc_id."""
    return exact_dedup.drop_copies(docs, keep="max")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    return near_dedup.drop_near_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain ten words in a row of a benchmark item, or a whole shorter item."""
    return decontamination.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of what is left: doc_id, n_tokens, ids, ids_sha256."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), outputs=("n_tokens", "ids", "ids_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("bpe", encoded),
]

#: SQL can't express the trained model, the linking of near copies or the merges; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with common.scratch(spark) as keep:
            after = keep(common.written(stage(spark, docs, sf_dir), f"stage-{name}"))
        common.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
