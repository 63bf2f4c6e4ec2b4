"""The document pipeline: five stages, each over all that the one before kept.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes a stage's
rows to the shared folder and reads them again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, ngram_join, queries, secret_scan, sentencepieces, toxicity
from tidemark.session import materialize, ship_package


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    return toxicity.score(docs, model, score_col="__score").where("__score < 0.5").drop("__score")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near copies:
    distinct 5-word shingles with a Jaccard similarity of at least 0.8."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows."""
    return secret_scan.redact_secrets(docs, length_col="n_chars")


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their SentencePiece ids and the number of these
    (``piece_ids`` and ``n_pieces``, in place of columns of these names)."""
    return sentencepieces.encode(docs, queries.vocabulary(queries.PIECES)).withColumn("n_pieces", F.size("piece_ids").cast("long"))


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("SentencePiece encoding", as_pieces),
]

# the classifier's scores are not expressible in SQL; tests/llm/test_filters.py holds run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns for ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
