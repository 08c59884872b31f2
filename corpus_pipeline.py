"""Corpus pipeline over ``documents``: each stage is written as Parquet and read by the next.

Defined cases are those of the operators: rows with nulls, empty or very long texts go through every stage; of equal
rows and ties the near-dedup stage keeps one; an empty table gives no rows; all columns but those a stage
changes come out as they came in, whatever their names, up to the last stage, which has columns of its own.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearback.llm import mixing, pieces, secrets, simhash, toxicity
from hearback.llm.common import free_prefix, workspace
from hearback.llm.queries import MIX, vocabulary


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    score = free_prefix(docs, "__score")
    return toxicity.add_score(docs, model, score).filter(F.col(score) < 0.5).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose SimHash fingerprints are linked at 4 bits."""
    return simhash.keep_first(docs, width=4, bits=4, seed=42)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its strong and linked secrets masked."""
    return secrets.mask_secrets(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them, columns as they came."""
    own = free_prefix(docs, "__kept_")
    held = {c: f"{own}{c}" for c in docs.columns if c.lower() in mixing.ADDED}
    mixed = mixing.mix_sources(docs.withColumnsRenamed(held), MIX)
    return mixed.select(*(F.col(held.get(c, c)).alias(c) for c in docs.columns))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text instead of the text."""
    model = Path(vocabulary("piece_bpe_32k.model")).read_bytes()
    return pieces.encode(docs, model, "bpe").select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mix_stage),
    ("SentencePiece encoding", encode_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole of ``documents``."""
    work = workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = work.stage(docs, f"stage-{i + 1}")
    return docs
