"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns rows with the columns of ``documents``; the last
returns token ids. ``run`` writes every stage as Parquet to the shared scratch folder and reads it
back for the next one, so a lost executor costs at most its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import bpe, exact_dedup, mixing, near_dedup, quality_model
from trendlake.llm.common import fold, free_names, read, without
from trendlake.llm.queries import REJECT_BELOW, quality_model_of, tokenizer_path
from trendlake.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    model = quality_model_of(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    (score,) = free_names(docs, "score")
    scored = quality_model.score_quality(docs, model, out=score)
    return without(scored.where(F.col(score) >= REJECT_BELOW), score)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of every text, and the digest of what they decode to."""
    found = bpe.encode_checked(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return found.select("doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact),
    ("MinHash near-dedup", drop_near),
    ("mixing sources", mix_sources),
    ("BPE encoding", tokenize),
]

# No stage but the second can be said in SQL; tests hold the rows against a plain recomputation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
