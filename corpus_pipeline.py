"""The training-data pipeline: quality, line dedup, near duplicates, decontamination, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept;
``run`` writes every stage's rows as Parquet in the shared checkpoint folder and reads
them again, so a lost executor never costs more than the stage it was lost in.
"""

from __future__ import annotations

import uuid
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm import bpe, quality
from wayline.llm.common import free_name, shared_dir, table
from wayline.llm.decontaminate import decontaminate
from wayline.llm.jaccard import one_of_each_group
from wayline.llm.line_dedup import dedup_lines

REJECT_BELOW = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under ``REJECT_BELOW`` go; null and empty texts have a score like any other."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs.columns, "score")
    return quality.score(docs, model, keep=tuple(docs.columns), name=name).where(F.col(name) >= REJECT_BELOW).drop(name)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds leave the later one, and a document that has
    nothing else goes; ``n_chars`` follows the text. Null ids and null texts stay as they are."""
    name = free_name(docs.columns, "removed")
    rows = dedup_lines(docs, removed=name).where((F.size(name) == 0) | (F.trim("text") != "")).drop(name)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8) the smallest id stays."""
    return one_of_each_group(docs, n=5, threshold="0.8")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``ids``, the token ids of each whole text, and ``n_tokens`` in place of ``text`` and of columns of these names; none for null."""
    path = import_module("public_tokenizers").path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.encode(docs, bpe.load_ranks(path), keep=tuple(c for c in docs.columns if c.lower() not in ("text", "ids", "n_tokens")))
    return tokens.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: A fitted classifier's decisions aren't SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
